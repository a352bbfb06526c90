import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT]


@pytest.fixture(scope="session")
def engine(spark):
    """The session, whose Python workers find this repository."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, paths]))
    return spark


EDGE_TEXTS = [
    None, "", " \n\t ", "...", "one", "one", "Ünïcödé wörds ß Σς",
    "the cat sat on the mat and the dog sat on the log, all rights reserved. " * 3,
    "the cat sat on the mat and the dog sat on the log, all rights reserved. " * 3,
    "it's 12½ o'clock <|endoftext|> \x01 \x1c\x85 ́ á 漢字 🙂",
    "x" * 70_000, "word " * 30_000, "漢" * 5_000,
]


@pytest.fixture(scope="session")
def edge_docs(engine):
    """NULLs, empty, blank, repeated and very long texts, NULL ids, repeated rows, clashing columns."""
    rows = [(i, t, "en" if i % 2 else None, "s", 0, 9.5, i) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "one", "en", "s", 0, 1.0, 1), (4, "one", "en", "s", 0, 1.0, 2)]
    return engine.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, removed long")


@pytest.fixture(scope="session")
def no_docs(engine, edge_docs):
    return engine.createDataFrame([], edge_docs.schema)
