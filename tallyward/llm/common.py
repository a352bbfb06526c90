"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
"""Text handled at once inside a task; a longer document is a block of its own."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key written as text, modulo ``folds``; NULL counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def draw_of(*columns: str) -> Column:
    """A number from 0 to 1 by the hash of a row's columns, to 53 bits."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)


def blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES,
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows in runs of about ``size`` bytes of text, and their texts (NULL as empty)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = (np.cumsum(lengths) - lengths) // size
        starts = np.flatnonzero(np.diff(run, prepend=-1))
        for lo, hi in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
            part = batch.slice(int(lo), int(hi - lo))
            yield part, [t or "" for t in part.column(column).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def lower_bytes(text: str) -> bytes:
    """UTF-8 with A-Z, and no other letter, in lower case."""
    return text.encode("utf-8", "surrogatepass").lower()


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_columns(
    docs: DataFrame, text: str, prepare: Callable[[], Callable[[str], tuple]], fields: pa.Schema, types: str,
) -> DataFrame:
    """All columns of ``docs`` and those that a function of the text gives.

    ``prepare`` runs once in a task and returns the function. A column of ``docs``
    with the name of a new one is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in docs.columns if c.lower() not in new or c == text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch, texts in blocks(batches, text):
            columns = list(zip(*map(function, texts), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)],
                names=[*kept, *fields.names])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept).mapInArrow(run, f"{own}, {types}")
