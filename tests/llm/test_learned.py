"""Language identification and toxicity: held-out accuracy, and defined results at the edges."""

from __future__ import annotations

import math
import pickle
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tallyward.llm import langid, toxicity
from tallyward.llm.common import draw_of, table


def test_languages_of_held_out_documents(engine, sf_check):
    found = driver.queries()["op8_language_id"](engine, sf_check)
    docs = table(engine, sf_check, "documents").select("doc_id", "lang")
    right = found.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.98
    assert found.count() == docs.count() and found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_unseen_words_back_off_to_shorter_grams(engine):
    rows = [(i, "strasse kirche", "de") for i in range(3)] + [(i, "iglesia calle", "es") for i in range(3, 6)]
    model = langid.fit(engine.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict("kirchen")[0] == "de" and model.predict("callejon")[0] == "es"
    assert model.predict("kirche")[1] > model.predict("kixxhe")[1]


def plain_language(rows, text):
    """The rule of the module, said once more: words, then the longest order with a known n-gram."""
    langs = sorted({lang for _, lang in rows})
    counts = [{} for _ in range(6)]
    for value, lang in rows:
        for word in langid.WORD.findall(value.lower()):
            counts[0].setdefault(word, Counter())[lang] += 1
            for order in range(1, 6):
                marked = f"<{word}>"
                for i in range(len(marked) - order + 1):
                    counts[order].setdefault(marked[i:i + order], Counter())[lang] += 1
    totals = [{g: sum(c[g] for c in table.values()) + 0.5 * len(table) for g in langs} for table in counts]

    def log(order, gram, lang):
        return math.log((counts[order][gram][lang] + 0.5) / max(totals[order][lang], 1))

    words = langid.WORD.findall(text.lower())
    votes = dict.fromkeys(langs, 0.0)
    for word in words:
        if word in counts[0]:
            for lang in langs:
                votes[lang] += log(0, word, lang)
            continue
        for order in range(5, 0, -1):
            marked = f"<{word}>"
            known = [g for i in range(len(marked) - order + 1) if (g := marked[i:i + order]) in counts[order]]
            if known:
                for lang in langs:
                    votes[lang] += sum(log(order, g, lang) for g in known) / len(known)
                break
    evidence = min(len(words), langid.EVIDENCE) / len(words)
    odds = {lang: math.exp((v - max(votes.values())) * evidence) for lang, v in votes.items()}
    best = max(langs, key=lambda lang: (odds[lang], -langs.index(lang)))
    return best, odds[best] / sum(odds.values())


def test_predictions_equal_the_plain_rule(engine):
    """All words and n-grams of the drawn rows count, however rare."""
    rng = random.Random(9)
    letters = {"aa": "abcdeéf", "bb": "cdefgh", "cc": "efghijक्ष"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 9)))
    rows = [(" ".join(word(lang) for _ in range(rng.randrange(1, 20))), lang) for lang in letters for _ in range(30)]
    model = langid.fit(engine.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string"))
    for _ in range(200):
        text = " ".join(word(rng.choice(list(letters))) for _ in range(rng.randrange(1, 30)))
        lang, score = plain_language(rows, text)
        found = model.predict(text)
        assert found[0] == lang and math.isclose(found[1], score, rel_tol=1e-3)


def test_a_model_takes_little_more_memory_than_it_is_sent_in(engine):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(12))
    rows = [(i, " ".join(word() for _ in range(200)), "en" if i % 2 else "de") for i in range(100)]
    sent = pickle.dumps(langid.fit(engine.createDataFrame(rows, "doc_id long, text string, lang string")))
    tracemalloc.start()
    try:
        model = pickle.loads(sent)
        model.predict("one unseen word")
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(model.index[0]) == 20_000 and held < 2 * len(sent)


def test_names_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(langid.xxhash, "xxh3_64_intdigest", lambda raw: len(raw) % 2)
    names = ["a", "bb", "ccc", "é", "", "ddd"]
    found, order = langid.Names.of(names)
    assert found.find(names + ["x", "yy", "zzz"]).tolist() == [*np.argsort(order).tolist(), -1, -1, -1]
    assert langid.Names.of([])[0].find(["a"]).tolist() == [-1]


def test_predictions_stay_the_same_when_the_memo_starts_anew(engine, monkeypatch):
    rows = [(1, "strasse kirche haus", "de"), (2, "iglesia calle casa", "es")]
    model = langid.fit(engine.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["kirchen calle xx haus", "casa iglesia hausen", "", "kirche " * 9 + "call callejon"]
    expected = [model.predict(t) for t in texts]
    monkeypatch.setattr(langid, "MEMO_ROWS", 8)
    small = pickle.loads(pickle.dumps(model))
    assert [small.predict(t) for t in texts * 3] == expected * 3


def test_words_keep_their_marks():
    decomposed = "de" + chr(0x301)
    assert langid.WORD.findall(f"हिन्दी में, {decomposed}x _a1b") == ["हिन्दी", "में", f"{decomposed}x", "a", "b"]


def test_rows_are_drawn_by_share_and_by_text(engine, monkeypatch):
    """A share of 2000 in 3 billion still draws rows, and NULL or repeated keys do not go together."""
    share = 2000 / 3_000_000_000
    few = engine.range(20_000_000).where(draw_of("id") < share).count()
    assert 1 <= few <= 40
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = [(None if i % 2 else 7, f"word{i} text".translate(letters), "en") for i in range(400)]
    monkeypatch.setattr(langid, "LONGEST_GRAM", 1)
    model = langid.fit(engine.createDataFrame(rows, "doc_id long, text string, lang string"), rows_per_language=40)
    assert 15 <= len(model.index[0]) - 1 <= 80


def test_repeated_and_unkeyed_labels_are_one_or_none(engine):
    docs = engine.createDataFrame([(i, f"insult{i % 3} you" if i % 2 else f"kind{i % 3} you") for i in range(40)], "doc_id long, text string")
    labels = engine.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    many = labels.unionByName(labels).unionByName(engine.createDataFrame([(None, 1)] * 50, "doc_id long, toxic int"))
    scores = [{r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, x)).collect()} for x in (labels, many)]
    assert scores[0] == scores[1]


def test_languages_at_the_edges(edge_docs, no_docs):
    model = langid.fit(edge_docs)
    found = langid.identify(edge_docs, model).collect()
    assert len(found) == edge_docs.count()
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == "en" and 0 <= r.score <= 1
    assert {r.removed for r in found} == {r.removed for r in edge_docs.collect()}
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, nothing).collect()} == {"und"}
    assert langid.identify(no_docs, model).count() == 0


def brute_segments(weights, lo, hi):
    """All maximal segments by definition: the best run, then those beside it."""
    best = None
    for i in range(lo, hi):
        for j in range(i + 1, hi + 1):
            total = sum(weights[i:j])
            if total > 0 and (best is None or (total, i - j) > best[0]):
                best = ((total, i - j), i, j)
    if best is None:
        return []
    _, i, j = best
    return [*brute_segments(weights, lo, i), sum(weights[i:j]), *brute_segments(weights, j, hi)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -2.0, -1.0, -0.5, 1.0, 2.0, 3.0]), max_size=14))
def test_segments_are_all_maximal_ones(weights):
    found = toxicity.maximal_segments(weights)
    assert sorted(s for _, _, s in found) == sorted(brute_segments(weights, 0, len(weights)))
    assert all(abs(sum(weights[a:b]) - s) < 1e-9 for a, b, s in found)


def test_toxic_held_out_documents(engine, sf_check):
    found = driver.queries()["op3_toxicity"](engine, sf_check)
    labels = table(engine, sf_check, "labels")
    held = found.join(labels, "doc_id").where("held_out").toPandas()
    assert held[held.toxic == 0].predicted.mean() < 0.05
    assert held[held.toxic == 1].score.mean() > held[held.toxic == 0].score.mean() + 0.3
    assert found.count() == table(engine, sf_check, "documents").count()


def test_toxicity_at_the_edges(engine, edge_docs, no_docs):
    labels = engine.createDataFrame([(i, i % 2) for i in range(14)], "doc_id long, toxic int")
    model = toxicity.fit(edge_docs, labels)
    found = toxicity.score(edge_docs, model).collect()
    assert len(found) == edge_docs.count() and all(0 <= r.score <= 1 for r in found)
    of = {r.text: r.score for r in found}
    assert of[None] == of[""] == of["..."]
    for one_kind in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        assert {r.score for r in toxicity.score(edge_docs, toxicity.fit(edge_docs, one_kind)).collect()} == {0.0}
    assert toxicity.score(no_docs, model).count() == 0


def test_an_inflected_insult_is_found(engine):
    rng = random.Random(1)
    plain = ["".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(600):
        words = rng.choices(plain, k=40)
        if i % 6 == 0:
            words[rng.randrange(40)] = "grumblo" + rng.choice("abcdefghij")
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    docs = engine.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    assert model.score("a word or two grumblozz and more of them") > 0.7 > model.score("a word or two and more of them")
    assert [p[:2] for p in model.passages("so grumblozz indeed")[1]] == [(1, 2)]


@pytest.mark.parametrize("name", ["op8_language_id", "op3_toxicity"])
def test_labels_and_ids_are_no_inputs(engine, sf_small, name, tmp_path):
    """Changing language, source and id order of what is scored changes no score."""
    docs = table(engine, sf_small, "documents")
    module = langid if name == "op8_language_id" else toxicity
    model = langid.fit(docs) if module is langid else toxicity.fit(docs, table(engine, sf_small, "labels"))
    score = langid.identify if module is langid else toxicity.score
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "doc_id": -F.col("doc_id")})
    a = sorted((r.text, r.score) for r in score(docs, model).select("text", "score").collect())
    b = sorted((r.text, r.score) for r in score(other, model).select("text", "score").collect())
    assert a == b
