"""The automaton against substring search, the parse against a plain one, and accuracy on rows never learned from."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import language_id
from tariffa.llm.common import fold, table

SCHEMA = "doc_id long, text string, lang string, score double"


def test_automaton_knows_every_substring_and_no_other():
    rng = random.Random(1)
    text = [rng.randrange(3, 6) for _ in range(60)]
    automaton = language_id.suffix_automaton(text, 6)
    joined = "".join(map(str, text))

    def known(word):
        state = 0
        for symbol in word:
            state = automaton[state, symbol]
            if not state:
                return False
        return True

    for _ in range(500):
        word = [rng.randrange(3, 6) for _ in range(rng.randrange(1, 7))]
        assert known(word) == ("".join(map(str, word)) in joined)
    assert all(known(text[i:j]) for i in range(60) for j in range(i + 1, 61))


def plain_phrases(symbols, passages):
    """Longest matches one after another, inside windows; a symbol that doesn't occur is a phrase."""
    count = 0
    texts = ["".join(map(chr, p)) for p in passages]
    for start in range(0, len(symbols), language_id.WINDOW):
        window, at = symbols[start : start + language_id.WINDOW], 0
        while at < len(window):
            length = 1
            while at + length < len(window) and any("".join(map(chr, window[at : at + length + 1])) in t for t in texts):
                length += 1
            if language_id.UNKNOWN in window[at : at + 1]:
                length = 1
            count, at = count + 1, at + length
    return count


def test_phrases_against_a_plain_parse():
    rng = random.Random(2)

    def text(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    passages = {"a": [text("abcde ", 80) for _ in range(5)], "b": [text("defgh é", 60) for _ in range(4)]}
    model = language_id.Model(passages)
    model.build()
    texts = [text("abcdefgh é.ß1Q", n) for n in (1, 2, 30, 1023, 1024, 1025, 3000)]
    got = model.phrases(texts)
    for row, t in zip(got, texts, strict=True):
        symbols = language_id.symbols(t, model.table).tolist()
        for column, name in enumerate(model.names):
            own = [language_id.symbols(p, model.table).tolist() for p in passages[name]]
            assert row[column] == plain_phrases(symbols, own), (t[:40], name)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held_out = fold("doc_id", 4) == 2
    model = language_id.learn(docs.filter(~held_out))
    found = docs.filter(held_out).withColumn("found", language_id.predicted(model))
    total, right = found.agg(F.count("lang"), F.count_if(F.col("found.lang_pred") == F.col("lang"))).first()
    assert total > 200 and right / total > 0.98


def test_odd_texts(spark):
    rows = [(1, "der hund und die katze", "de", 0.0), (2, "the dog and the cat", "en", 0.0)] * 3
    odd = [(3, None, "de", 0.0), (4, "", "en", 0.0), (5, "12 %&", "en", 0.0), (6, "the hat", None, 0.0), (None, "die hunde", "de", 0.0)]
    odd += [(7, "und der " * 40_000, "de", 0.0), (8, "日本語", None, 0.0)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    model = language_id.learn(docs.filter("doc_id < 3"))
    found = {r["doc_id"]: r["found"] for r in docs.withColumn("found", language_id.predicted(model)).collect()}
    assert {i: found[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, 7, None)} == {
        1: "de", 2: "en", 3: "und", 4: "und", 5: "und", 6: "en", 7: "de", None: "de",
    }
    assert found[8]["lang_pred"] in ("de", "en")
    assert all(0 <= f["score"] <= 1 for f in found.values()) and found[3]["score"] == 0


@pytest.mark.parametrize("rows", [[], [(1, "text", None, 0.0)]])
def test_nothing_learned(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_id.learn(docs)
    assert model is None
    assert [r["found"]["lang_pred"] for r in docs.withColumn("found", language_id.predicted(model)).collect()] == ["und"] * len(rows)


def test_alphabet_is_bounded():
    alphabet = language_id.Alphabet(["abcabca"], 2)
    out = alphabet.table()
    assert alphabet.size == language_id.FIRST + 2
    assert out[ord("a")] != language_id.UNKNOWN and out[ord("é")] == language_id.UNKNOWN and out[ord(" ")] == language_id.SPACE
    assert np.array_equal(language_id.symbols("a  . b", out), [3, 1, 4])


def test_copies_take_no_passages_from_a_language(spark):
    """A third of all rows is one text of a small language, whose distinct texts reach the bound all the same."""
    rows = [(f"beta text number {i} has its own words", "b") for i in range(300)] + [("one text of beta many times", "b")] * 8000
    rows += [(f"alpha line {i} of a large language", "a") for i in range(16_000)]
    passages = language_id.sample_text(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    assert {k: len(v) for k, v in passages.items()} == {"a": 160, "b": 160}
    assert all(len(set(v)) == 160 for v in passages.values())
