"""Deleted interpolation against a plain version with dictionaries."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tariffa.llm import lm
from tariffa.llm.common import words_of

SCHEMA = "doc_id long, text string, token long, n string"


def texts(count=300, seed=4):
    rng = random.Random(seed)
    after = {w: [f"w{rng.randrange(60)}" for _ in range(4)] for w in [f"w{i}" for i in range(60)]}
    rows = []
    for i in range(count):
        word, out = "w0", []
        for _ in range(rng.randrange(1, 60)):
            out.append(word.upper() if rng.random() < 0.1 else word)
            word = rng.choice(after[word]) if rng.random() < 0.8 else f"x{rng.randrange(3000)}"
            after.setdefault(word, ["w1"])
        rows.append((i, " ".join(out), 0, ""))
    return rows + [(900, None, 0, ""), (901, "", 0, ""), (902, "É é x\x0by", 0, ""), (5, "w0 w1", 0, ""), (None, "w2 w3", 0, "")]


def part_of(i):
    return 0 if i is None else {0: 0, 1: 2}.get(i % 10, 1)


def plain(rows, contexts):
    """score and base score of every text; weights from exact logarithms instead of stepped ones."""
    word, pair, head = ([Counter(), Counter(), Counter()] for _ in range(3))
    split = [(i, part_of(i), words_of(t) + [None]) for i, t, *_ in rows]
    for _, part, tokens in split:
        for before, token in zip([b" ", *tokens], tokens, strict=False):
            word[part][token] += 1
            pair[part][before, token] += 1
            head[part][before] += 1
    both = {k: v[1] + v[2] for k, v in (("word", word), ("pair", pair), ("head", head))}
    total, kept = sum(both["word"].values()), sum(word[1].values())
    known = {w for w, c in both["word"].items() if w is not None and (contexts is None or c * contexts >= total)} | {b" "}
    size = len(both["word"]) + 1

    def step(p):
        return 2 ** (round(math.log2(p) * 4) / 4) if p else 0.0

    stats = {}
    for (before, token), count in pair[2].items():
        p1 = step(word[1][token] / kept)
        heads = head[1][before]
        if before in known and heads:
            key = int(lm.bucket(np.array([heads / kept]))[0])
            row = (step(pair[1][before, token] / heads), p1, 1 / size)
        else:
            key, row = None, (p1, 1 / size)
        stats.setdefault(key, []).append((count, row))
    weights = {
        k: lm.expectation_maximisation(np.array([c for c, _ in v], float), np.array([r for _, r in v])) for k, v in stats.items()
    }
    out = []
    for i, _, tokens in split:
        score = base = 0.0
        for before, token in zip([b" ", *tokens], tokens, strict=False):
            p1 = both["word"][token] / total
            if before in known and both["head"][before]:
                b = int(lm.bucket(np.array([both["head"][before] / total]))[0])
                key = min((k for k in weights if k is not None), key=lambda k, b=b: (abs(k - b), k))
                row = (both["pair"][before, token] / both["head"][before], p1, 1 / size)
            else:
                key, row = None, (p1, 1 / size)
            score += math.log10(sum(a * b for a, b in zip(weights[key], row, strict=True)))
            base += math.log10((both["word"][token] + 0.1) / (total + 0.1 * size))
        out.append((i, len(tokens), sum(both["word"][t] > 0 for t in tokens), total, base, score))
    return out


# the last: pieces that cut texts, and many ranges of keys
@pytest.mark.parametrize("contexts", [24, None])
@pytest.mark.parametrize("sizes", [{}, {"piece_tokens": 37, "range_keys": 500}])
def test_scores(spark, contexts, sizes):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    rest = F.col("doc_id") % 10
    part = F.when(F.coalesce(rest, F.lit(0)) == 0, lm.OTHER).when(rest == 1, lm.HELD).otherwise(lm.RETAINED)
    found = lm.score(docs, part, contexts=contexts, **sizes).collect()
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted((tuple(r[c] for c in columns) for r in found), key=lambda r: (str(r[0]), r[1]))
    want = sorted(plain(rows, contexts), key=lambda r: (str(r[0]), r[1]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)
    held = [r for r in got if r[0] is not None and r[0] % 10 == 0]
    assert sum(r[5] for r in held) > sum(r[4] for r in held)


def test_mixture_sums_to_one():
    """Over a context's words, and the unknown one."""
    weights = lm.expectation_maximisation(np.array([3.0, 1.0]), np.array([[0.5, 0.1, 0.01], [0.0, 0.2, 0.01]]))
    assert weights.sum() == pytest.approx(1) and (weights > 0).all()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", 0, ""), (2, None, 0, "")], SCHEMA)
    rows = {r["doc_id"]: r for r in lm.score(docs, F.lit(lm.OTHER)).collect()}
    assert rows[1]["n_tokens"] == 3 and rows[2]["n_tokens"] == 1 and rows[1]["n_known"] == rows[1]["train_tokens"] == 0
    assert rows[1]["score"] <= 0 and rows[1]["base_score"] == pytest.approx(0)
    assert lm.score(docs.limit(0), F.lit(lm.RETAINED)).count() == 0


def test_rare_contexts_have_pair_estimates(spark):
    """All contexts, each far below one word in 256: the pair decides, and an unseen context has none."""
    rows = [(i, " ".join(f"a{(i * 7 + j) % 700} b{(i * 7 + j) % 700}" for j in range(60)), 0, "") for i in range(300)]
    rows += [(1000, "a1 b1 a2 b2", 0, ""), (1010, "b1 a1 b2 a2", 0, ""), (1020, "new b1", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    rest = F.col("doc_id") % 10
    part = F.when(rest == 0, lm.OTHER).when(rest == 1, lm.HELD).otherwise(lm.RETAINED)
    for sizes in ({}, {"piece_tokens": 50, "range_keys": 1000}):
        got = {r["doc_id"]: r for r in lm.score(docs, part, **sizes).collect()}
        assert got[1000]["base_score"] == pytest.approx(got[1010]["base_score"], rel=1e-2)
        assert got[1000]["score"] > got[1010]["score"] + 4
        assert got[1020]["n_tokens"] == 3 and got[1020]["n_known"] == 2
        assert all(got[i]["score"] > 0.6 * got[i]["base_score"] for i in range(0, 300, 10))


def test_learned_contexts_add_up(spark):
    """Over the vocabulary and one unknown word, the probabilities after a rare word sum to one."""
    words = [f"v{i}" for i in range(40)]
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(words, k=30)), 0, "") for i in range(1, 10)]
    # every continuation of v3, the unknown word and the end included
    rows += [(10 + 10 * k, f"v3 {w}", 0, "") for k, w in enumerate([*words, "unknown"])] + [(9000, "v3", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    part = F.when(F.col("doc_id") >= 10, lm.OTHER).when(F.col("doc_id") == 1, lm.HELD).otherwise(lm.RETAINED)
    counts = lm.count(docs, part)
    weights = lm.learn_weights(counts)
    answers = counts.answers.toPandas()
    head = lm.xxh64_intdigest(b"v3")
    lp = {}
    for _, row in counts.pieces.toPandas().iterrows():
        piece = lm.Piece.of(row)
        own = answers[(answers["start"] == row["start"]) & (answers["offset"] == row["offset"])]
        scores = lm.pair_scores(piece, lm.facts_of(piece, own, counts.ranges), counts, weights)
        lp |= {int(piece.words[t]): x for t, c, x in zip(piece.token, piece.context, scores, strict=True) if int(piece.words[c]) == head and c}
    keys = [lm.xxh64_intdigest(w.encode()) for w in [*words, "unknown"]] + [lm.END]
    assert sum(10 ** lp[k] for k in keys) == pytest.approx(1)


def test_awkward_rows(spark):
    """Texts of any length, repeated rows, nulls, further columns with clashing names."""
    long = " ".join(f"a{i % 50}" for i in range(30_000))
    rows = [(1, long, 0, "x"), (1, long, 0, "x"), (2, None, 1, None), (3, "", 1, None), (2**60 + 1, "a1 a2", 1, None), (None, "a1", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long, part string")
    got = [r.asDict() for r in lm.score(docs, F.lit(lm.RETAINED), piece_tokens=1000, range_keys=100).collect()]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"]) for r in got) == sorted(
        [("1", 30_001, 30_001)] * 2 + [("2", 1, 1), ("3", 1, 1), (str(2**60 + 1), 3, 3), ("None", 2, 2)]
    )
    assert {r["train_tokens"] for r in got} == {60_009}
    assert len({round(r["score"], 6) for r in got if r["doc_id"] == 1}) == 1


def test_packed_numbers():
    for values in ([], [0], [1, 2**64 - 1, 5], range(1000)):
        numbers = np.array(values, np.uint64)
        assert (lm.unpack(lm.pack(numbers)) == numbers).all()
