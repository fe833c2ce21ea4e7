"""The pipeline's stages, each against a plain version on the stage's own input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tariffa.llm import mixing, sentencepiece_codec, toxicity
from tariffa.llm.common import fold, table
from tariffa.sources.sinks import stored

from .test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs, out = table(spark, FOLDER, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, FOLDER), "stage")
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_but_the_last_return_documents(stages):
    columns = stages[0][0].columns
    assert len(stages) == 5 and all(after.columns == columns for _, after in stages[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages[0]
    labels = table(spark, FOLDER, "labels")
    model = toxicity.learn(before, labels, fold("doc_id", 5) != 0)
    scores = before.select("doc_id", toxicity.score(model).alias("s")).collect()
    assert ids(after) == sorted(r["doc_id"] for r in scores if r["s"] < 0.5)
    clean = before.join(labels.filter("toxic = 0"), "doc_id")
    assert clean.join(after, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_one_of_each_class_of_copies(stages):
    before, after = stages[1]
    keep = {}
    for r in before.collect():
        text = r["text"] or ""
        keep[text] = max(r["doc_id"], keep.get(text, -1))
    assert ids(after) == sorted(keep.values())


def test_one_of_each_group_of_near_copies(stages):
    before, after = stages[2]
    rows = before.collect()
    roots = plain_components([plain_fingerprint(r["text"]) for r in rows])
    least = {}
    for r, root in zip(rows, roots, strict=True):
        least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
    assert ids(after) == sorted(least.values())


def test_words_taken_meet_the_targets(stages):
    before, after = stages[3]
    size = F.size(mixing.word_list("text"))
    sizes = {r[0]: r[1] for r in before.groupBy("source").agg(F.sum(size)).collect()}
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal = mixing.targets([sizes[s] for s in names], [float(i % 3 + 1) for i in range(len(names))], 3)
    taken = {r[0]: r[1] for r in after.groupBy("source").agg(F.sum(size)).collect()}
    for name, target in zip(names, goal, strict=True):
        assert abs(taken[name] - target) <= 2 * 128 + 0.02 * target
    own = {r["doc_id"]: r[1] for r in before.select("doc_id", size).collect()}
    assert all(r[1] <= 3 * own[r[0]] for r in after.groupBy("doc_id").agg(F.sum(size)).collect())


def test_token_ids_are_the_library_s(stages):
    before, after = stages[4]
    theirs = SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    want = sorted((r["doc_id"], theirs.encode(r["text"] or "")) for r in before.collect())
    assert sorted((r["doc_id"], r["token_ids"]) for r in after.collect()) == want
    assert after.filter("not parity or not round_trip or n_tokens <> size(token_ids)").count() == 0


def test_run_is_all_stages(spark, stages):
    whole = corpus_pipeline.run(spark, FOLDER)
    columns = ["doc_id", "n_tokens", "token_ids"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, stages[-1][1].select(columns).collect()))
