"""Classes of equal texts against a dictionary, in one batch and in several."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tariffa.llm import exact_dedup
from tariffa.session import new_table_path

ROWS = [
    (1, "a b", "x", 0),
    (2, "a b", "y", 1),
    (7, None, "x", 2),
    (3, "", None, 3),
    (4, "A b", "x", 4),
    (5, "a  b", "x", 5),
    (6, "a b", None, 6),
    (None, "a b", "x", 7),
    (8, "long " * 50_000, "x", 8),
    (8, "long " * 50_000, "x", 8),
    (None, "alone", "x", 9),
]
# further columns whose names the operator uses itself
SCHEMA = "doc_id long, text string, digest string, size int"


def expected(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def answer(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["digest"]) for r in df.collect()), key=str)


def test_classes_with_nulls_repeats_and_clashing_names(spark):
    found = exact_dedup.deduplicate(spark.createDataFrame(ROWS, SCHEMA))
    assert answer(found) == expected(ROWS)
    kept = [r for r in found.collect() if r["kept"]]
    assert len(kept) == len({r["digest"] for r in kept}) == len({t or "" for _, t, *_ in ROWS})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


@pytest.mark.parametrize("weak", [lambda c: F.lit("same"), lambda c: F.length(c).cast("string")])
def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark, weak):
    found = exact_dedup.deduplicate(spark.createDataFrame(ROWS, SCHEMA), digest=weak).collect()
    want = {(i, keep, size) for i, keep, size, _ in expected(ROWS)}
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in found} == want
    assert sum(r["kept"] for r in found) == len({t or "" for _, t, *_ in ROWS})


def test_state_goes_on_where_it_stopped(spark):
    """Two arrivals, several micro-batches each: the state of the first is still there for the second."""
    folder, checkpoint = new_table_path(spark, "arrivals"), new_table_path(spark, "state")
    for part in (range(0, 40), range(20, 60)):
        rows = spark.createDataFrame([(f"d{i % 30}", i, "f", i) for i in part], "digest string, id long, _file string, _row long")
        rows.repartition(3).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        state = exact_dedup.drain(spark, stream, checkpoint)
    found = {r["digest"]: (r["keeper"]["id"], r["size"]) for r in state.collect()}
    arrived = [*range(0, 40), *range(20, 60)]
    assert found == {
        f"d{k}": (max(i for i in arrived if i % 30 == k), sum(i % 30 == k for i in arrived)) for k in range(30)
    }


def test_one_of_each_class_stays_with_all_its_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted({t or "" for _, t, *_ in ROWS})


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.deduplicate(empty).count() == exact_dedup.keep_one(empty).count() == 0
