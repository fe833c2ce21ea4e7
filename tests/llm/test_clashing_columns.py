"""Tables with further columns of any name pass through the stages that keep documents, with nulls, ties and repeated rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tariffa.llm import exact_dedup, mixing, simhash

FOLDER = "/root/testdata/sf0.001"
NAMES = ("_file", "_row", "_metadata", "_size", "_count", "_words", "_spans", "_turn", "id", "size", "c0", "c1", "digest", "a.b")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(i, f"some words that number {i} holds " * (i % 5 + 1), "en", "a" if i % 3 else None, 1) for i in range(40)]
ROWS += [(50, None, None, None, None), (51, "", "en", "a", 0), (None, "no identifier", "en", "b", 3), (0, ROWS[0][1], "en", None, 1)]
ROWS += [(52, ROWS[7][1], "en", "a", 1), (53, ROWS[7][1], "en", "a", 1), (54, "w " * 60_000, "en", "b", 120_000)]


def docs_with(spark, folder, names):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in names})
    docs.write.parquet(str(folder))
    return spark.read.parquet(str(folder))


STEPS = {
    "exact": exact_dedup.keep_one,
    "near": simhash.keep_one,
    "mix": lambda docs: mixing.mixed_documents(mixing.mix(docs)),
}


@pytest.mark.parametrize("name", STEPS)
def test_same_rows_as_without_further_columns(spark, tmp_path, name):
    plain, wide = docs_with(spark, tmp_path / "plain", ()), docs_with(spark, tmp_path / "wide", NAMES)
    want, got = STEPS[name](plain), STEPS[name](wide)
    assert got.columns == wide.columns
    rows = [r.asDict() for r in got.collect()]
    assert all(r[c] == f"own {c}" for r in rows for c in NAMES)
    # the mix draws by where rows lie only among ties, so the identifiers agree everywhere
    assert sorted(str((r["doc_id"], r["source"])) for r in rows) == sorted(str((r["doc_id"], r["source"])) for r in want.collect())


def test_all_stages_on_awkward_rows(spark, tmp_path):
    docs = docs_with(spark, tmp_path / "docs", NAMES)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, FOLDER)
        assert k == 4 or after.columns == docs.columns
        after.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
    found = docs.collect()
    assert found and all(r["parity"] and r["round_trip"] for r in found)
    assert not {50, 51} & {r["doc_id"] for r in found} and 54 in {r["doc_id"] for r in found}


def test_all_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        assert docs.count() == 0
