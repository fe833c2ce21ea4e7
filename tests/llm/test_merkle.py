"""The manifest against a plain tree built level by level."""

from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tariffa.llm import merkle
from tariffa.llm.common import fold

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_field(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def plain_leaf(row):
    return h(*map(plain_field, row))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = range(at - at % 3, min(at - at % 3 + 3, len(nodes)))
        out.append(("".join(nodes[k] for k in run if k < at), "".join(nodes[k] for k in run if k > at)))
        at //= 3
    return out


def plain_manifest(rows):
    """Rows (doc_id, leaf, subroot, root, proof, folded root, verified), sorted as text."""
    ordered = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, plain_leaf(r)))
    sources = []
    for r in ordered:
        if not sources or sources[-1][0][1] != r[1]:
            sources.append([])
        sources[-1].append(r)
    trees = [plain_levels([plain_leaf(r) for r in members]) for members in sources]
    top = plain_levels([t[-1][0] for t in trees])
    out = []
    for s, (members, tree) in enumerate(zip(sources, trees, strict=True)):
        for k, r in enumerate(members):
            steps = plain_path(tree, k) + plain_path(top, s)
            folded = plain_leaf(r)
            if crc32(str(r[0] if r[0] is not None else "").encode()) % 2 == 0 and r[4] is not None:
                folded = plain_leaf((*r[:4], r[4].replace("\n", "")))
            for before, after in steps:
                folded = h(before, folded, after)
            proof = h(*(b + a for b, a in steps))
            out.append((r[0], plain_leaf(r), tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(map(str, out))


def found(docs):
    out = merkle.manifest(docs, fold("doc_id", 2) == 0, F.regexp_replace("text", "\n", ""))
    assert out.columns == merkle.COLUMNS
    return sorted(str(tuple(r)) for r in out.collect())


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_against_a_plain_tree(spark, monkeypatch, levels):
    """A source over many blocks and rounds, sources of one row, nulls, repeated rows, long and empty texts."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [(i, "hot", "en", i, f"line {i}\nnext" if i % 3 else "no line end") for i in range(160 if levels < 5 else 500)]
    rows += [(1000 + i, f"s{i % 11}", None, None, "x\ny") for i in range(60)]
    rows += [(2000, None, None, None, None), (2001, None, "de", 0, ""), (None, "hot", "en", 1, "a\nb"), (2002, "", "en", 3, "\n\n\n")]
    rows += [(2003, "ünï", "en", 5, "é\n" * 50_000), (2004, "single", "en", 1, "z"), (2005, "twice", "en", 1, "z\n"), (2005, "twice", "en", 1, "z\n")]
    rows += [(2006, "twice", "en", 1, "one\n"), (2006, "twice", "en", 1, "two\n"), (-7, "hot", "fr", 2, "less\nthan all")]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7)) == plain_manifest(rows)


def test_one_document_and_none(spark):
    one = [(4, None, None, None, "a\nb")]
    assert found(spark.createDataFrame(one, SCHEMA)) == plain_manifest(one)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_further_columns_with_clashing_names(spark, tmp_path):
    rows = [(i, "a" if i % 2 else None, "en", 3, "x\n") for i in range(20)]
    plain = spark.createDataFrame(rows, SCHEMA)
    extra = plain.withColumns({c: F.lit(1) for c in ("id", "group", "at", "total", "digest", "place", "_file", "_metadata", "steps")})
    extra.write.parquet(str(tmp_path / "docs"))
    assert found(spark.read.parquet(str(tmp_path / "docs"))) == found(plain) == plain_manifest(rows)


def test_a_version_shares_all_but_its_ancestors():
    tree = merkle.build([f"{i:x}" * 64 for i in range(9)], 2)
    steps = merkle.path(tree, 4)
    assert merkle.version(tree[0][4], steps) == tree[2][0]
    changed = merkle.version("f" * 64, steps)
    nodes = list(tree[0])
    nodes[4] = "f" * 64
    assert changed == merkle.build(nodes, 2)[2][0] != tree[2][0]
