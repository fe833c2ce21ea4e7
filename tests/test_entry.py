"""The driver contract: names line up, and results match their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tariffa.plans import rounding

TABLES = "region nation customer supplier part orders lineitem".split()
CHECKED = [
    "exposure_table",
    "key_audit",
    "exposure_profile",
    "numeric_quantiles_bucketed",
    "route_freight_summary_bucketed",
    "simulated_losses",
    "rating_by_category",
    "seller_credibility",
    "backtest_month",
    "stress_portfolio",
    "score_deciles",
    "exact_auc",
]


@pytest.fixture(scope="module")
def con(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(rounding.DOUBLE_COLUMNS) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, folder, con, name):
    df = contract.queries()[name](spark, folder)
    result = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    assert doubles == set(rounding.DOUBLE_COLUMNS.get(name, "").split())
    order = sorted(names)
    got = sorted(str(tuple(r[c] for c in order)) for r in df.collect())
    want = sorted(str(tuple(r[names.index(c)] for c in order)) for r in result.fetchall())
    assert got == want
