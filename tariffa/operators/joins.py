"""Dimension joins that stay balanced, and the key contracts behind them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffa.sources.sinks import stored

# A key counts as hot when it holds at least this share of the fact rows, so there can never
# be more than 1/HOT_SHARE hot keys.
HOT_SHARE = 0.001
# Rows of a hot key that one salt takes, and the salts of rows without a key.
ROWS_PER_SALT = 1_000_000
SALTS = 32
# A derived table is broadcast if it has no more rows than this and takes no more room on disk.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 * 2**20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size of everything the plan reads.

    Dimensions here are built by projections, aggregates and left joins on unique keys, which
    do not multiply rows, so what they read bounds what they hold.  (Catalyst's own figure for
    a join is the product of both sides.)
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    units = {"k": 2**10, "m": 2**20, "g": 2**30}
    text = text.lower().rstrip("b")
    return int(float(text[:-1]) * units[text[-1]]) if text[-1:] in units else int(text)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a derived table only if it really is small.

    It is when all it reads fits Spark's broadcast limit.  Otherwise it is written, counted and
    broadcast if few rows came out.  Above ``max_rows`` it comes back without a hint: Spark then
    shuffles the join and splits skewed partitions at run time.
    """
    if estimated_bytes(df) <= broadcast_limit(df):
        return F.broadcast(df)
    held = stored(df, "small")
    return F.broadcast(held) if few(held, max_rows) else held


def few(held: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table is small in rows and in bytes."""
    return estimated_bytes(held) <= max(BROADCAST_BYTES, broadcast_limit(held)) and held.count() <= max_rows


def hot_keys(key_source: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    """Keys that hold at least ``share`` of the rows, with their counts: never more than ``1 / share``.

    A frequent-items sketch has a bounded state, so this is one narrow pass with nothing to
    shuffle.  The list is fixed once, as literals, so both join sides and every retried task
    see the same one.  It only decides how rows are routed; it never changes a result.
    """
    most = int(1 / share)
    summary = (
        key_source.filter(F.col(key).isNotNull())
        .agg(
            F.expr(f"approx_top_k(`{key}`, {most}, {most * 10})").alias("top"),
            F.count(F.lit(1)).alias("row_count"),
        )
        .first()
    )
    return {t["item"]: t["count"] for t in summary["top"] or [] if t["count"] >= summary["row_count"] * share}


def dimension_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    *,
    key_source: DataFrame | None = None,
    row_key: Sequence[str] = (),
    derived: bool = False,
    rows_per_salt: int = ROWS_PER_SALT,
    may_broadcast: bool = True,
) -> DataFrame:
    """Left join to a table with a unique ``key``, whatever the sizes and however hot a key is.

    A dimension below Spark's broadcast limit is broadcast.  So is a ``derived`` one (an
    aggregate of a large table) once its rows have been counted and found few.  A larger one
    is shuffled; rows of hot keys are then spread over salts, one for each ``rows_per_salt`` of the key's rows, and only the
    dimension rows of those few keys are repeated, so a key with a third of all rows still
    ends up in many tasks.
    """
    if may_broadcast and estimated_bytes(dimension) <= broadcast_limit(dimension):
        return fact.join(F.broadcast(dimension), key, "left")
    if may_broadcast and derived:
        dimension = stored(dimension, "dimension")
        if few(dimension):
            return fact.join(F.broadcast(dimension), key, "left")

    hot = hot_keys(fact if key_source is None else key_source, key)
    mixed = F.xxhash64(*(row_key or [c for c in fact.columns if c != key]))
    known = F.col(key).isNotNull()
    salts = F.lit(1)
    if hot:
        table = F.create_map(*[F.lit(x) for k, n in hot.items() for x in (k, max(2, -(-n // rows_per_salt)))])
        salts = F.coalesce(table[F.col(key)], F.lit(1))
    # rows without a key find no partner, wherever they go
    salted_fact = fact.withColumn("__salt", F.pmod(mixed, F.when(known, salts).otherwise(F.lit(SALTS))).cast("int"))
    salted_dimension = dimension.filter(known).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int")))
    )
    return salted_fact.join(salted_dimension, [key, "__salt"], "left").drop("__salt")


def key_uniqueness(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """One row per table: rows, distinct keys, duplicated keys and whether the key is unique."""
    parts = []
    for name, df in tables.items():
        per_key = df.groupBy(*keys[name]).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_key.agg(
                F.lit(name).alias("table_name"),
                F.lit("+".join(keys[name])).alias("key_columns"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
                F.count(F.lit(1)).alias("distinct_keys"),
                F.count_if(F.col("n") > 1).alias("duplicated_keys"),
            ).withColumn("is_unique", F.when(F.col("duplicated_keys") == 0, 1).otherwise(0))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def assert_unique(df: DataFrame, key: Sequence[str], name: str = "dimension") -> None:
    """Raise if a key repeats (the many-to-one contract).  Runs one aggregation."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{name}: key {list(key)} is not unique")


def match_rate(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    """Share of non-missing left keys that find a partner.

    Both sides are reduced to one row per key before the join, so a hot key is one row.
    """
    counted = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = right.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("hit", F.lit(1))
    return counted.join(known, key, "left").agg(
        F.lit(label).alias("join_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)), F.lit(0))
        .cast("bigint")
        .alias("matched_rows"),
    ).withColumn(
        "match_rate",
        F.when(F.col("left_rows") > 0, F.col("matched_rows") / F.col("left_rows")).otherwise(0.0),
    )
