"""Exact order statistics without sorting or gathering a whole group, the same way at every size.

A group is first counted over an order-preserving bucket number (bounded, combined map-side);
running counts over those few buckets tell which ones hold the wanted ranks.  The same is done once
more over 65,536 finer buckets inside each of those; only values inside the fine buckets found are then
ordered.  A fine bucket is narrower than three billionths of its value, so it holds few distinct values even when a
column lies far from zero.  A group may hold any share of the rows and no task ever sees all of it.
Missing values and NaN are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.operators.joins import checked_broadcast

# Buckets per doubling of the value (twenty doublings give about 80,000), and fine buckets in each.
_BUCKETS_PER_OCTAVE = 4096
_FINE_BUCKETS = 1 << 16
_EXPONENT_SHIFT = 1100  # larger than any double exponent, so scaled logs stay positive
_OUTER_BUCKET = 1 << 40

RankRule = Callable[[str], Sequence[str]]


def _scaled_sql(v: str) -> str:
    return f"((log2(abs({v})) + {_EXPONENT_SHIFT}) * {_BUCKETS_PER_OCTAVE})"


def _signed_sql(v: str, zero: str, infinite: str, positive: str) -> str:
    """NaN is above everything else, as in Spark's own order."""
    return (
        f"CASE WHEN {v} = 0 THEN {zero} WHEN isnan({v}) THEN 2 * {infinite}"
        f" WHEN abs({v}) = double('Infinity') THEN CAST(sign({v}) AS BIGINT) * {infinite}"
        f" WHEN {v} > 0 THEN {positive} ELSE -({positive}) END"
    )


def bucket_sql(v: str) -> str:
    """Monotone bucket number: ``a <= b`` implies ``bucket(a) <= bucket(b)``."""
    return _signed_sql(v, "0L", f"{_OUTER_BUCKET}L", f"CAST(floor({_scaled_sql(v)}) AS BIGINT) + 1")


def fine_bucket_sql(v: str) -> str:
    """Monotone number inside a bucket."""
    scaled = _scaled_sql(v)
    return _signed_sql(v, "0L", "0L", f"CAST(floor(({scaled} - floor({scaled})) * {_FINE_BUCKETS}) AS BIGINT)")


def value_bucket(value: str) -> Column:
    return F.expr(bucket_sql(value))


def fine_bucket(value: str) -> Column:
    return F.expr(fine_bucket_sql(value))


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def values_at_ranks(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    ranks: RankRule,
    *,
    weight: str | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Values at 0-based ranks within each group of ``by``, in ascending ``value`` order.

    ``ranks`` maps the group's row count (a SQL name) to the wanted ranks (SQL).  One row per
    (group, slot): ``by``, ``n`` (rows in the group), ``slot`` (position in the rank list),
    ``rank``, ``value`` and ``offset`` (the rank counted among the rows that share that value).
    ``weight`` is a column of row counts for input that is already grouped.  ``few_groups``
    promises that the groups themselves are a fixed handful.
    """
    keys = _quoted(by)
    weight_sql = f"CAST(`{weight}` AS BIGINT)" if weight else "1L"
    rows = (
        df.selectExpr(*keys, f"CAST(`{value}` AS DOUBLE) AS __v", f"{weight_sql} AS __w")
        .filter("__v IS NOT NULL AND NOT isnan(__v) AND __w > 0")
        .selectExpr("*", f"{bucket_sql('__v')} AS __b", f"{fine_bucket_sql('__v')} AS __f")
    )
    wanted = ", ".join(f"CAST({r} AS BIGINT)" for r in ranks("n"))
    held = "exists(__ranks, r -> r >= __before AND r < __before + __c)"

    def over(*columns: str) -> str:
        return f"PARTITION BY {', '.join(columns)}" if columns else ""

    def at(found: DataFrame, *levels: str) -> DataFrame:
        """Rows inside the buckets found, with what is known about each bucket."""
        columns = [*by, *levels]
        renamed = found.selectExpr(*[f"`{c}` AS `__t_{c}`" for c in columns], "n", "__before", "__ranks")
        target = F.broadcast(renamed) if few_groups else checked_broadcast(renamed)
        return rows.join(target, F.expr(" AND ".join(f"`{c}` <=> `__t_{c}`" for c in columns)))

    coarse = (
        rows.groupBy(*by, "__b")
        .agg(F.expr("sum(__w)").alias("__c"))
        .selectExpr(
            "*",
            f"sum(__c) OVER ({over(*keys)}) AS n",
            f"sum(__c) OVER ({over(*keys)} ORDER BY __b ROWS UNBOUNDED PRECEDING) - __c AS __before",
        )
        .selectExpr("*", f"array({wanted}) AS __ranks")
        .filter(held)
    )
    fine = (
        at(coarse, "__b")
        .groupBy(*by, "__b", "__f", "n", "__before", "__ranks")
        .agg(F.expr("sum(__w)").alias("__c"))
        .selectExpr(
            *keys, "__b", "__f", "n", "__ranks", "__c",
            f"__before + sum(__c) OVER ({over(*keys, '__b')} ORDER BY __f ROWS UNBOUNDED PRECEDING) - __c AS __before",
        )
        .filter(held)
    )
    return (
        at(fine, "__b", "__f")
        .groupBy(*by, "__b", "__f", "n", "__before", "__ranks", "__v")
        .agg(F.expr("sum(__w)").alias("__c"))
        .selectExpr(
            *keys, "n", "__v", "__c", "__ranks",
            f"__before + sum(__c) OVER ({over(*keys, '__b', '__f')} ORDER BY __v ROWS UNBOUNDED PRECEDING) - __c AS __start",
        )
        .selectExpr(*keys, "n", "posexplode(__ranks) AS (slot, rank)", "__v AS value", "__start", "__c")
        .filter("rank >= __start AND rank < __start + __c")
        .selectExpr(*keys, "n", "slot", "rank", "value", "rank - __start AS offset")
    )


def unpivoted(df: DataFrame, by: Sequence[str], columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Long form: ``by``, ``field``, ``value`` (and the weight), one row per source column."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    extra = [weight] if weight else []
    return df.selectExpr(*_quoted([*by, *extra]), f"stack({len(columns)}, {pairs}) AS (field, value)")


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    weight: str | None = None,
    few_groups: bool | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles: ``by``, ``field``, ``n``, ``q`` (array of double).

    Missing values and NaN are skipped; a group without values has no row.
    """
    by = list(by)
    few = not by if few_groups is None else few_groups

    def ranks(n: str) -> list[str]:
        out = []
        for p in probabilities:
            out += [f"floor(({n} - 1) * {float(p)!r}D)", f"ceil(({n} - 1) * {float(p)!r}D)"]
        return out

    found = values_at_ranks(
        unpivoted(df, by, columns, weight), [*by, "field"], "value", ranks, weight=weight, few_groups=few
    )
    picked = found.groupBy(*by, "field", "n").agg(
        *[F.expr(f"max(CASE WHEN slot = {i} THEN value END)").alias(f"__v{i}") for i in range(2 * len(probabilities))]
    )
    q = []
    for i, p in enumerate(probabilities):
        lo, hi, position = f"__v{2 * i}", f"__v{2 * i + 1}", f"(n - 1) * {float(p)!r}D"
        q.append(f"CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} + ({hi} - {lo}) * ({position} - floor({position})) END")
    return picked.selectExpr(*_quoted([*by]), "field", "n", f"array({', '.join(q)}) AS q")


def quantile_columns(
    df: DataFrame,
    by: Sequence[str],
    wanted: dict[str, tuple[str, float]],
    *plain: Column,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with ordinary aggregates and named exact quantiles.

    ``wanted`` is like ``{"price_median": ("price", 0.5), ...}``.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    probabilities = sorted({p for _, p in wanted.values()})
    long = quantiles(df, by, columns, probabilities, weight=weight)
    exact = long.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("field") == column, F.col("q")[probabilities.index(p)])).alias(name)
            for name, (column, p) in wanted.items()
        ]
    )
    # kept apart from the plain aggregates: a distinct count among those would multiply the rows
    if not plain:
        return exact
    table = df.groupBy(*by).agg(*plain)
    if not by:
        whole = exact.select(F.struct(*wanted)).scalar()
        return table.select("*", *[whole.getField(name).alias(name) for name in wanted])
    renamed = exact.selectExpr(*[f"`{c}` AS `__k_{c}`" for c in by], *_quoted(list(wanted)))
    same = F.expr(" AND ".join(f"`{c}` <=> `__k_{c}`" for c in by))
    return table.join(renamed, same, "left").drop(*[f"__k_{c}" for c in by])
