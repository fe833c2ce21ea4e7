"""Totals and distinct counts over several segmentations in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.operators.joins import SALTS, estimated_bytes, hot_keys
from tariffa.sources.sinks import bucket_count


# An identifier with this share of the rows is dealt over several tasks; there are 50 of those at most.
HOT_IDENTIFIER = 0.02
# Spark's size of a table that did not come from files.
UNKNOWN_BYTES = 2**60


def identifier_partitions(rows: DataFrame, identifiers: int) -> int:
    """Partitions of rows dealt by each of their identifiers: by what the plan reads, or the session's own number if that is not known."""
    if estimated_bytes(rows) >= UNKNOWN_BYTES:
        return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucket_count(rows) * identifiers


def segment_totals(
    rows: DataFrame, segmentations: Sequence[Sequence[str]], sums: dict[str, Column], distinct: dict[str, str]
) -> DataFrame:
    """One row per segment of each segmentation: ``segmentation`` (its place in the list), the grouping columns (missing where
    a segmentation does not use them), the totals of ``sums`` and the distinct counts (name to column).

    A row is dealt once by each identifier, not once by each pair of an identifier and a segment: where all rows of an identifier are
    together, its pairs are made, combined and counted in place, and only a row a segment and task is shuffled after that.  The values to be
    added up travel with the first identifier alone.  Rows without an identifier, or with one that holds a large share of all rows, are
    spread over salts; the few identifiers of that kind are counted as sets.
    """
    columns = list(dict.fromkeys(c for groups in segmentations for c in groups))
    kinds = {c: rows.schema[c].dataType for c in columns}
    where = ["segmentation", *columns]
    identifiers = list(distinct.values())
    hot = {c: list(hot_keys(rows, c, HOT_IDENTIFIER)) for c in dict.fromkeys(identifiers)}
    dealt_by = F.array(
        *[
            F.struct(
                F.lit(i).alias("__kind"),
                F.col(c).cast("string").alias("__id"),
                F.coalesce(F.col(c).isin(hot[c]), F.lit(True)).alias("__crowded"),
            )
            for i, c in enumerate(identifiers)
        ]
    )
    segments = F.array(
        *[
            F.struct(
                F.lit(k).alias("segmentation"),
                *[(F.col(c) if c in groups else F.lit(None).cast(kinds[c])).alias(c) for c in columns],
            )
            for k, groups in enumerate(segmentations)
        ]
    )
    values = F.struct(*[expr.alias(name) for name, expr in sums.items()])
    salt = F.pmod(F.xxhash64(*identifiers), F.lit(SALTS)).cast("int")
    home = ["__kind", "__id", "__crowded", "__salt"]
    dealt = (
        rows.select(*columns, values.alias("__values"), salt.alias("__salt"), F.inline(dealt_by))
        .withColumns(
            {
                "__salt": F.when(F.col("__crowded"), F.col("__salt")).otherwise(F.lit(0)),
                "__values": F.when(F.col("__kind") == 0, F.col("__values")),
            }
        )
        .repartition(identifier_partitions(rows, len(identifiers)), *home)
    )
    pairs = dealt.select(*home, "__values", F.inline(segments)).groupBy(*home, *where).agg(
        *[F.sum(F.col("__values").getField(name)).alias(name) for name in sums]
    )

    def counted(i: int) -> Column:
        own = (F.col("__kind") == i) & F.col("__id").isNotNull()
        crowded = F.size(F.collect_set(F.when(own & F.col("__crowded"), F.col("__id")))).cast("bigint")
        return F.count_if(own & ~F.col("__crowded")) + crowded

    # one whole portfolio has a row even if it is empty
    whole = not columns and len(segmentations) == 1
    out = pairs.groupBy(*([] if whole else where)).agg(
        *[F.sum(name).alias(name) for name in sums], *[counted(i).alias(name) for i, name in enumerate(distinct)]
    )
    return out.select(F.lit(0).alias("segmentation"), "*") if whole else out
