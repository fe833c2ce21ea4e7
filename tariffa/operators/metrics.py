"""Score quality: exact AUC, error measures, ten-way ranking and calibration tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tariffa.config import EXPOSURE_KEY, SEED
from tariffa.functions.columns import keyed_uniform, positive_divide
from tariffa.operators.quantiles import fine_bucket, value_bucket, values_at_ranks
from tariffa.sources.sinks import stored


def exact_auc(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """Exact ROC AUC per group, ties counted half; NULL when a class is absent.

    Scores are counted per distinct value and ordered inside fine order-preserving buckets; totals of
    those are accumulated inside coarse buckets, and the few coarse totals last.  No task sorts a
    whole group.  NaN is above every other score.
    """
    by = list(by)
    counts = (
        df.select(*by, F.col(score).cast("double").alias("__s"), F.col(label).cast("bigint").alias("__y"))
        .filter(F.col("__s").isNotNull() & F.col("__y").isNotNull())
        .groupBy(*by, value_bucket("__s").alias("__b"), fine_bucket("__s").alias("__f"), "__s")
        .agg(F.sum("__y").alias("__pos"), F.sum(1 - F.col("__y")).alias("__neg"))
        .withColumn("__pairs", F.col("__pos") * F.col("__neg") / F.lit(2.0))
    )

    def accumulated(rows: DataFrame, groups: list[str], order: str) -> DataFrame:
        """One row per group: pairs won inside its parts, and those won against the parts before."""
        before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return (
            rows.withColumn("__below", F.coalesce(F.sum("__neg").over(before), F.lit(0)))
            .groupBy(*groups)
            .agg(
                F.sum("__pos").alias("__pos"),
                F.sum("__neg").alias("__neg"),
                F.sum(F.col("__pairs") + F.col("__pos").cast("double") * F.col("__below")).alias("__pairs"),
            )
        )

    fine = accumulated(counts, [*by, "__b", "__f"], "__s")
    buckets = accumulated(fine, [*by, "__b"], "__f")
    earlier = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("__below", F.coalesce(F.sum("__neg").over(earlier), F.lit(0)))
    won = F.sum(F.col("__pairs") + F.col("__pos").cast("double") * F.col("__below"))
    possible = F.sum("__pos").cast("double") * F.sum("__neg")
    return (
        placed.groupBy(*by)
        .agg(
            F.sum("__pos").alias("positives"),
            F.sum("__neg").alias("negatives"),
            won.alias("__won"),
            possible.alias("__possible"),
        )
        .withColumn("auc", F.when(F.col("__possible") > 0, F.col("__won") / F.col("__possible")))
        .drop("__won", "__possible")
    )


def mean_squared(actual: str, predicted: str) -> Column:
    return F.avg((F.col(actual) - F.col(predicted)) * (F.col(actual) - F.col(predicted)))


def mean_absolute(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def prediction_errors(df: DataFrame, by: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Rows, means, mean absolute error, mean squared error and its root."""
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.avg(actual).alias("actual_mean"),
            F.avg(predicted).alias("predicted_mean"),
            mean_absolute(actual, predicted).alias("mae"),
            mean_squared(actual, predicted).alias("mse"),
        )
        .withColumn("rmse", F.sqrt("mse"))
    )


def score_deciles(
    df: DataFrame,
    score: str,
    output: str = "prediction_decile",
    *,
    by: Sequence[str] = (),
    key: Sequence[str] = EXPOSURE_KEY,
    seed: int = SEED,
    keep_cuts: bool = False,
) -> DataFrame:
    """Ten-way bucket of each row by its rank of ``score`` within ``by`` (a handful of groups).

    Rank r of n falls in bucket ``max(1, ceil((r - 1) * 10 / (n - 1)))``.  Equal scores are
    ranked by a draw keyed on ``key``, which any partitioning reproduces.  Only the nine cut
    rows are looked up; every row is then placed by comparing it with them, so the full table
    is neither sorted nor moved.  ``keep_cuts`` looks them up now, for a result that is read many times.
    """
    by = list(by)
    tie = keyed_uniform(key, "rank_tie", seed)
    narrow = df.select(*by, *key, F.col(score).cast("double").alias("__s"))

    def cut_ranks(n: str) -> list[str]:
        return [f"(({n} - 1) * {d}) div 10" for d in range(1, 10)]

    cuts = values_at_ranks(narrow, by, "__s", cut_ranks, few_groups=True).select(
        *[F.col(c).alias(f"__g_{c}") for c in by], F.col("slot").alias("__slot"), F.col("value").alias("__cut"), F.col("offset").alias("__off")
    )
    match = F.col("__s") == F.col("__cut")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    # at most nine cut rows per group
    tied = narrow.join(F.broadcast(cuts), match).select(*by, "__slot", "__cut", "__off", tie.alias("__u"))
    exact = values_at_ranks(
        tied, [*by, "__slot", "__cut", "__off"], "__u", lambda n: ["__off"], few_groups=True
    )
    row = F.struct(F.col("__cut").alias("s"), F.col("value").alias("u"))
    ladder = exact.groupBy(*by).agg(F.collect_list(row).alias("__cuts"))
    if keep_cuts:
        ladder = stored(ladder, "cuts")

    def above(cut: Column) -> Column:
        s = F.col(score).cast("double")
        return F.when(s > cut["s"], F.lit(True)).when(s < cut["s"], F.lit(False)).otherwise(tie > cut["u"])

    if by:
        ladder = ladder.select(*[F.col(c).alias(f"__g_{c}") for c in by], "__cuts")
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
        with_cuts = df.join(F.broadcast(ladder), same, "left").drop(*[f"__g_{c}" for c in by])
    else:
        with_cuts = df.withColumn("__cuts", ladder.scalar())
    return with_cuts.withColumn(
        output, F.when(F.col(score).isNotNull(), F.size(F.filter("__cuts", above)) + 1).cast("int")
    ).drop("__cuts")


def frequency_calibration(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by, "prediction_decile").agg(
        F.count(F.lit(1)).alias("exposures"),
        F.sum("covered_claim_flag").alias("actual_claims"),
        F.avg("covered_claim_flag").alias("actual_frequency"),
        F.avg("pred_frequency").alias("predicted_frequency"),
    )


def severity_calibration(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        scored.groupBy(*by, "prediction_decile")
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.sum("net_loss").alias("actual_total_loss"),
            F.sum("pred_severity").alias("predicted_total_loss"),
            F.avg("net_loss").alias("actual_severity"),
            F.avg("pred_severity").alias("predicted_severity"),
        )
        .withColumn("actual_to_expected", positive_divide("actual_total_loss", "predicted_total_loss"))
    )


def pure_premium_calibration(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (
        scored.groupBy(*by, "prediction_decile")
        .agg(
            F.count(F.lit(1)).alias("exposures"),
            F.sum("covered_claim_flag").alias("actual_claims"),
            F.sum("pred_frequency").alias("predicted_claims"),
            F.sum("net_loss").alias("actual_total_loss"),
            F.sum("pred_expected_loss").alias("predicted_total_loss"),
            F.avg("covered_claim_flag").alias("actual_frequency"),
            F.avg("pred_frequency").alias("predicted_frequency"),
            F.avg("net_loss").alias("actual_pure_premium"),
            F.avg("pred_expected_loss").alias("predicted_pure_premium"),
        )
        .withColumn("actual_to_expected", positive_divide("actual_total_loss", "predicted_total_loss"))
    )
