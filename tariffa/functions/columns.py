"""Column helpers: guarded division, clipping, keyed uniforms, flags.

Everything here is a plain ``Column -> Column`` expression, so it stays inside
whole-stage codegen wherever it is used.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# 13 hex digits of an md5 digest are 52 bits: every value is exact in a double.
_UNIFORM_HEX_DIGITS = 13
_UNIFORM_SCALE = float(2**52)


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_divide(numerator: ColumnLike, denominator: ColumnLike, default: float = 0.0) -> Column:
    """``numerator / denominator``, or ``default`` where the denominator is 0 or missing."""
    num, den = as_column(numerator).cast("double"), as_column(denominator).cast("double")
    return F.when(den != 0, num / den).otherwise(F.lit(default))


def positive_divide(numerator: ColumnLike, denominator: ColumnLike, default: float = 0.0) -> Column:
    """Like :func:`safe_divide`, but only a denominator above 0 counts."""
    num, den = as_column(numerator).cast("double"), as_column(denominator).cast("double")
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def open_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Floating-point ratio without ANSI errors: x/0 is +-inf and 0/0 is missing."""
    num, den = as_column(numerator), as_column(denominator)
    return (
        F.when(den != 0, num / den)
        .when(num > 0, F.lit(float("inf")))
        .when(num < 0, F.lit(float("-inf")))
    )


def cap_above(value: ColumnLike, cap: ColumnLike | float) -> Column:
    """Winsorise from above; a missing value stays missing (``least`` would drop it)."""
    col = as_column(value)
    limit = as_column(cap) if isinstance(cap, (str, Column)) else F.lit(float(cap))
    return F.when(col > limit, limit).otherwise(col)


def clip(value: ColumnLike, low: float | None = None, high: float | None = None) -> Column:
    """Two-sided clip that keeps a missing value missing."""
    col = out = as_column(value)
    if low is not None:
        out = F.greatest(F.lit(float(low)), out)
    if high is not None:
        out = F.least(F.lit(float(high)), out)
    return F.when(col.isNotNull(), out)


def isclose(left: ColumnLike, right: ColumnLike, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    a, b = as_column(left), as_column(right)
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def first_match(cases: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first true condition, in order; unknown conditions do not match."""
    out: Column | None = None
    for condition, value in cases:
        result = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, result) if out is None else out.when(condition, result)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if out is None else out.otherwise(fallback)


def keyed_uniform(key: Sequence[ColumnLike], stream: str, seed: int) -> Column:
    """Uniform draw in [0, 1) that depends only on the row key, a stream name and a seed.

    The draw is the same on any partitioning, after any retry and on any engine that has
    md5, and each named stream is independent of the others.
    """
    parts = [F.coalesce(as_column(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed)), F.lit(stream)))
    head = F.substring(digest, 1, _UNIFORM_HEX_DIGITS)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(_UNIFORM_SCALE)


def weighted_choice(uniform: Column, options: Sequence[tuple[str, float]]) -> Column:
    """Map a uniform draw onto labelled weights (weights add up to 1)."""
    cases, edge = [], 0.0
    for label, weight in options[:-1]:
        edge = round(edge + weight, 12)
        cases.append((uniform < F.lit(edge), label))
    return first_match(cases, options[-1][0])


def adequacy_flag(loss_ratio: ColumnLike, target: float) -> Column:
    """Premium adequacy label.  Rounded first, so float noise at the target cannot flip it."""
    ratio = F.round(as_column(loss_ratio), 9)
    # The label cut-offs above the target are 0.80 and 1.00.
    return first_match(
        [
            (ratio <= target, "within_target"),
            (ratio <= 0.80, "above_target"),
            (ratio <= 1.00, "high_pressure"),
        ],
        "premium_inadequate",
    )
