"""Outlier flags. Statistics enter as scalar subqueries, so rows are neither joined nor shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.operators.columns import number, ref
from rowproof.operators.quantiles import MAX_VALUES_IN_TASK, quantile_values
from rowproof.operators.statistics import IQR_FENCE, STD_FENCE, as_micros


def _scalar_struct(df: DataFrame, fields: dict[str, Column]) -> Column:
    """One-row aggregate of `df` as a struct value."""
    return df.agg(F.struct(*(v.alias(k) for k, v in fields.items())).alias("s")).scalar()


def bounds_flag(x: Column, lower: Column, upper: Column) -> Column:
    """True outside the bounds; null and NaN are false."""
    outside = (x < lower) | (x > upper)
    return F.coalesce(outside & ~F.isnan(x), F.lit(False))


def z_scores(
    df: DataFrame, columns: Sequence[str], null_fill: float | None = 0.0
) -> dict[str, Column]:
    """Absolute z-score per column, with the population deviation; nulls and NaN are taken as `null_fill`."""

    def filled(c: str) -> Column:
        x = number(c)
        return x if null_fill is None else F.coalesce(x, F.lit(float(null_fill)))

    if not columns:
        return {}
    fields = {}
    for i, c in enumerate(columns):
        fields |= {f"mean{i}": F.avg(filled(c)), f"std{i}": F.stddev_pop(filled(c))}
    stats = _scalar_struct(df, fields)
    return {
        c: F.abs(F.try_divide(filled(c) - stats[f"mean{i}"], stats[f"std{i}"]))
        for i, c in enumerate(columns)
    }


def z_flags(
    df: DataFrame, columns: Sequence[str], null_fill: float | None = 0.0
) -> dict[str, Column]:
    """`{column}_isOutlier`: more than three deviations from the mean.

    With infinite values the deviation is no number, and nothing is flagged.
    """
    return {
        f"{c}_isOutlier": F.coalesce(F.nanvl(z, F.lit(0.0)) > STD_FENCE, F.lit(False))
        for c, z in z_scores(df, columns, null_fill).items()
    }


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], max_values_in_task: int = MAX_VALUES_IN_TASK
) -> dict[str, tuple[Column, Column]]:
    """Lower and upper fence per column: quartiles widened by 1.5 interquartile ranges."""
    if not columns:
        return {}
    quantiles = quantile_values(df, columns, [0.25, 0.75], max_values_in_task)
    stats = _scalar_struct(df, {f"q{i}": quantiles[c] for i, c in enumerate(columns)})
    bounds = {}
    for i, c in enumerate(columns):
        q1, q3 = stats[f"q{i}"][0], stats[f"q{i}"][1]
        bounds[c] = (q1 - (q3 - q1) * IQR_FENCE, q3 + (q3 - q1) * IQR_FENCE)
    return bounds


def iqr_flags(
    df: DataFrame, columns: Sequence[str], max_values_in_task: int = MAX_VALUES_IN_TASK
) -> dict[str, Column]:
    """`{column}_iq_outlier`: outside the fences; nulls and NaN do not count and are not flagged."""
    return {
        f"{c}_iq_outlier": bounds_flag(number(c), lower, upper)
        for c, (lower, upper) in iqr_bounds(df, columns, max_values_in_task).items()
    }


def date_flags(
    df: DataFrame, columns: Sequence[str], max_values_in_task: int = MAX_VALUES_IN_TASK
) -> dict[str, Column]:
    """`{column}_date_outlier`: the same fences on points in time."""
    micros = df.select(*(as_micros(c).alias(c) for c in columns))
    return {
        f"{c}_date_outlier": bounds_flag(as_micros(c).cast("double"), lower, upper)
        for c, (lower, upper) in iqr_bounds(micros, columns, max_values_in_task).items()
    }
