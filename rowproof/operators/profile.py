"""Column profile and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.operators.columns import ref
from rowproof.operators.describe import measured
from rowproof.operators.frequency import key_counts
from rowproof.operators.project import text_columns
from rowproof.operators.quantiles import MAX_VALUES_IN_TASK, quantile_values

# --- fixed values: quantiles of the profile ---------------------------------------------------
PROFILE_QUANTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def profile_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    """One row per column: completeness, uniqueness, spread of numbers, length of texts."""
    df = df.select(*map(ref, columns)) if columns is not None else df
    numbers, texts = measured(df), set(text_columns(df))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    values = df.select(*(numbers.get(c, ref(c)).alias(c) for c in df.columns))
    quantiles = quantile_values(
        values, list(numbers), list(PROFILE_QUANTILES.values()), max_values_in_task
    )
    no_double, no_long = F.lit(None).cast("double"), F.lit(None).cast("bigint")

    def facts(c: str) -> Column:
        x = ref(c)
        num, txt = c in numbers, c in texts
        size = F.length(x).cast("bigint") if txt else None
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.count(F.lit(1)).alias("n"),
            F.count(x).alias("n_present"),
            (F.count_if(x == 0) if num else no_long).alias("n_zeros"),
            (F.count_if(x < 0) if num else no_long).alias("n_negative"),
            (F.min(x) if num else no_double).alias("min"),
            (F.avg(x) if num else no_double).alias("mean"),
            (F.max(x) if num else no_double).alias("max"),
            (F.stddev_samp(x) if num else no_double).alias("std"),
            *(
                (quantiles[c][i] if num else no_double).alias(name)
                for i, name in enumerate(PROFILE_QUANTILES)
            ),
            (F.min(size) if txt else no_long).alias("min_length"),
            (F.avg(size) if txt else no_double).alias("mean_length"),
            (F.max(size) if txt else no_long).alias("max_length"),
        )

    rows = values.agg(*(facts(c).alias(f"s{i}") for i, c in enumerate(values.columns))).select(
        F.inline(F.array(*(F.col(f"s{i}") for i in range(len(values.columns)))))
    )
    distinct = (
        key_counts(df, df.columns)
        .groupBy(F.col("table_column").alias("column_name"))
        .agg(F.count("key").alias("n_distinct"))
    )
    missing = F.col("n") - F.col("n_present")
    return rows.join(distinct, "column_name", "left").select(
        "column_name",
        "data_type",
        "n",
        missing.alias("n_missing"),
        F.try_divide(missing, F.col("n")).alias("p_missing"),
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        F.try_divide(F.coalesce("n_distinct", F.lit(0)), F.col("n_present")).alias("p_distinct"),
        ((F.col("n_distinct") == F.col("n_present")) & (F.col("n_present") > 0)).alias("is_unique"),
        "n_zeros",
        "n_negative",
        "min",
        "mean",
        "max",
        "std",
        *PROFILE_QUANTILES,
        "min_length",
        "mean_length",
        "max_length",
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Counts in equal-width bins per column: `column_name, bin, lower, upper, n`; empty bins left out.

    The range comes from a one-row aggregate used as a scalar subquery; counting starts before
    the shuffle, which carries at most `bins` rows per column and task.
    """
    numbers = measured(df)
    values = df.select(*(numbers[c].alias(c) for c in columns))
    ranges = values.agg(
        F.struct(
            *(F.struct(F.min(ref(c)).alias("lo"), F.max(ref(c)).alias("hi")).alias(f"r{i}") for i, c in enumerate(columns))
        ).alias("r")
    ).scalar()

    def bin_of(i: int, c: str) -> Column:
        lo, hi = ranges[f"r{i}"]["lo"], ranges[f"r{i}"]["hi"]
        share = F.try_divide(ref(c) - lo, hi - lo)
        index = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1).cast("bigint"))
        return F.struct(
            F.lit(c).alias("column_name"),
            F.when(ref(c).isNotNull(), index.cast("int")).alias("bin"),
            lo.alias("lo"),
            hi.alias("hi"),
        )

    cells = values.select(F.inline(F.array(*(bin_of(i, c) for i, c in enumerate(columns)))))
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        cells.where(F.col("bin").isNotNull())
        .groupBy("column_name", "bin", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "column_name",
            "bin",
            (F.col("lo") + width * F.col("bin")).alias("lower"),
            (F.col("lo") + width * (F.col("bin") + 1)).alias("upper"),
            "n",
        )
    )
