"""Column statistics, one row per column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.operators.columns import number, ref
from rowproof.operators.quantiles import MAX_VALUES_IN_TASK, quantile_values

# --- fixed values: fence widths ---------------------------------------------------------------
IQR_FENCE = 1.5
STD_FENCE = 3.0


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def date_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _one_row_per_column(
    df: DataFrame, columns: Sequence[str], build: Callable[[str], dict[str, Column]]
) -> DataFrame:
    """One aggregation over all columns, turned into one row per column."""
    structs = [
        F.struct(F.lit(c).alias("column_name"), *(v.alias(k) for k, v in build(c).items())).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    return df.agg(*structs).select(F.inline(F.array(*(F.col(f"s{i}") for i in range(len(columns))))))


def _mean_fields(x: Column) -> dict[str, Column]:
    mean, std = F.avg(x), F.stddev_samp(x)
    return {
        "mean": mean,
        "std": std,
        "upper": mean + std * STD_FENCE,
        "lower": mean - std * STD_FENCE,
    }


def _quartile_fields(q1: Column, q3: Column) -> dict[str, Column]:
    iqr = q3 - q1
    return {
        "first_quartile": q1,
        "third_quartile": q3,
        "interquartile_range": iqr,
        "iq_upper": q3 + iqr * IQR_FENCE,
        "iq_lower": q1 - iqr * IQR_FENCE,
    }


def numeric_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    """Mean, median, deviation, variance, quartiles and both pairs of outlier limits."""
    names = numeric_columns(df) if columns is None else list(columns)
    quantiles = quantile_values(df, names, [0.25, 0.5, 0.75], max_values_in_task)

    def build(c: str) -> dict[str, Column]:
        x, q = number(c), quantiles[c]
        spread = _mean_fields(x)
        return {
            "mean": spread["mean"],
            "median": q[1],
            "std": spread["std"],
            "variance": F.var_samp(x),
            **_quartile_fields(q[0], q[2]),
            "upper": spread["upper"],
            "lower": spread["lower"],
        }

    return _one_row_per_column(df, names, build)


def mean_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = numeric_columns(df) if columns is None else list(columns)
    return _one_row_per_column(df, names, lambda c: _mean_fields(number(c)))


def quartile_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    names = numeric_columns(df) if columns is None else list(columns)
    quantiles = quantile_values(df, names, [0.25, 0.75], max_values_in_task)
    return _one_row_per_column(
        df, names, lambda c: _quartile_fields(quantiles[c][0], quantiles[c][1])
    )


def as_micros(c: str) -> Column:
    return F.unix_micros(ref(c).cast("timestamp"))


def date_quartile_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    """Quartiles and fences of date columns as timestamps; the range is given in seconds."""
    names = date_columns(df) if columns is None else list(columns)
    micros = df.select(*(as_micros(c).alias(c) for c in names))
    stats = quartile_stats(micros, names, max_values_in_task)

    kinds = {df.schema[c].dataType.simpleString() for c in names}
    kind = "timestamp_ntz" if kinds == {"timestamp_ntz"} else "timestamp"

    def moment(c: str) -> Column:
        return F.timestamp_micros(F.floor(F.col(c))).cast(kind).alias(c)

    return stats.select(
        "column_name",
        moment("first_quartile"),
        moment("third_quartile"),
        (F.col("interquartile_range") / 1_000_000).alias("interquartile_range"),
        moment("iq_upper"),
        moment("iq_lower"),
    )
