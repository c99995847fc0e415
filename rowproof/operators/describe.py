"""Describe relations: one row per column, and the transposed report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.functions.text import identifier_text
from rowproof.operators.columns import number, ref
from rowproof.operators.frequency import key_counts, most_frequent
from rowproof.operators.quantiles import MAX_VALUES_IN_TASK, quantile_values
from rowproof.operators.statistics import date_columns, numeric_columns

# --- fixed values: columns of the relation, and rows of the report with their source ----------
DESCRIBE_COLUMNS = (
    "table_name", "column_name", "data_types", "counts", "unique_values", "top_values", "freq",
    "mean", "min_value", "first_iq", "middle_iq", "third_iq", "max_value", "std", "nulls",
    "total_rows",
)
REPORT_ROWS = {
    "count": "counts", "unique": "unique_values", "top": "top_values", "freq": "freq",
    "mean": "mean", "std": "std", "min": "min_value", "25%": "first_iq", "50%": "middle_iq",
    "75%": "third_iq", "max": "max_value", "data_types": "data_types", "null_counts": "nulls",
    "total_rows": "total_rows",
}


def measured(df: DataFrame) -> dict[str, Column]:
    """Numeric and date columns as doubles; dates are measured in seconds since 1970."""
    numbers = {c: number(c) for c in numeric_columns(df)}
    seconds = {
        c: F.unix_micros(ref(c).cast("timestamp")) / F.lit(1e6) for c in date_columns(df)
    }
    return numbers | seconds


def describe_columns(
    df: DataFrame,
    table: str,
    columns: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    """Count, nulls and rows for all columns; spread for numbers and dates; top value for others."""
    df = df.select(*map(ref, columns)) if columns is not None else df
    numbers = measured(df)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    values = df.select(*(numbers.get(c, ref(c)).alias(c) for c in df.columns))
    quantiles = quantile_values(values, list(numbers), [0.25, 0.5, 0.75], max_values_in_task)
    nothing = F.lit(None).cast("double")

    def summary(c: str) -> Column:
        x = ref(c)
        is_number = c in numbers
        q = quantiles[c] if is_number else F.array(*[nothing] * 3)
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_types"),
            F.count(x).alias("counts"),
            (F.avg(x) if is_number else nothing).alias("mean"),
            (F.min(x) if is_number else nothing).alias("min_value"),
            q[0].alias("first_iq"),
            q[1].alias("middle_iq"),
            q[2].alias("third_iq"),
            (F.max(x) if is_number else nothing).alias("max_value"),
            (F.stddev_samp(x) if is_number else nothing).alias("std"),
            F.count_if(x.isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("total_rows"),
        )

    rows = values.agg(*(summary(c).alias(f"s{i}") for i, c in enumerate(values.columns))).select(
        F.inline(F.array(*(F.col(f"s{i}") for i in range(len(values.columns)))))
    )
    labels = [c for c in df.columns if c not in numbers]
    if labels:
        rows = rows.join(_label_summary(df, labels), "column_name", "left")
    else:
        rows = rows.withColumns(
            {
                "unique_values": F.lit(None).cast("bigint"),
                "top_values": F.lit(None).cast("string"),
                "freq": F.lit(None).cast("bigint"),
            }
        )
    return rows.withColumn("table_name", F.lit(identifier_text(table))).select(*DESCRIBE_COLUMNS)


def _label_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value and its count: one row per column."""
    counts = key_counts(df, columns).where(F.col("key").isNotNull())
    sizes = counts.groupBy(F.col("table_column").alias("column_name")).agg(
        F.count(F.lit(1)).alias("unique_values"), F.max("value_counts").alias("freq")
    )
    top = most_frequent(counts, df, columns, 1).select(F.col("table_column").alias("column_name"), F.col("table_values").alias("top_values"))
    return (
        sizes.join(top, "column_name")
        .select("column_name", "unique_values", "top_values", "freq")
    )


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_values_in_task: int = MAX_VALUES_IN_TASK,
) -> DataFrame:
    """The report form: one row per statistic, one text column per table column."""
    names = list(columns) if columns is not None else df.columns
    per_column = describe_columns(df, "", names, max_values_in_task)
    stats = per_column.select(
        "column_name",
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(label).alias("categories"),
                        F.col(source).cast("string").alias("value"),
                    )
                    for i, (label, source) in enumerate(REPORT_ROWS.items())
                )
            )
        ),
    )
    wide = stats.groupBy("position", "categories").pivot("column_name", names).agg(F.first("value"))
    return wide.orderBy("position").drop("position")
