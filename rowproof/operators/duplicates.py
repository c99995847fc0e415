"""Exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.functions.text import identifier_text
from rowproof.operators.columns import present, ref


def exact_duplicates(
    df: DataFrame, columns: Sequence[str], primary_key: str, table: str
) -> DataFrame:
    """Every row whose value occurs more than once in its column, for all columns at once.

    Repeated values come from a count that starts before the shuffle, and rows are kept by a
    semi-join. Both use a 256-bit digest and the length, so a long text moves once, with its row. No
    group of copies is gathered anywhere: AQE splits the join partition of a value
    that fills a large part of the table.
    """
    long = _long_values(df, list(dict.fromkeys(columns)), primary_key).withColumns(
        {"__digest": F.sha2(F.col("field_value").cast("binary"), 256), "__size": F.char_length("field_value")}
    )
    keys = ["table_column", "__digest", "__size"]
    repeated = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return long.join(repeated, keys, "left_semi").select(
        "table_primary_key",
        "field_value",
        "table_column",
        F.lit(identifier_text(table)).alias("table_name"),
    )


def _long_values(df: DataFrame, columns: Sequence[str], primary_key: str) -> DataFrame:
    """One row per key, column and value that is not null."""
    key = ref(primary_key).cast("string").alias("table_primary_key")
    if len(columns) == 1:
        # Without unpivoting the null filter reaches the scan.
        filled = df.where(present(df, columns[0]).isNotNull())
        value = ref(columns[0]).cast("string").alias("field_value")
        return filled.select(key, F.lit(columns[0]).alias("table_column"), value)
    texts = (present(df, c).cast("string") for c in columns)
    pieces = F.stack(
        F.lit(len(columns)), *(x for c, text in zip(columns, texts) for x in (F.lit(c), text))
    ).alias("table_column", "field_value")
    return df.select(key, pieces).where(F.col("field_value").isNotNull())


def duplicates_by_column(df: DataFrame, column: str, primary_key: str) -> DataFrame:
    """Key and value of the rows that share their value, sorted by value.

    Values are counted and rows are found by a 256-bit digest, so a value moves only with the rows that are
    reported, to the range of the sorted report that it belongs to.
    """
    values = df.select(ref(primary_key), ref(column)).where(present(df, column).isNotNull())
    keyed = values.withColumn("__digest", F.sha2(present(df, column).cast("string").cast("binary"), 256))
    repeated = keyed.groupBy("__digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__digest")
    return keyed.join(repeated, "__digest", "left_semi").drop("__digest").orderBy(ref(column), ref(primary_key))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(ref(column)).where(present(df, column).isNotNull()).distinct()
