"""Frequency relations: value counts per column, kept to the most frequent values.

Counting moves keys, not values. A value of up to `KEY_LENGTH` characters is its own key; a longer one is
known by so many characters of its beginning and a 256-bit digest. So what is shuffled, counted and ranked does
not grow with the length of the texts. Only the long values that are kept are read again, by their keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.functions.text import identifier_text
from rowproof.operators.columns import present
from rowproof.operators.project import text_columns

# --- fixed value: values kept per column in a frequency report --------------------------------
TOP_VALUES = 50
# Characters up to which a value is its own key.
KEY_LENGTH = 64
# Slots that tell which long values are looked up; their list has a fixed size at most.
SLOTS = 1 << 16


def key_of(text: Column) -> Column:
    """The text, or its beginning and digest: equal for equal texts only, keys in the order of the beginnings."""
    digest = F.sha2(text.cast("binary"), 256)
    return F.when(F.char_length(text) > KEY_LENGTH, F.concat(F.left(text, F.lit(KEY_LENGTH)), digest)).otherwise(text)


def _is_long(key: Column) -> Column:
    return F.char_length(key) > KEY_LENGTH


def _slot(key: Column) -> Column:
    """One of `SLOTS` numbers."""
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def _long_rows(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """`table_column` and the value as text, a row per row and column."""
    texts = df.select(*(present(df, c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)))
    names = F.create_map(*(F.lit(x) for i, c in enumerate(columns) for x in (f"c{i}", c)))
    long = texts.unpivot([], texts.columns, "table_column", value)
    return long.withColumn("table_column", names[F.col("table_column")])


def key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`table_column, key, value_counts` for all columns in one shuffle, nulls included.

    Counting starts before the shuffle, so a value that fills a third of the table reaches its
    reducer as one partial count per task.
    """
    rows = _long_rows(df, columns, "value").select("table_column", key_of(F.col("value")).alias("key"))
    return rows.groupBy("table_column", "key").agg(F.count(F.lit(1)).alias("value_counts"))


def with_values(counts: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`table_values` for the `key` of each row: the key itself, or the long value, which is looked up in `df`."""
    texts = [c for c in dict.fromkeys(columns) if isinstance(df.schema[c].dataType, (T.StringType, T.VarcharType, T.CharType))]
    if not texts:
        return counts.withColumnRenamed("key", "table_values")
    wanted = counts.where(_is_long(F.col("key"))).agg(F.collect_set(_slot(F.col("key")))).scalar()
    long = _long_rows(df, texts, "value").where(_is_long(F.col("value"))).select(
        F.col("table_column").alias("__of"), key_of(F.col("value")).alias("__key"), "value"
    )
    # Texts of other keys stay where they are read, but for the few that fall into a wanted slot.
    found = long.where(F.array_contains(wanted, _slot(F.col("__key")))).groupBy("__of", "__key").agg(F.min("value").alias("__value"))
    same = (F.col("table_column") == F.col("__of")) & F.col("key").eqNullSafe(F.col("__key"))
    return counts.join(found, same, "left").withColumn("table_values", F.coalesce("__value", "key")).drop("__of", "__key", "__value", "key")


def most_frequent(counts: DataFrame, df: DataFrame, columns: Sequence[str], keep: int | None = TOP_VALUES) -> DataFrame:
    """Top values per column of `key_counts`, all of them if `keep` is None; ties go to the smaller value, null last.

    Filtering the rank directly lets Spark drop all but `keep` rows per column in every task
    before the shuffle, so a column of unique values does not land in one task. Long values that begin
    alike tie until they are looked up, and are ranked again then.
    """
    by_key = Window.partitionBy("table_column").orderBy(F.desc("value_counts"), F.asc_nulls_last(F.left("key", F.lit(KEY_LENGTH))))
    ranked = Window.partitionBy("table_column").orderBy(F.desc("value_counts"), F.asc_nulls_last("table_values"))
    if keep is not None:
        counts = counts.withColumn("__first", F.rank().over(by_key)).where(F.col("__first") <= keep).drop("__first")
    rows = with_values(counts, df, columns).withColumn("__rank", F.row_number().over(ranked))
    # Few rows are left: as a difference, the bound makes no second limit before the sort.
    return rows if keep is None else rows.where(F.lit(keep) - F.col("__rank") >= 0)


def _with_total(df: DataFrame, columns: Sequence[str], keep: int | None) -> DataFrame:
    """The most frequent values with the rows of their column; both come from one count."""
    counts = key_counts(df, columns)
    totals = counts.groupBy(F.col("table_column").alias("__column")).agg(
        F.sum("value_counts").alias("__rows")
    )
    top = most_frequent(counts, df, columns, keep)
    return top.join(totals, F.col("table_column") == F.col("__column"))


def frequency(
    df: DataFrame, table: str, columns: Sequence[str] | None = None, keep: int | None = TOP_VALUES
) -> DataFrame:
    """Frequency relation with shares between 0 and 1; all string columns by default."""
    names = text_columns(df) if columns is None else list(dict.fromkeys(columns))
    top = _with_total(df, names, keep)
    return top.select(
        "table_values",
        "value_counts",
        (F.col("value_counts") / F.col("__rows")).alias("value_percent"),
        "table_column",
        F.lit(identifier_text(table)).alias("table_name"),
    )


def frequency_text(
    df: DataFrame, columns: Sequence[str] | None = None, keep: int | None = TOP_VALUES
) -> DataFrame:
    """Rows of the printed report: lower-case column name, rank, value, count and `12.34%`."""
    names = text_columns(df) if columns is None else list(dict.fromkeys(columns))
    top = _with_total(df, names, keep)
    hundredths = F.rint(F.col("value_counts") / F.col("__rows") * 100 * 100)
    return top.select(
        F.lower("table_column").alias("column_name"),
        F.col("__rank").alias("rank"),
        F.col("table_values").alias("categories"),
        F.col("value_counts").alias("counts"),
        F.concat((hundredths / 100).cast("string"), F.lit("%")).alias("percent"),
    )
