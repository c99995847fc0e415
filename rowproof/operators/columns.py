"""Columns by name, and what counts as a missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows from which costly row expressions get a task of their own: parsing an address takes about 0.1 ms and more.
ROWS_IN_TASK = 10_000


def ref(name: str) -> Column:
    """The top-level column of this name, whatever signs the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN as null: missing, null and NaN are one thing."""
    return F.when(~F.isnan(ref(name)), ref(name)) if is_float(df, name) else ref(name)


def number(name: str) -> Column:
    """The column as double, NaN as null."""
    x = ref(name).cast("double")
    return F.when(~F.isnan(x), x)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every float column with NaN as null."""
    floats = [c for c in df.columns if is_float(df, c)]
    return df.withColumns({c: present(df, c) for c in floats}) if floats else df


def spread(df: DataFrame, rows_in_task: int = ROWS_IN_TASK) -> DataFrame:
    """The rows dealt to as many tasks as their count asks for, for work that costs far more time than bytes.

    A file of few bytes, or of one row group, is read by one task, whatever its rows cost. Rows that
    fit one task stay where they are, and so do the rows of a stream.
    """
    if df.isStreaming:
        return df
    tasks = 1 + df.count() // rows_in_task
    return df.repartition(tasks) if tasks > 1 else df
