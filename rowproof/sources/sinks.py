"""Writing tables and reports."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.functions.text import identifier_text
from rowproof.sources.tables import cast_columns, resolve_types

# --- fixed values: rows per database batch, report separators ---------------------------------
BATCH_ROWS = 5000
SUMMARY_SEPARATOR = ","
DETAIL_SEPARATOR = "|"


def table_name(table, schema=None) -> str:
    """Qualified name from plain texts or one-element lists."""
    parts = [schema, table] if schema is not None else [table]
    return ".".join(identifier_text(p) for p in parts)


def append_table(df: DataFrame, table, schema=None, jdbc: Mapping[str, str] | None = None) -> None:
    """Append to a catalog table, or to a database table in batches of 5000 rows."""
    name = table_name(table, schema)
    if jdbc is None:
        df.write.mode("append").saveAsTable(name)
    else:
        _jdbc(df, jdbc, name).mode("append").save()


def replace_table(
    df: DataFrame,
    table,
    schema=None,
    types: Mapping[str, str] | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> None:
    """Replace a table, with declared column types when they are given.

    A catalog table keeps declared lengths as VARCHAR(n); writing a longer text fails, and the old
    table then stays as it was.
    """
    name = table_name(table, schema)
    resolved = resolve_types(types, df.columns) if types is not None else {}
    typed = cast_columns(df, resolved)
    if jdbc is None and resolved:
        _create_typed(typed, name, resolved)
    elif jdbc is None:
        typed.write.mode("overwrite").saveAsTable(name)
    else:
        writer = _jdbc(typed, jdbc, name)
        if resolved:
            writer = writer.option("createTableColumnTypes", column_types(resolved))
        writer.mode("overwrite").save()


def truncate_table(
    spark: SparkSession, table, schema=None, jdbc: Mapping[str, str] | None = None
) -> None:
    """Remove all rows and keep the table."""
    name = table_name(table, schema)
    if jdbc is None:
        spark.sql(f"TRUNCATE TABLE {name}")
    else:
        empty = spark.read.format("jdbc").options(**jdbc).option("dbtable", name).load().limit(0)
        _jdbc(empty, jdbc, name).option("truncate", True).mode("overwrite").save()


def _create_typed(df: DataFrame, name: str, types: Mapping[str, T.DataType]) -> None:
    """Write under another name first, so that a failing write leaves the old table."""
    spark, fresh = df.sparkSession, f"{name}_{uuid4().hex}"
    spark.sql(f"CREATE TABLE {fresh} ({column_types(types)}) USING parquet")
    try:
        df.write.insertInto(fresh)
    except Exception:
        spark.sql(f"DROP TABLE {fresh}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def column_types(types: Mapping[str, T.DataType]) -> str:
    """Column list for the database, e.g. "`name` VARCHAR(256), `id` BIGINT"."""
    return ", ".join(f"`{name}` {kind.simpleString().upper()}" for name, kind in types.items())


def write_report(df: DataFrame, path: str, sep: str = SUMMARY_SEPARATOR) -> None:
    """Delimited report with a header in directory `path`; lists are joined with commas."""
    lists = {
        f.name: F.array_join(F.col(f.name).cast("array<string>"), ",")
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    flat = df.withColumns(lists) if lists else df
    (
        flat.write.mode("overwrite")
        .option("sep", sep)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _jdbc(df: DataFrame, jdbc: Mapping[str, str], name: str):
    return (
        df.write.format("jdbc")
        .options(**jdbc)
        .option("dbtable", name)
        .option("batchsize", BATCH_ROWS)
    )
