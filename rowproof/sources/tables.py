"""Reading tables: delimited files, queries, and column metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.config import DatasetConfig, resolve_config
from rowproof.operators.project import text_columns

# --- fixed values: texts that mean "missing" in a delimited file ------------------------------
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Files of a batch that are worked on at a time.
FILES_AT_ONCE = 4

# --- fixed values: SQL text types in a metadata table -----------------------------------------
SQL_TEXT_TYPES = ("nvarchar", "varchar", "nchar", "char")

# --- fixed values: declared type names --------------------------------------------------------
DECLARED_TYPES = {
    "Boolean": T.BooleanType(),
    "BigInteger": T.LongType(),
    "Integer": T.IntegerType(),
    "Float": T.DoubleType(),
    "Date": T.DateType(),
    "DateTime": T.TimestampType(),
    "String": T.StringType(),
    "Text": T.StringType(),
}


def null_tokens(c: Column, keep: Iterable[str] = ()) -> Column:
    tokens = [t for t in NULL_TOKENS if t not in set(keep)]
    return F.when(~c.isin(tokens), c)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    sep: str = ",",
    numeric: Iterable[str] = (),
    dates: Iterable[str] = (),
    country_columns: Iterable[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Delimited file with a header, as text; only the named columns are cast, failures to null.

    Quoted line breaks need `multi_line`, and then one file is one task: large files that hold
    none should be read with `multi_line=False`, which lets Spark split them. In country columns
    `NA` is Namibia.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("inferSchema", False)
        .csv(path)
    )
    numeric, dates, kept = set(numeric), set(dates), set(country_columns)

    def typed(name: str) -> Column:
        value = null_tokens(F.col(f"`{name}`"), keep=("NA",) if name in kept else ())
        if name in numeric:
            number = value.try_cast("double")
            value = F.when(~F.isnan(number), number)
        elif name in dates:
            value = value.try_cast("timestamp")
        return value.alias(name)

    return raw.select(*(typed(c) for c in raw.columns))


def read_dataset(
    spark: SparkSession, path: str, config: DatasetConfig, multi_line: bool = True
) -> DataFrame:
    """`read_csv` with the casts and country columns that the configuration names."""
    return read_csv(
        spark,
        path,
        numeric=config.numeric_columns,
        dates=config.date_outliers,
        country_columns=config.country_columns,
        multi_line=multi_line,
    )


def run_files(
    spark: SparkSession,
    paths: Sequence[str],
    registry: Mapping[str, DatasetConfig],
    job: Callable[[DataFrame, DatasetConfig, str], object],
    multi_line: bool = True,
    at_once: int = FILES_AT_ONCE,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run `job(table, config, name)` for every usable file; return one status row per file.

    Files that do not end in `.csv`, cannot be read, have no configuration or no single key are
    skipped and do not stop the others. `names` says which dataset a file belongs to where that is
    not its own name.

    `at_once` files are worked on at a time, each in a scheduler pool of its own: with
    `spark.scheduler.mode` FAIR a large file shares the cluster with the others, and with any mode a file
    that leaves cores idle does not hold up the rest.
    """

    def one(path: str) -> tuple[str, str, str, str]:
        name = path.rsplit("/", 1)[-1].removesuffix(".csv")
        config = resolve_config(name, registry, names)
        if not path.lower().endswith(".csv"):
            status, detail = "skipped", "not a .csv file"
        elif config is None:
            status, detail = "skipped", "no configuration"
        elif not config.has_key:
            status, detail = "skipped", "no single primary key"
        else:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            try:
                job(read_dataset(spark, path, config, multi_line), config, name)
                status, detail = "done", ""
            except Exception as error:  # noqa: BLE001 - recorded; the other files go on
                status, detail = "failed", (str(error).splitlines() or [type(error).__name__])[0]
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return path, name, status, detail

    with ThreadPoolExecutor(max(1, at_once)) as workers:
        # Each file runs in a copy of the caller's context, so tables it stages belong to the caller's run.
        statuses = [f.result() for f in [workers.submit(copy_context().run, one, path) for path in paths]]
    return spark.createDataFrame(
        statuses, "path string, dataset string, status string, detail string"
    )


@dataclass(frozen=True)
class Split:
    """How a database read is divided: a numeric or date column, its bounds, and the number of parts.

    Rows outside the bounds are read too; bounds only place the cuts.
    """

    column: str
    lower: str
    upper: str
    parts: int
    fetch_rows: int = 10_000


def jdbc_read_options(query: str, jdbc: Mapping[str, str], split: Split | None = None) -> dict[str, str]:
    """Options of a database read; without a split it is one task."""
    if split is None:
        return {**jdbc, "query": query}
    return {
        **jdbc,
        "dbtable": f"({query}) AS rows_to_read",
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.parts),
        "fetchsize": str(split.fetch_rows),
    }


def read_query(
    spark: SparkSession, query: str, jdbc: Mapping[str, str] | None = None, split: Split | None = None
) -> DataFrame:
    """Result of a query over registered tables, or over a database given its JDBC options."""
    if jdbc is None:
        return spark.sql(query)
    return spark.read.format("jdbc").options(**jdbc_read_options(query, jdbc, split)).load()


def read_query_file(
    spark: SparkSession, path: str, jdbc: Mapping[str, str] | None = None, split: Split | None = None
) -> DataFrame:
    """`read_query` for the text of a `.sql` file on any file system Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return read_query(spark, text.strip().rstrip(";"), jdbc, split)


def text_column_metadata(metadata: DataFrame, table: str) -> DataFrame:
    """`COLUMN_NAME` of the table's text columns, from a metadata table."""
    wanted = (F.col("TABLE_NAME") == table) & F.col("DATA_TYPE").isin(*SQL_TEXT_TYPES)
    return metadata.where(wanted).select("COLUMN_NAME")


def declared_type_metadata(metadata: DataFrame, table: str) -> DataFrame:
    """`COLUMN_NAME` and declared type text of all the table's columns."""
    return metadata.where(F.col("TABLE_NAME") == table).select("COLUMN_NAME", "SA_COLUMN_FORMAT1")


def table_metadata(metadata: DataFrame, table: str) -> tuple[list[str], dict[str, str]]:
    """Text columns and declared types of one table; a table has few columns, so they are collected."""
    texts = [row.COLUMN_NAME for row in text_column_metadata(metadata, table).collect()]
    types = {r.COLUMN_NAME: r.SA_COLUMN_FORMAT1
             for r in declared_type_metadata(metadata, table).collect()}
    return texts, types


def text_columns_of_types(types: Mapping[str, str]) -> list[str]:
    """Text columns of a static `{column: type name}` mapping."""
    return [name for name, declared in types.items() if "String" in declared]


def schema_text_columns(df: DataFrame) -> list[str]:
    """Text columns by the table's own schema, when there is no metadata."""
    return text_columns(df)


def resolve_types(types: Mapping[str, str], columns: Sequence[str]) -> dict[str, T.DataType]:
    """Spark type of each column by its declared name, e.g. `sa.String(256)`; unknown ones raise."""
    resolved = {}
    for name in columns:
        if name not in types:
            raise KeyError(f"no declared type for column {name!r}")
        base, _, size = types[name].strip().removeprefix("sa.").rstrip("()").partition("(")
        if base not in DECLARED_TYPES:
            raise ValueError(f"unknown declared type {types[name]!r} for column {name!r}")
        resolved[name] = T.VarcharType(int(size)) if base == "String" and size else DECLARED_TYPES[base]
    return resolved


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast to the declared types; values that do not fit become null. Texts keep their length."""

    def cast(name: str) -> Column:
        declared = types.get(name)
        if declared is None:
            return F.col(name)
        plain = T.StringType() if isinstance(declared, T.VarcharType) else declared
        return F.col(name).try_cast(plain).alias(name)

    return df.select(*(cast(c) for c in df.columns))
