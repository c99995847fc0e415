"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def staging_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rowproof-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write the table once and read it back, so that later steps do not compute it again.

    Unlike cached blocks the files outlive a lost executor, and reading them prunes columns.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/staged-{uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[None]:
    """Remove, when the block ends, the tables that were staged inside it.

    What reads them must be written or fetched before; only folders that `staged` made are removed.
    """
    paths: list[str] = []
    token = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
