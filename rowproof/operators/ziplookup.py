"""Joins with the caller's ZIP reference table `(zip, place, state, ...)`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.functions.postal import zip5
from rowproof.functions.text import col


def zip_records(zip_ref: DataFrame) -> DataFrame:
    """One record per ZIP of a reference `(zip, place, state, ...)`."""
    return (
        zip_ref.where(F.col("zip").isNotNull())
        .groupBy(F.col("zip").alias("__zip"))
        .agg(F.min(F.struct(*zip_ref.columns)).alias("__record"))
        .select("__record.*")
    )


def with_zip_lookup(
    df: DataFrame, postal: Column | str, zip_ref: DataFrame, out: str = "zip_hit"
) -> DataFrame:
    """Add struct `out`: the reference record of the postal code's first five characters, or null.

    One join serves every ZIP function. The reference is reduced to one record per ZIP, so the
    join never multiplies rows. There is no broadcast hint: Catalyst and AQE broadcast the
    reference when its size is under the session's threshold and shuffle it otherwise. A reference
    that comes from a file or is staged has a known size; `validate` stages it.
    """
    key = f"__{out}_key"
    records = (
        zip_ref.where(F.col("zip").isNotNull())
        .select(F.col("zip").alias(f"{key}_ref"), F.struct(*zip_ref.columns).alias(out))
        .groupBy(f"{key}_ref")
        .agg(F.min(out).alias(out))
    )
    return (
        df.withColumn(key, zip5(postal))
        .join(records, F.col(key) == F.col(f"{key}_ref"), "left")
        .drop(key, f"{key}_ref")
    )


def us_zip_code(hit: Column | str) -> Column:
    return col(hit).isNotNull()


def us_state_by_zip(hit: Column | str) -> Column:
    return col(hit).getField("state")


def us_city_by_zip(hit: Column | str) -> Column:
    return col(hit).getField("place")


def zip_lookup(df: DataFrame, place: str, state: str, zip_ref: DataFrame) -> DataFrame:
    """Add `zips`: the sorted ZIP codes of each row's place and state, empty when there are none.

    The list is built on the reference side, where a place owns at most the ZIP codes of one
    town; the rows themselves are never grouped.
    """
    lists = zip_ref.groupBy(
        F.col("place").alias("__place"), F.col("state").alias("__state")
    ).agg(F.array_sort(F.collect_set("zip")).alias("zips"))
    joined = df.join(
        lists, (F.col(place) == F.col("__place")) & (F.col(state) == F.col("__state")), "left"
    ).drop("__place", "__state")
    return joined.withColumn("zips", F.coalesce("zips", F.array().cast("array<string>")))
