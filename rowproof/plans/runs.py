"""Profile, fuzzy and load runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from rowproof.config import DatasetConfig, existing
from rowproof.operators.describe import describe, describe_columns
from rowproof.operators.frequency import frequency, frequency_text
from rowproof.operators.fuzzy import THRESHOLD, find_fuzzy_matches
from rowproof.operators.profile import profile_columns
from rowproof.operators.project import scrub_text_columns
from rowproof.sources.sinks import replace_table
from rowproof.sources.tables import (
    cast_columns,
    resolve_types,
    table_metadata,
    text_columns_of_types,
)


def profile_run(df: DataFrame, table: str) -> dict[str, DataFrame]:
    """Describe, frequency and column profile of a table."""
    return {
        "describe": describe(df),
        "describe_transposed": describe_columns(df, table),
        "frequency": frequency(df, table),
        "frequency_text": frequency_text(df),
        "profile": profile_columns(df),
    }


def fuzzy_run(
    df: DataFrame, config: DatasetConfig, threshold: int = THRESHOLD
) -> DataFrame | None:
    """Match lists of the columns configured for duplicates; nothing without a single key."""
    columns = existing(config.duplicates, df.columns)
    if not config.has_key or not columns:
        return None
    return find_fuzzy_matches(df, columns, config.table, threshold)


def cleansed(df: DataFrame, text_columns: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """Scrub the text columns and cast every column to its declared type, in one projection."""
    clean = scrub_text_columns(df, text_columns)
    return cast_columns(clean, resolve_types(types, clean.columns))


def load_with_metadata(
    df: DataFrame,
    metadata: DataFrame,
    source_table: str,
    target: str,
    schema: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> None:
    """Scrub a queried table by its database metadata and replace the target with it."""
    texts, types = table_metadata(metadata, source_table)
    replace_table(scrub_text_columns(df, texts), target, schema, types, jdbc)


def load_with_types(
    df: DataFrame,
    types: Mapping[str, str],
    target: str,
    schema: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> None:
    """Scrub a delimited export by its static type mapping and replace the target with it."""
    texts = text_columns_of_types(types)
    replace_table(scrub_text_columns(df, texts), target, schema, types, jdbc)
