"""Report projections, null rows and whole-table scrubbing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.config import existing
from rowproof.operators.columns import present, ref
from rowproof.functions.text import scrub, strip


def report_columns(df: DataFrame, *wanted: Iterable[str]) -> DataFrame:
    """Wanted columns that exist, in order, each once."""
    return df.select(*map(ref, existing([c for group in wanted for c in group], df.columns)))


def default_country(df: DataFrame, column: str | None, code: str = "US") -> Column:
    """The configured country column when the table has it, else the constant code."""
    return ref(column) if column in df.columns else F.lit(code)


def null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a null or NaN in any of the columns (all by default), cut to those columns."""
    names = list(dict.fromkeys(columns)) if columns is not None else df.columns
    missing = reduce(lambda a, b: a | b, [present(df, c).isNull() for c in names])
    return df.where(missing).select(*map(ref, names))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def scrub_table(df: DataFrame) -> DataFrame:
    """Scrub every string column."""
    return df.withColumns({c: scrub(ref(c)) for c in text_columns(df)})


def scrub_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scrub every string column; in the listed ones empty becomes null, then blanks are trimmed.

    The null test comes before trimming, so a blank text becomes empty and not null.
    """
    listed = set(columns)

    def cleaned(name: str) -> Column:
        value = scrub(ref(name))
        return strip(F.when(value != "", value)) if name in listed else value

    return df.withColumns({c: cleaned(c) for c in text_columns(df)})


def scrub_legacy(df: DataFrame) -> DataFrame:
    """Trim strings; blank strings, NaN and positive infinity to null; then scrub."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    texts = {c: scrub(F.when(strip(ref(c)) != "", strip(ref(c)))) for c in text_columns(df)}
    numbers = {c: F.when((ref(c) != float("inf")) & ~F.isnan(ref(c)), ref(c)) for c in floats}
    return df.withColumns({**texts, **numbers}) if texts or numbers else df
