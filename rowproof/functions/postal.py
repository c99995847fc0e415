"""Postal-code expressions. Checks against the ZIP reference are joins: `operators.ziplookup`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.functions.text import col

# --- fixed values: postal-code pattern by country; AU, BR and DE only need a matching start ---
POSTAL_PATTERNS = {
    "US": r"\A\d{5}(-\d{4})?\z",
    "AU": r"\A\d{4}",
    "BR": r"\A\d{5}-?\d{3}",
    "DE": r"\A\d{5}",
    "CA": r"\A[A-Z]\d[A-Z] \d[A-Z]\d\z",
    "FR": r"\A\d{5}\z",
    "JP": r"\A\d{3}-\d{4}\z",
    "GB": r"\A[A-Z]{1,2}\d[A-Z\d]? \d[A-Z]{2}\z",
    "IN": r"\A[1-9]\d{2}\s?\d{3}\z",
}


def zip5(postal: Column | str) -> Column:
    return F.substring(col(postal), 1, 5)


def zip_code_regex(postal: Column | str, country: Column | str) -> Column:
    """Postal code fits the country's pattern; unknown country or null is false."""
    p, c = col(postal), col(country)
    rule = F.lit(False)
    for code, pattern in POSTAL_PATTERNS.items():
        rule = F.when(c == code, p.rlike(pattern)).otherwise(rule)
    return F.coalesce(rule, F.lit(False))


def zip_code_check(postal: Column | str, country: Column | str, known: Column) -> Column:
    """US codes must be `known` in the reference, other codes must fit their pattern."""
    return F.when(col(country) == "US", F.coalesce(known, F.lit(False))).otherwise(
        zip_code_regex(postal, country)
    )


def zip_format(postal: Column | str, country: Column | str, known: Column) -> Column:
    """Five digits for a valid US code, other valid codes as they are, else null."""
    return F.when(
        zip_code_check(postal, country, known),
        F.when(col(country) == "US", zip5(postal)).otherwise(col(postal)),
    )
