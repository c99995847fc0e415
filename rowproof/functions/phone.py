"""Phone expressions for the North American numbering plan."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.functions.geo import country_format
from rowproof.functions.text import col, strip

# --- fixed values: phone text patterns --------------------------------------------------------
COUNTRY_PREFIX = r"\A\+?1?"
PHONE_PUNCTUATION = r"[ ()-]"
EXTENSION_TAIL = r"(?i)\s*[,;]?\s*(?:ext\.?|extension|x|#)\s*\d+\s*\z"
DIALABLE = r"\A[0-9 ()+./-]+\z"
NANP_NUMBER = r"\A1?[2-9]\d{2}[2-9]\d{6}\z"


def clean_phone_us(phone: Column | str, country: Column | str) -> Column:
    """US numbers lose a leading `+`, then a leading 1, then spaces, brackets and hyphens."""
    p = col(phone)
    bare = F.regexp_replace(F.regexp_replace(p, COUNTRY_PREFIX, ""), PHONE_PUNCTUATION, "")
    return F.when(col(country) == "US", strip(bare)).otherwise(p)


def format_phone(phone: Column | str, country: Column | str) -> Column:
    """`(aaa) bbb-cccc` from the first ten characters of a US number; null if it is shorter."""
    t = clean_phone_us(phone, country)
    us = F.when(
        F.length(t) >= 10,
        F.concat(
            F.lit("("), F.substring(t, 1, 3), F.lit(") "), F.substring(t, 4, 3),
            F.lit("-"), F.substring(t, 7, 4),
        ),
    )
    return F.when(col(country) == "US", us).otherwise(col(phone))


def extension(phone: Column | str, country: Column | str) -> Column:
    """`Ext <digits>` from what follows the tenth character of a US number, else null."""
    t = clean_phone_us(phone, country)
    digits = F.regexp_replace(F.substr(t, F.lit(11)), r"\D", "")
    return F.when((col(country) == "US") & (F.length(t) > 10), F.concat(F.lit("Ext "), digits))


def phone_is_valid(
    phone: Column | str, country: Column | str, area_codes: Collection[str] | None = None
) -> Column:
    """Number fits the plan, and its area code is assigned when `area_codes` is given."""
    number = F.regexp_replace(col(phone), EXTENSION_TAIL, "")
    digits = F.regexp_replace(number, r"\D", "")
    fits = number.rlike(DIALABLE) & digits.rlike(NANP_NUMBER)
    if area_codes is not None:
        fits = fits & F.substring(digits, -10, 3).isin(sorted(area_codes))
    return F.coalesce(col(country).isin("US", "CA") & fits, F.lit(False))


def phone_cleaning(
    phone: Column | str, country: Column | str, area_codes: Collection[str] | None = None
) -> Column:
    """Struct of `valid`, `formatted`, `ext`. Only US numbers are checked and rewritten."""
    p = col(phone)
    us = F.coalesce(country_format(country) == "US", F.lit(False))
    formatted = format_phone(p, F.lit("US"))
    foreign_prefix = F.replace(p, F.lit(" "), F.lit("")).rlike(r"\A\+(?!1)")
    valid = us & phone_is_valid(formatted, F.lit("US"), area_codes) & ~foreign_prefix
    valid = F.coalesce(valid, F.lit(False))
    return F.struct(
        valid.alias("valid"),
        F.when(us, F.coalesce(formatted, p)).otherwise(p).alias("formatted"),
        F.when(valid, extension(p, F.lit("US"))).alias("ext"),
    )
