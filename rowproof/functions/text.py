"""Text expressions used by several rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's `str.strip` removes; \p{Z} holds the Unicode separators.
BLANKS = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
CONTROL = r"[\r\n\t\f]"
NOT_PRINTABLE_ASCII = r"[^\x20-\x7E]+"
ASCII_WORD = r"([A-Za-z]+(?:'[A-Za-z]+)?)"
ASCII_STRETCH = r"[\x02-\x7F]+|[^\x02-\x7F]+"
MARKED_BLANK = "\x01 "


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"\A{BLANKS}|{BLANKS}\z", "")


def scrub(c: Column | str) -> Column:
    """Line breaks and tabs become a space; other control and all non-ASCII characters go."""
    return F.regexp_replace(F.regexp_replace(col(c), CONTROL, " "), NOT_PRINTABLE_ASCII, "")


def identifier(c: Column | str) -> Column:
    """Text of a one-element list: trimmed, without quotes and brackets."""
    return F.translate(strip(c), "'[]", "")


def identifier_text(value) -> str:
    """`identifier` for a value known on the driver, such as a configured table name."""
    return str(value).strip().translate(str.maketrans("", "", "'[]"))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every ASCII word and lower-case the rest of it.

    Every word of an ASCII stretch gets a marked blank in front, so that `initcap` sees it as a
    word of its own; other characters are kept as they are.
    """

    def titled(stretch: Column) -> Column:
        apart = F.regexp_replace(stretch, ASCII_WORD, MARKED_BLANK + "$1")
        return F.replace(F.initcap(apart), F.lit(MARKED_BLANK), F.lit(""))

    text = col(c)
    stretches = F.regexp_extract_all(text, F.lit(ASCII_STRETCH), F.lit(0))
    mixed = F.array_join(
        F.transform(stretches, lambda s: F.when(s.rlike(r"\A[\x02-\x7F]"), titled(s)).otherwise(s)), ""
    )
    return F.when(text.rlike(r"[^\x02-\x7F]"), mixed).otherwise(titled(text))


def only_letters(c: Column | str) -> Column:
    """True when letters remain alone after dropping quotes, hyphens, spaces and tabs."""
    bare = F.regexp_replace(strip(c), r"['\- \t]", "")
    return F.coalesce(bare.rlike(r"\A\p{L}+\z"), F.lit(False))


def one_of(c: Column | str, words: Iterable[str]) -> Column:
    """Exact membership in a list of words; null is false. Spark keeps the list as a hash set."""
    return F.coalesce(col(c).isin(sorted(words)), F.lit(False))
