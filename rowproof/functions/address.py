"""Address expressions: free-text parser, assembly and comparison key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof import lexicon
from rowproof.functions.text import col, one_of, strip

# --- fixed values: parts of one parsed address, in output order -------------------------------
PARTS = (
    "street_number", "street_name", "street_type", "unit", "city", "region1", "postal_code",
)
MARK = "\x01"

# --- fixed values: post-office box patterns, country postal forms -----------------------------
PO_BOX = r"[Pp]\.? ?[Oo]\.? [Bb][Oo][Xx] \d+"
POSTAL_FORMS = {"US": r"\d{5}(?:-\d{4})?", "CA": r"[a-z]\d[a-z]\s?\d[a-z]\d"}


def address_pattern(country: str, street_types: Sequence[str] | None = None) -> str:
    """Pattern of one street address: number, name, type, unit, city, region, postal code.

    It avoids look-around and back-references, so that any regular-expression engine can run it.
    """
    regions = lexicon.US_STATES if country == "US" else lexicon.CA_PROVINCES
    aliases = lexicon.US_STATE_ALIASES if country == "US" else {}
    names = [n.lower() for n in (*regions, *regions.values(), *aliases)]
    kinds = lexicon.word_pattern(street_types or lexicon.street_types())
    directions = lexicon.word_pattern(sorted(d.lower() for d in lexicon.DIRECTIONS))
    units = lexicon.word_pattern(lexicon.unit_words())
    return (
        r"\b(\d{1,6})\s+"
        r"((?:[a-z0-9'.]+\s+){0,3}?[a-z0-9'.]+)\s+"
        rf"({kinds})\b\.?"
        rf"(?:\s+{directions}\b\.?)?"
        r"(?:\s*,\s*|\s+)"
        rf"(?:({units}\b\.?\s+[a-z0-9-]+)(?:\s*,\s*|\s+))?"
        r"([a-z][a-z .'-]*?)(?:\s*,\s*|\s+)"
        rf"({lexicon.word_pattern(sorted(names))})(?:\s*,\s*|\s+)"
        rf"({POSTAL_FORMS[country]})\b"
    )


def _parse_one(text: Column, country: str, street_types: Sequence[str] | None) -> Column:
    """One match writes all groups behind a mark; a text without a match keeps no mark."""
    groups = MARK.join(f"${i}" for i in range(1, len(PARTS) + 1))
    pattern = rf"(?is)\A.*?{address_pattern(country, street_types)}.*\z"
    return F.regexp_replace(F.translate(text, MARK, " "), pattern, MARK + groups)


def parse_address(
    text: Column | str, country: Column | str, street_types: Sequence[str] | None = None
) -> Column:
    """First US or Canadian address in free text as a struct, null when there is none.

    `country` is a country code; other countries are not parsed.
    """
    t, c = col(text), col(country)
    marked = F.when(c == "US", _parse_one(t, "US", street_types)).when(
        c == "CA", _parse_one(t, "CA", street_types)
    )
    # The lambda's argument is computed once, though every field of the struct reads it.
    once = F.transform(F.array(F.split(marked, MARK)), lambda pieces: _address_struct(pieces, c))
    return F.get(once, F.lit(0))


def _address_struct(pieces: Column, country: Column) -> Column:
    def part(name: str) -> Column:
        piece = F.trim(F.get(pieces, F.lit(PARTS.index(name) + 1)))
        return F.when(piece != "", piece)

    unit = part("unit")
    in_building = unit.rlike(r"(?i)\A(?:building|bldg)\b")
    fields = [
        part("street_number").alias("street_number"),
        part("street_name").alias("street_name"),
        part("street_type").alias("street_type"),
        F.when(~in_building, unit).alias("occupancy"),
        F.when(in_building, unit).alias("building_id"),
        part("city").alias("city"),
        part("region1").alias("region1"),
        part("postal_code").alias("postal_code"),
        country.alias("country_id"),
    ]
    return F.when(F.size(pieces) == len(PARTS) + 1, F.struct(*fields))


def assemble_address(a1, a2, a3, city, state, postal, country) -> Column:
    """`a1 a2 a3 city, state postal country`, leaving out what is missing."""
    front = F.concat_ws(" ", col(a1), col(a2), col(a3), col(city))
    return F.concat(front, F.lit(", "), F.concat_ws(" ", col(state), col(postal), col(country)))


def address_between(address: Column | str, company: Column | str, city: Column | str) -> Column:
    """Text between the company name and the city, null when either is absent."""
    a = col(address)
    start = F.position(col(company), a) + F.length(col(company)) + 1
    end = F.position(col(city), a)
    found = (F.position(col(company), a) > 0) & (end > 0)
    return F.when(found, strip(F.substr(a, start, F.greatest(end - start, F.lit(0)))))


def match_key(street, city, state, postal) -> Column:
    """Lower-case letters and digits of street, city, state and ZIP; null if any is missing."""
    parts = [col(street), col(city), col(state), F.substring(col(postal), 1, 5)]
    joined = F.concat(parts[0], *(x for p in parts[1:] for x in (F.lit(" "), p)))
    return F.lower(strip(F.regexp_replace(joined, r"[^A-Za-z0-9 ]+", "")))


def is_po_box(line: Column | str) -> Column:
    return F.coalesce(col(line).rlike(PO_BOX), F.lit(False))


def po_box_line(line: Column | str) -> Column:
    """`PO Box <number>` for a line that holds a post-office box, other lines unchanged."""
    tight = F.lower(F.replace(col(line), F.lit(" "), F.lit("")))
    rest = F.regexp_extract(tight, r"(?s)\A.*?box(.*)\z", 1)
    return F.when(is_po_box(line), F.concat(F.lit("PO Box "), rest)).otherwise(col(line))


def count_words(text: Column | str, words: Sequence[str]) -> Column:
    """How many words of the text, letters only, belong to the list."""
    letters = F.lower(strip(F.regexp_replace(col(text), r"[^A-Za-z '\-]+", "")))
    return F.size(F.filter(F.split(letters, r"\s+"), lambda w: one_of(w, words)))
