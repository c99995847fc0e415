"""Lookup values shared by the geography and address rules."""

from __future__ import annotations

from functools import cache
from importlib.resources import files
from pathlib import Path

# --- fixed values: postal codes and names of US states and territories -----------------------
US_STATES = {
    "AK": "Alaska", "AL": "Alabama", "AR": "Arkansas", "AZ": "Arizona", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "FL": "Florida", "GA": "Georgia",
    "HI": "Hawaii", "IA": "Iowa", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "MA": "Massachusetts",
    "MD": "Maryland", "ME": "Maine", "MI": "Michigan", "MN": "Minnesota", "MO": "Missouri",
    "MS": "Mississippi", "MT": "Montana", "NC": "North Carolina", "ND": "North Dakota",
    "NE": "Nebraska", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico",
    "NV": "Nevada", "NY": "New York", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon",
    "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota",
    "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VA": "Virginia", "VT": "Vermont",
    "WA": "Washington", "WI": "Wisconsin", "WV": "West Virginia", "WY": "Wyoming",
    "DC": "District of Columbia", "AS": "American Samoa", "GU": "Guam",
    "MP": "Northern Mariana Islands", "PR": "Puerto Rico", "VI": "U.S. Virgin Islands",
}

# --- fixed values: second spellings accepted for two territories ------------------------------
US_STATE_ALIASES = {"Guam GU": "GU", "Puerto Rico PR": "PR"}

# --- fixed values: Canadian provinces and territories -----------------------------------------
CA_PROVINCES = {
    "AB": "Alberta", "BC": "British Columbia", "MB": "Manitoba", "NB": "New Brunswick",
    "NL": "Newfoundland and Labrador", "NS": "Nova Scotia", "NT": "Northwest Territories",
    "NU": "Nunavut", "ON": "Ontario", "PE": "Prince Edward Island", "QC": "Quebec",
    "SK": "Saskatchewan", "YT": "Yukon",
}

# --- fixed values: unit designators -----------------------------------------------------------
UNIT_WORDS = (
    "Apartment", "Apt", "Building", "Bldg", "Department", "Dept", "Floor", "Fl", "Lobby",
    "Lbby", "Lot", "Suite", "Ste", "Unit",
)

# --- fixed values: compass directions written after a street type -----------------------------
DIRECTIONS = (
    "North", "South", "East", "West", "Northeast", "Northwest", "Southeast", "Southwest",
    "NE", "NW", "SE", "SW", "N", "S", "E", "W",
)


def _lines(path: str | None, default: str) -> list[str]:
    """Lines of a table of fixed values that are not comments: of the file given, else of ours."""
    text = Path(path).read_text("utf-8") if path else (files("rowproof") / "data" / default).read_text("utf-8")
    return [line for line in text.splitlines() if line and not line.startswith("#")]


@cache
def street_types(path: str | None = None) -> list[str]:
    """Lower-case street-type words of a table with one word to a line."""
    return sorted({w.lower() for w in _lines(path, "street_types.txt")})


def unit_words() -> list[str]:
    return sorted(w.lower() for w in UNIT_WORDS)


@cache
def countries(path: str | None = None) -> dict[str, str]:
    """Country code -> upper-case name, of a table with one code and name to a line."""
    return dict(line.split(" ", 1) for line in _lines(path, "countries.txt"))


def country_codes_by_name() -> dict[str, str]:
    return {name: code for code, name in countries().items()}


def us_codes_by_name() -> dict[str, str]:
    """Upper-case state name -> code."""
    names = {name.upper(): code for code, name in US_STATES.items()}
    return names | {name.upper(): code for name, code in US_STATE_ALIASES.items()}


def ca_codes_by_name() -> dict[str, str]:
    return {name.upper(): code for code, name in CA_PROVINCES.items()}


def word_pattern(words) -> str:
    """Regular expression for a set of lower-case words, sharing common beginnings.

    A flat alternation is tried word by word at every position; the shared form needs about one
    step per letter. Longer words are tried before their own beginnings.
    """
    tree: dict = {}
    for word in words:
        node = tree
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = {}

    def write(node: dict) -> str:
        ends = "" in node
        branches = [
            (r"\s+" if ch == " " else ch if ch.isalnum() else "\\" + ch) + write(child)
            for ch, child in sorted(node.items())
            if ch
        ]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and not ends else f"(?:{'|'.join(branches)})"
        return body + "?" if ends else body

    return write(tree)
