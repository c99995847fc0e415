"""Country, state and city expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof import lexicon
from rowproof.functions.text import col, one_of, only_letters, strip


def _lookup(table: dict[str, str], key: Column) -> Column:
    """Value of the key in a fixed table, a map of literals that Spark folds to one constant."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def country_check(country: Column | str) -> Column:
    """Exact, case-sensitive membership in the country codes."""
    return one_of(col(country), lexicon.countries())


def country_format(country: Column | str) -> Column:
    """Country code for a code or a full name, else null."""
    c = col(country)
    named = _lookup(lexicon.country_codes_by_name(), F.upper(c))
    return F.when(country_check(c), c).otherwise(named)


def state_check(state: Column | str, country: Column | str) -> Column:
    """State code belongs to the country; countries other than US and CA are not checked."""
    s, c = col(state), col(country)
    return (
        F.when(c == "US", one_of(s, lexicon.US_STATES))
        .when(c == "CA", one_of(s, lexicon.CA_PROVINCES))
        .otherwise(F.lit(True))
    )


def state_name_to_code(state: Column | str, country: Column | str) -> Column:
    """State code for a full name in any letter case; null outside US and CA."""
    c = col(country)
    name = F.upper(strip(state))
    return F.when(c == "US", _lookup(lexicon.us_codes_by_name(), name)).when(
        c == "CA", _lookup(lexicon.ca_codes_by_name(), name)
    )


def country_by_state(state: Column | str) -> Column:
    s = col(state)
    return F.when(one_of(s, lexicon.US_STATES), F.lit("US")).when(
        one_of(s, lexicon.CA_PROVINCES), F.lit("CA")
    )


def city_check(city: Column | str) -> Column:
    return only_letters(city)
