"""Address validation job: parse, check against references, repair, and explain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof import lexicon
from rowproof.functions import address as A
from rowproof.functions import geo
from rowproof.functions.postal import zip_code_check
from rowproof.functions.text import strip, title_case
from rowproof.operators.columns import spread
from rowproof.operators.ziplookup import with_zip_lookup

# --- fixed values: output columns of one address group, after the group's root name -----------
OUTPUTS = (
    "addr_is_valid", "addr_error_messg", "street", "suite", "city", "state", "postal_code",
    "country", "full_address",
)

# --- fixed values: messages in the order of the checks, and the condition of each -------------
MESSAGES = {
    "Missing address": "_street IS NULL",
    "possible parsing issue": "_street IS NULL OR _kinds > 2 OR _units >= 1",
    "Missing Country": "_country0 IS NULL",
    "Country Reformatted to Code": "_country0 IS NOT NULL AND _country1 <> _country0",
    "Invalid Country": "_country0 IS NOT NULL AND _country1 IS NULL",
    "Country Reformatted by State": "_country0 IS NULL AND _country1 IS NOT NULL",
    "Bad Postal Code": "_postal IS NULL OR NOT _zip_ok",
    "Missing State / Zip": "_state IS NULL AND _zip0 IS NULL",
    "Reformatting State Using Zip": "_state IS NULL AND _zip0 IS NOT NULL",
    "State Reformatted": "_state_code IS NOT NULL",
    "Invalid State": "_lost_state",
    "Missing City": "_city IS NULL AND _zip0 IS NULL",
    "City is not alpha": "_city IS NOT NULL AND NOT _city_ok",
    "Reformatted City with Zip": "_city IS NULL AND _zip_city IS NOT NULL",
    "City spelling reformatted": "_respelled",
    "Check if suite is valid": "NOT _parses AND _two_suites",
    "Not capable of parsing": "NOT _parses AND NOT _two_suites AND NOT (_box1 OR _box2 OR _hash)",
    "PO Box reformat": "NOT _parses AND NOT _two_suites AND _box1",
    "Check PO Box in Suite": "NOT _parses AND NOT _two_suites AND _box2 AND NOT _box1",
    "Building number reformat": "NOT _parses AND NOT _two_suites AND _hash AND NOT (_box1 OR _box2)",
}


def clean_addresses(
    df: DataFrame,
    root: str,
    zip_ref: DataFrame,
    *,
    address1: Column | str,
    city: Column | str,
    state: Column | str,
    postal_code: Column | str,
    country: Column | str | None = None,
    full_address: Column | str | None = None,
    address2: Column | str | None = None,
    address3: Column | str | None = None,
    street_types: Sequence[str] | None = None,
) -> DataFrame:
    """Add the nine `{root}_...` columns; `{root}_addr_error_messg` is an array of messages.

    The rows are dealt to tasks by their number first, since the patterns cost far more than reading.
    """
    return with_clean_address(
        spread(df), root, zip_ref, address1=address1, city=city, state=state, postal_code=postal_code,
        country=country, full_address=full_address, address2=address2, address3=address3, street_types=street_types,
    )


def with_clean_address(
    df: DataFrame,
    root: str,
    zip_ref: DataFrame,
    *,
    address1: Column | str,
    city: Column | str,
    state: Column | str,
    postal_code: Column | str,
    country: Column | str | None = None,
    full_address: Column | str | None = None,
    address2: Column | str | None = None,
    address3: Column | str | None = None,
    street_types: Sequence[str] | None = None,
) -> DataFrame:
    """`clean_addresses` of rows that stay in their tasks, for several address groups of the same rows.

    Rows are only extended: one projection before the ZIP join and one after it, whose later
    columns refer to its earlier ones. Working columns start with `_` and are dropped again.
    """
    types = street_types or lexicon.street_types()
    given = {
        "_full": full_address,
        "_a1": address1,
        "_a2": address2,
        "_a3": address3,
        "_city0": city,
        "_state0": state,
        "_zip0": postal_code,
        "_country0": F.lit("US") if country is None else country,
    }
    before = {name: _text(value) for name, value in given.items()} | _taken_apart(types)
    after = _repaired(types) | {
        "_parses": A.parse_address("_again", "_country2", types).isNotNull(),
        "_messages": F.expr(_message_array()),
    }
    result = {
        "addr_is_valid": F.expr("size(_messages) = 0"),
        "addr_error_messg": F.col("_messages"),
        "street": F.col("_street"),
        "suite": F.col("_suite"),
        "city": F.col("_city2"),
        "state": F.col("_state2"),
        "postal_code": F.col("_postal"),
        "country": F.col("_country2"),
        "full_address": A.match_key("_street", "_city2", "_state2", "_postal"),
    }
    original = df.columns
    taken_apart = df.select("*", *_named(before))
    joined = with_zip_lookup(taken_apart, "_postal", zip_ref, out="_hit")
    repaired = joined.select("*", *_named(after))
    return repaired.select(*original, *(result[name].alias(f"{root}_{name}") for name in OUTPUTS))


def _text(value: Column | str | None) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


def _message_array() -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{text}' END" for text, cond in MESSAGES.items())
    return f"array_compact(array({cases}))"


def _taken_apart(street_types: Sequence[str]) -> dict[str, Column]:
    """Parsed parts, or the first line split at `#` or at a comma when parsing fails."""
    assembled = A.assemble_address("_a1", "_a2", "_a3", "_city0", "_state0", "_zip0", "_country0")
    return {
        "_line1": A.po_box_line("_a1"),
        "_box1": A.is_po_box("_a1"),
        "_box2": A.is_po_box("_a2"),
        "_hash": F.expr("coalesce(contains(_line1, '#'), false)"),
        "_two_suites": F.expr("coalesce(lower(_a1) RLIKE 'suite|ste', false) AND _a2 IS NOT NULL"),
        "_parsed": A.parse_address(
            F.coalesce(F.col("_full"), assembled), geo.country_format("_country0"), street_types
        ),
        "_ok": F.expr("_parsed IS NOT NULL"),
        "_mark": F.expr("CASE WHEN _hash THEN '#' WHEN contains(_line1, ',') THEN ',' END"),
        "_before": F.expr("substring_index(_line1, _mark, 1)"),
        "_behind": F.expr("'#' || substr(_line1, length(_before) + 2)"),
        "_street": F.when(
            F.col("_ok"),
            F.expr("concat_ws(' ', _parsed.street_number, _parsed.street_name, _parsed.street_type)"),
        )
        .when(F.col("_mark").isNotNull(), strip("_before"))
        .otherwise(F.col("_line1")),
        "_suite": F.expr(
            """CASE WHEN _ok THEN coalesce(_parsed.occupancy, _parsed.building_id)
                WHEN _hash THEN concat_ws(' ', _a2, _behind)
                WHEN _mark = ',' THEN concat_ws(' ', _behind, _a2) ELSE _a2 END"""
        ),
        "_city": F.expr("CASE WHEN _ok THEN _parsed.city ELSE _city0 END"),
        "_state": F.expr("CASE WHEN _ok THEN _parsed.region1 ELSE _state0 END"),
        "_postal": F.expr("CASE WHEN _ok THEN _parsed.postal_code ELSE _zip0 END"),
    }


def _repaired(street_types: Sequence[str]) -> dict[str, Column]:
    """Country, postal code, state and city after the repairs, and the text to parse again."""
    return {
        "_kinds": A.count_words("_street", street_types),
        "_units": A.count_words("_street", lexicon.unit_words()),
        "_country1": F.when(
            F.col("_country0").isNotNull(), geo.country_format("_country0")
        ).otherwise(geo.country_by_state("_state")),
        "_zip_ok": zip_code_check("_postal", "_country1", F.expr("_hit IS NOT NULL")),
        "_zip_city": F.expr("CASE WHEN _zip_ok THEN _hit.place END"),
        "_state1": F.expr(
            "coalesce(_state, CASE WHEN _zip_ok AND _zip0 IS NOT NULL THEN _hit.state END)"
        ),
        "_bad_state": F.col("_country1").isNotNull() & ~geo.state_check("_state1", "_country1"),
        "_state_code": F.when(
            F.col("_bad_state"), geo.state_name_to_code("_state1", "_country1")
        ),
        "_lost_state": F.expr("_bad_state AND _state_code IS NULL"),
        "_state2": F.expr("coalesce(_state_code, _state1)"),
        "_country2": F.expr("CASE WHEN NOT _lost_state THEN _country1 END"),
        "_city_ok": geo.city_check("_city"),
        "_respelled": F.expr(
            """coalesce(_city_ok AND _state2 IS NOT NULL AND _postal IS NOT NULL
                AND lower(_zip_city) <> lower(_city), false)"""
        ),
        "_city1": F.expr("CASE WHEN _city IS NULL OR _respelled THEN _zip_city ELSE _city END"),
        "_city2": F.when(F.length("_city1") > 3, strip(title_case("_city1"))).otherwise(
            F.col("_city1")
        ),
        "_again": F.expr(
            """CASE WHEN _ok THEN
                CASE WHEN _suite IS NOT NULL THEN coalesce(_street, '') || ' ' || _suite
                    ELSE coalesce(_line1, '') END
                || ' ' || coalesce(_city2, '') || ', ' || coalesce(_state2, '') || ' '
                || coalesce(_postal, '') || ' ' || coalesce(_country0, '') END"""
        ),
    }
