"""Address scenarios with their exact message lists, and the repairs."""

import pytest

from rowproof.operators.address import clean_addresses
from rowproof.operators.ziplookup import us_zip_code, with_zip_lookup, zip_lookup
from tests.test_functions import FULL_1, FULL_2, FULL_3

FULL_4 = "James Hutchinson 250 Williams St Nw #3000 Atlanta GA 30303-1042"
FULL_5 = "Tom Livingston P.O. Box 110404 Durham NC 27709"
COLUMNS = ["full", "a1", "a2", "a3", "city", "state", "zip", "country"]
CASES = [
    ((FULL_1, "8283 N Hayden Rd, Ste 145", None, "x", "Scottsdale", "AZ", "85258", "US"), []),
    ((FULL_2, "4701 West Research Drive, Suite 120", "Suite 300", None, "Sioux Falls", "SD",
      "57107-1312", "US"), ["Check if suite is valid"]),
    ((FULL_3, "20 Fleeceline Road", None, None, "Toronto", "Ontario", "M8V 2K3", "Canada"),
     ["Country Reformatted to Code", "State Reformatted"]),
    ((FULL_4, "250 Williams St Nw #3000", None, None, "Atlanta", "GA", "30303-1042", "US"),
     ["Building number reformat"]),
    ((FULL_5, "P.O. Box 110404", None, None, "Durham", "NC", "27709", "US"), ["PO Box reformat"]),
    # The same address from its parts only, with repairs of city spelling and case.
    ((None, "8283 N Hayden Rd, Ste 145", None, None, "scottsdale", "AZ", "85258", "US"), []),
    ((None, "8283 N Hayden Rd", None, None, "Scotsdale", "AZ", "85258", "US"),
     ["City spelling reformatted"]),
    ((None, "PO Box 9", None, None, None, None, "27709", "US"),
     ["Reformatting State Using Zip", "Reformatted City with Zip", "PO Box reformat"]),
    ((None, None, None, None, None, None, None, None),
     ["Missing address", "possible parsing issue", "Missing Country", "Bad Postal Code",
      "Missing State / Zip", "Missing City", "Not capable of parsing"]),
    ((None, "1 Main St", None, None, "Durham 2", "ZZ", "27709", "US"),
     ["Invalid State", "City is not alpha", "Not capable of parsing"]),
    ((None, "1 Main St", None, None, "Durham", "NC", "27709", "Nowhere"),
     ["Invalid Country", "Bad Postal Code", "Not capable of parsing"]),
    ((None, "1 Main St", None, None, "Durham", "NC", "27709", None),
     ["Missing Country", "Country Reformatted by State", "Not capable of parsing"]),
    ((None, "1 Rear #2", "PO Box 7", None, "Durham", "NC", "27709", "US"), ["Check PO Box in Suite"]),
    ((None, "Park Lake Mill Hill", None, None, "Oslo", "NC", "27709", "US"),
     ["possible parsing issue", "City spelling reformatted", "Not capable of parsing"]),
]


@pytest.fixture(scope="module")
def zips(spark):
    rows = [("01824", "Chelmsford", "MA"), ("85258", "Scottsdale", "AZ"), ("57107", "Sioux Falls", "SD"),
            ("30303", "Atlanta", "GA"), ("27709", "Durham", "NC"), ("27709", "Durham", "NC")]
    return spark.createDataFrame(rows, "zip string, place string, state string")


@pytest.fixture(scope="module")
def cleaned(spark, zips):
    rows = [(i, *case) for i, (case, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} string" for c in COLUMNS))
    out = clean_addresses(
        df, "x", zips, full_address="full", address1="a1", address2="a2", address3="a3", city="city",
        state="state", postal_code="zip", country="country",
    )
    assert out.columns[: len(df.columns)] == df.columns
    return {r["id"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_messages(cleaned, i):
    assert cleaned[i].x_addr_error_messg == CASES[i][1]
    assert cleaned[i].x_addr_is_valid == (not CASES[i][1])


def test_outputs(cleaned):
    row = cleaned[0]
    assert (row.x_street, row.x_suite, row.x_city) == ("8283 N Hayden Rd", "Ste 145", "Scottsdale")
    assert row.x_full_address == "8283 n hayden rd scottsdale az 85258"
    assert cleaned[5].x_full_address == row.x_full_address
    assert (cleaned[1].x_street, cleaned[1].x_suite) == (
        "4701 West Research Drive", "# Suite 120 Suite 300",
    )
    assert (cleaned[3].x_street, cleaned[3].x_suite) == ("250 Williams St Nw", "#3000")
    assert (cleaned[2].x_state, cleaned[2].x_country) == ("ON", "CA")
    assert (cleaned[7].x_city, cleaned[7].x_state) == ("Durham", "NC")
    assert cleaned[9].x_country is None
    assert cleaned[8].x_full_address is None
    assert cleaned[12].x_suite == "PO Box 7 #2"


def test_zip_reference(spark, zips):
    df = spark.createDataFrame([("01824-1",), ("8124",), (None,), ("27709",)], "z string")
    rows = with_zip_lookup(df, "z", zips).select("z", us_zip_code("zip_hit").alias("ok"), "zip_hit.*")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("01824-1", True, "01824", "Chelmsford", "MA"), ("8124", False, None, None, None),
         (None, False, None, None, None), ("27709", True, "27709", "Durham", "NC")], key=str)
    places = spark.createDataFrame([("Chelmsford", "MA"), ("x", "MA")], "p string, s string")
    assert [r.zips for r in zip_lookup(places, "p", "s", zips).orderBy("p").collect()] == [["01824"], []]
