"""Literal inputs with known results, one rule at a time."""

import pytest

from rowproof.functions import contact, geo, phone, postal, text
from rowproof.functions import address as address_text

PHONE = "1 978 877-3200, ext. 456"


@pytest.mark.parametrize(
    "number, country, clean",
    [
        (PHONE, "US", "9788773200,ext.456"),
        ("+1 (212) 555-0000", "US", "2125550000"),
        ("978.877.3200", "US", "978.877.3200"),
        (PHONE, "CA", PHONE),
        (None, "US", None),
    ],
)
def test_clean_phone(apply, number, country, clean):
    assert apply(phone.clean_phone_us("a", "b"), [(number, country)]) == [clean]


def test_format_phone(apply):
    rows = [(PHONE, "US"), ("(226) 791-9215", "CA"), ("12345", "US"), (None, "US")]
    assert apply(phone.format_phone("a", "b"), rows) == ["(978) 877-3200", "(226) 791-9215", None, None]


def test_extension(apply):
    rows = [(PHONE, "US"), ("9788773200", "US"), ("9788773200 x", "US"), (PHONE, "CA")]
    assert apply(phone.extension("a", "b"), rows) == ["Ext 456", None, "Ext ", None]


def test_phone_is_valid(apply):
    rows = [
        (PHONE, "US"), ("(000) 000-0000, ext. 456", "US"), ("(226) 791-9215", "CA"),
        ("+44 20 7946 0958", "US"), ("(226) 791-9215", "GB"), (None, "US"), ("978 8OO-3200", "US"),
    ]
    expected = [True, False, True, False, False, False, False]
    assert apply(phone.phone_is_valid("a", "b"), rows) == expected


def test_area_codes(apply):
    rows = [(PHONE, "US"), ("(226) 791-9215", "CA")]
    assert apply(phone.phone_is_valid("a", "b", {"978"}), rows) == [True, False]


def test_phone_cleaning(apply):
    rows = [
        (PHONE, "United States"), ("+44 20 7946 0958", "US"), ("(226) 791-9215", "CA"),
        ("12345", "US"), (None, "US"), (PHONE, None), ("978.877.3200", "US"),
    ]
    result = [tuple(r) for r in apply(phone.phone_cleaning("a", "b"), rows)]
    assert result == [
        (True, "(978) 877-3200", "Ext 456"),
        (False, "(442) 079-4609", None),
        (False, "(226) 791-9215", None),
        (False, "12345", None),
        (False, None, None),
        (False, PHONE, None),
        (False, "(978) .87-7.32", None),
    ]


def test_email(apply):
    rows = [
        "mickey.mouse@gmail.com", "mickey.mousegmail.com", ".a@example.com", "a@b.co\n", "_a@b.c1",
        "a@b.toolongtoplevelnamehere", None, "",
    ]
    assert apply(contact.email_check("a"), rows) == [True, False, False, False, False, False, False, False]


def test_email_valid(apply):
    rows = [
        "mickey.mouse@gmail.com", "User.1@Example.COM", "a..b@x.com", ".a@x.com", "a@x", "a@-x.com",
        "l" * 65 + "@x.com", "l" * 64 + "@x.com", "a@1.2", None,
    ]
    assert apply(contact.email_valid("a"), rows) == [
        "mickey.mouse@gmail.com", "User.1@example.com", None, None, None, None, None,
        "l" * 64 + "@x.com", None, None,
    ]


def test_website(apply):
    rows = [
        "https://www.google.com/", "www.example.com", "mailto:a@b.com", "http:/x", "http:///x",
        " http://x", "http://[x", "http://[::1]/", "ftp://h", "1http://x", None, "",
    ]
    expected = [True, False, False, False, False, True, False, True, True, False, False, False]
    assert apply(contact.website_check("a"), rows) == expected


def test_names(apply):
    rows = ["Micky Mouse-O'Maley's", "Mickey Mouse 4", "Éva", " \tAnn\n", "", "'-", None, "A B"]
    expected = [True, False, True, True, False, False, False, False]
    assert apply(contact.name_check("a"), rows) == expected
    assert apply(geo.city_check("a"), rows) == expected


def test_name_format(apply):
    rows = ["Mickey Mouse", "Mickey Mouse 4", "Éva", "Zoë 2", None]
    assert apply(contact.name_format("a"), rows) == ["Mickey Mouse", "Mickey Mouse", "Éva", "Zo", None]


def test_title(apply):
    rows = [
        "FunkY TiTLE", "mary-ann o'neil 3rd éLan", "a'b'c", "ab3cd_EF", "", None, "x\u0001 y", "ÉÉ",
        "it''s", "'tis", "A'", "rock'n'roll",
    ]
    assert apply(text.title_case("a"), rows) == [
        "Funky Title", "Mary-Ann O'neil 3Rd éLan", "A'b'C", "Ab3Cd_Ef", "", None, "X\u0001 Y", "ÉÉ",
        "It''S", "'Tis", "A'", "Rock'n'Roll",
    ]


def test_scrub_and_strip(apply):
    assert apply(text.scrub("a"), ["a\r\nb\tc\fd", "né\u0000​w ~`^[]", None]) == [
        "a  b c d", "nw ~`^[]", None,
    ]
    assert apply(text.strip("a"), [" \t x y \n", "", None]) == ["x y", "", None]


def test_identifier(apply):
    assert apply(text.identifier("a"), [" ['dbo'] "]) == ["dbo"]
    assert text.identifier_text(["dbo"]) == "dbo"


def test_country(apply):
    rows = ["US", "United States", "us", "CÔTE D'IVOIRE", "Bolivia, Plurinational State of", "XX", None]
    assert apply(geo.country_check("a"), rows) == [True, False, False, False, False, False, False]
    assert apply(geo.country_format("a"), rows) == ["US", "US", None, "CI", "BO", None, None]


def test_state(apply):
    rows = [("MA", "US"), ("Massachusetts", "US"), ("ON", "CA"), ("MA", "CA"), ("x", "FR"), (None, "US"), ("x", None)]
    assert apply(geo.state_check("a", "b"), rows) == [True, False, True, False, True, False, True]
    rows = [
        ("Massachusetts", "US"), ("massachusetts", "US"), ("DISTRICT OF COLUMBIA", "US"),
        ("Newfoundland and Labrador", "CA"), ("Guam GU", "US"), ("Guam", "US"), ("Ontario", "US"),
        ("Ontario", "FR"),
    ]
    assert apply(geo.state_name_to_code("a", "b"), rows) == [
        "MA", "MA", "DC", "NL", "GU", "GU", None, None,
    ]
    assert apply(geo.country_by_state("a"), ["MA", "ON", "ZZ", None]) == ["US", "CA", None, None]


@pytest.mark.parametrize(
    "code, country, fits",
    [
        ("01824", "US", True), ("01824-12", "US", False), ("L6S 0A0", "CA", True),
        ("l6s 0a0", "CA", False), ("2000x", "AU", True), ("10115 Berlin", "DE", True),
        ("01310-100", "BR", True), ("75001", "FR", True), ("75001x", "FR", False),
        ("123-4567", "JP", True), ("SW1A 1AA", "GB", True), ("560001", "IN", True),
        ("560 001", "IN", True), ("060001", "IN", False), ("1", "ZZ", False), (None, "US", False),
        ("01824\n", "US", False),
    ],
)
def test_postal_patterns(apply, code, country, fits):
    assert apply(postal.zip_code_regex("a", "b"), [(code, country)]) == [fits]


FULL_1 = """
    '12641 The Company Name
    8283 N Hayden Rd, Ste 145
    Scottsdale AZ 85258 United States'
    """
FULL_2 = """
    "Duck Man 4701 West Research Drive,
    Suite 120 Suite 300 Sioux Falls SD 57107-1312"
    """
FULL_3 = "20 Fleeceline Road, Toronto, Ontario M8V 2K3"


def test_parse_address(apply):
    rows = [(FULL_1, "US"), (FULL_2, "US"), (FULL_3, "CA"), (FULL_3, "US"), (FULL_1, None), (None, "US")]
    first, *rest = apply(address_text.parse_address("a", "b"), rows)
    assert first.asDict() == {
        "street_number": "8283", "street_name": "N Hayden", "street_type": "Rd",
        "occupancy": "Ste 145", "building_id": None, "city": "Scottsdale", "region1": "AZ",
        "postal_code": "85258", "country_id": "US",
    }
    assert rest[1].postal_code == "M8V 2K3"
    assert [r is None for r in rest] == [True, False, True, True, True]


def test_parse_building(apply):
    [row] = apply(
        address_text.parse_address("a", "b"), [("1 Main St Bldg 7, Boston, MA 02110", "US")]
    )
    assert (row.occupancy, row.building_id, row.city) == (None, "Bldg 7", "Boston")


def test_address_between(apply):
    rows = [("Acme Inc 1 Main St Boston", "Acme Inc", "Boston"), ("x", "Acme", "Boston"),
            ("Boston Acme", "Acme", "Boston"), (None, "a", "b")]
    expression = address_text.address_between("a", "b", "c")
    assert apply(expression, rows) == ["1 Main St", None, "", None]


def test_po_box(apply):
    rows = ["P.O. Box 110404", "PO Box 12", "p.o. box 7 rear", "Box 7", None, "P. O. BOX 9"]
    assert apply(address_text.po_box_line("a"), rows) == [
        "PO Box 110404", "PO Box 12", "PO Box 7rear", "Box 7", None, "PO Box 9",
    ]
