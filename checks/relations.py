"""Relations derived from the given tables, as SQL text that Spark and DuckDB read alike."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

K = "c_custkey"
TEXT_K = f"CAST({K} AS STRING)"

# One row per customer: names, e-mail, phone, web address and country in good and bad forms.
CONTACT_COLUMNS = {
    "contact_id": K,
    "account_id": "c_nationkey",
    "first_name": f"""CASE {K} % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Mickey Mouse 4'
        WHEN 2 THEN 'O' || chr(39) || 'Maley' WHEN 3 THEN ' Mary-Ann ' WHEN 4 THEN 'Éva'
        ELSE c_mktsegment END""",
    "last_name": "c_name",
    "email": f"""CASE {K} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'user' || {TEXT_K} || 'example.com'
        WHEN 2 THEN '.u' || {TEXT_K} || '@example.com'
        WHEN 3 THEN 'User.' || CAST({K} % 100 AS STRING) || '@Example.COM'
        ELSE 'u' || {TEXT_K} || '@mail.example.org' END""",
    "phone": f"""CASE {K} % 8 WHEN 0 THEN NULL
        WHEN 1 THEN '1 978 877-' || CAST(1000 + {K} % 9000 AS STRING) || ', ext. 456'
        WHEN 2 THEN '(000) 000-0000, ext. 456'
        WHEN 3 THEN '(226) 791-' || CAST(1000 + {K} % 9000 AS STRING)
        WHEN 4 THEN '+44 20 7946 0958' WHEN 5 THEN '978.877.3200' WHEN 6 THEN '12345'
        ELSE '+1' || CAST(2125550000 + {K} % 10000 AS STRING) END""",
    "url": f"""CASE {K} % 6 WHEN 0 THEN 'https://www.example.com/' || {TEXT_K}
        WHEN 1 THEN 'www.example.com' WHEN 2 THEN 'mailto:a@example.com' WHEN 3 THEN NULL
        WHEN 4 THEN 'http:/x' ELSE 'ftp://h' END""",
    "country": f"""CASE {K} % 4 WHEN 0 THEN 'United States' WHEN 1 THEN 'CA' WHEN 2 THEN 'US'
        ELSE NULL END""",
    "revenue": f"""CASE WHEN {K} % 9 = 0 THEN NULL WHEN {K} % 97 = 1 THEN c_acctbal * 50
        ELSE c_acctbal END""",
}

# One row per customer: six address shapes.
ADDRESS_COLUMNS = {
    "address_id": K,
    "address1": f"""CASE {K} % 6 WHEN 0 THEN '8283 N Hayden Rd, Ste 145'
        WHEN 1 THEN '4701 West Research Drive, Suite 120'
        WHEN 2 THEN CAST(20 + {K} % 40 AS STRING) || ' Fleeceline Road'
        WHEN 3 THEN '250 Williams St Nw #3000'
        WHEN 4 THEN 'P.O. Box ' || CAST(110404 + {K} % 25 AS STRING) ELSE NULL END""",
    "address2": f"CASE {K} % 6 WHEN 1 THEN 'Suite 300' ELSE NULL END",
    "city": f"""CASE {K} % 6 WHEN 0 THEN 'scottsdale' WHEN 1 THEN 'Sioux Fals' WHEN 2 THEN 'Toronto'
        WHEN 3 THEN 'Atlanta' WHEN 4 THEN NULL ELSE 'Durham 2' END""",
    "state": f"""CASE {K} % 6 WHEN 0 THEN 'AZ' WHEN 1 THEN 'SD' WHEN 2 THEN 'Ontario'
        WHEN 3 THEN 'Georgia' WHEN 4 THEN NULL ELSE 'ZZ' END""",
    "postal_code": f"""CASE {K} % 6 WHEN 0 THEN '85258' WHEN 1 THEN '57107-1312' WHEN 2 THEN 'M8V 2K3'
        WHEN 3 THEN '30303-1042' WHEN 4 THEN '27709' ELSE '8124' END""",
    "country": f"""CASE {K} % 6 WHEN 2 THEN 'Canada' WHEN 3 THEN 'United States' WHEN 5 THEN NULL
        ELSE 'US' END""",
}

# One row per customer: numbers with nulls, NaN (also in most rows) and infinities.
NAN, INFINITY = "CAST('NaN' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)"
MEASURE_COLUMNS = {
    "id": K,
    "few": f"CASE {K} % 7 WHEN 0 THEN {NAN} WHEN 1 THEN NULL WHEN 2 THEN c_acctbal * ({K} % 40) ELSE c_acctbal END",
    "many": f"CASE WHEN {K} % 5 < 3 THEN {NAN} WHEN {K} % 35 = 3 THEN 90000.0 ELSE c_acctbal END",
    "endless": f"CASE {K} % 50 WHEN 3 THEN {INFINITY} WHEN 4 THEN -{INFINITY} WHEN 5 THEN {NAN} ELSE c_acctbal END",
}

STREET_WORDS = [
    line for line in (Path(__file__).parent.parent / "rowproof/data/street_types.txt").read_text("utf-8").splitlines()
    if line[0] != "#"
]
LINE_COLUMNS = {
    "line_id": K,
    "line": f"""CAST({K} AS STRING) || ' Ocean '
        || split_part('{"|".join(STREET_WORDS)}', '|', CAST({K} % {len(STREET_WORDS)} + 1 AS INT))
        || split_part(', | NW, | North, | s, |. | E ', '|', CAST({K} % 6 + 1 AS INT))
        || split_part('|Apt 4, |Unit 7 |bldg C, |STE 12b, |Floor 3, ', '|', CAST({K} % 5 + 1 AS INT))
        || 'Miami, FL 33101'""",
}

# A reference of thousands of ZIPs, some twice, and postal codes that meet it or not.
LARGE_ZIP_COLUMNS = {
    "zip": "substr(CAST(100000 + o_orderkey % 7919 AS STRING), 2)",
    "place": "'Town ' || CAST(o_orderkey % 7919 % 40 AS STRING)",
    "state": "CASE o_orderkey % 7919 % 3 WHEN 0 THEN 'MA' WHEN 1 THEN 'AZ' ELSE 'GA' END",
}
POSTAL_COLUMNS = {
    "o_orderkey": "o_orderkey",
    "postal_code": """CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '00007'
        ELSE substr(CAST(100000 + o_custkey * 31 % 9000 AS STRING), 2) || '-1234' END""",
}

ZIP_ROWS = """VALUES ('01824', 'Chelmsford', 'MA'), ('85258', 'Scottsdale', 'AZ'),
    ('57107', 'Sioux Falls', 'SD'), ('30303', 'Atlanta', 'GA'), ('27709', 'Durham', 'NC')"""


def _select(columns: dict[str, str], source: str) -> str:
    fields = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT {fields} FROM {source}"


CONTACTS_CTE = f"contacts AS ({_select(CONTACT_COLUMNS, 'customer')})"
ADDRESSES_CTE = f"addresses AS ({_select(ADDRESS_COLUMNS, 'customer')})"
MEASURES_CTE = f"measures AS ({_select(MEASURE_COLUMNS, 'customer')})"
LINES_CTE = f"street_lines AS ({_select(LINE_COLUMNS, 'customer')})"
LARGE_ZIP_CTE = f"zip_ref AS ({_select(LARGE_ZIP_COLUMNS, 'orders')})"
POSTAL_CTE = f"postal AS ({_select(POSTAL_COLUMNS, 'orders')})"
ZIP_CTE = f"zip_ref(zip, place, state) AS ({ZIP_ROWS})"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in CONTACT_COLUMNS.items()))


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in ADDRESS_COLUMNS.items()))


def measures(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in MEASURE_COLUMNS.items()))


def street_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in LINE_COLUMNS.items()))


def large_zip_ref(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in LARGE_ZIP_COLUMNS.items()))


def postal_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders")
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in POSTAL_COLUMNS.items()))


def zip_ref(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM ({ZIP_ROWS}) AS t(zip, place, state)")
