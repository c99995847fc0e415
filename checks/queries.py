"""Registered queries: each runs one or more operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.relations import CONTACT_COLUMNS, addresses, contacts, large_zip_ref, measures, postal_codes, street_lines, table, zip_ref
from rowproof.config import AddressConfig, DatasetConfig, load_registry
from rowproof.functions import address as address_text
from rowproof.functions import contact as contact_rules
from rowproof.functions import geo
from rowproof.functions import phone as phone_rules
from rowproof.functions import postal
from rowproof.functions.text import identifier, title_case
from rowproof.lexicon import countries
from rowproof.operators import describe as describing
from rowproof.operators import duplicates, frequency, fuzzy, outliers, profile, statistics
from rowproof.operators.address import OUTPUTS, clean_addresses
from rowproof.operators.columns import spread
from rowproof.operators.project import (
    default_country,
    null_rows,
    report_columns,
    scrub_legacy,
    scrub_table,
    scrub_text_columns,
)
from rowproof.operators.ziplookup import (
    us_city_by_zip,
    us_state_by_zip,
    us_zip_code,
    with_zip_lookup,
    zip_lookup,
    zip_records,
)
from rowproof.plans.runs import fuzzy_run, load_with_metadata, load_with_types, profile_run
from rowproof.plans.validation import validate
from rowproof.sources.sinks import (
    DETAIL_SEPARATOR,
    append_table,
    replace_table,
    truncate_table,
    write_report,
)
from rowproof.sources.staging import staged, staging_folder
from rowproof.sources.tables import (
    read_csv,
    read_query,
    read_query_file,
    run_files,
)
from rowproof.streaming.rows import flag_stream

Query = Callable[[SparkSession, str], DataFrame]

CONTACT_CONFIG = DatasetConfig(
    table="contacts",
    primary_key=("contact_id",),
    reference_fields=("account_id",),
    default_country_field="country",
    duplicates=("email", "first_name"),
    required=("first_name", "email", "phone"),
    phone=("phone",),
    email=("email",),
    url=("url",),
    name=("first_name",),
    z_outliers=("revenue",),
    iqr_outliers=("revenue",),
    exceptions=("url",),
)
ADDRESS_CONFIG = DatasetConfig(
    table="addresses",
    primary_key=("address_id",),
    required=("address1", "city"),
    addresses={
        "main": AddressConfig(
            root="main", address1="address1", address2="address2", city="city", state="state",
            postal_code="postal_code", country="country",
        ),
        # A second group without a country column takes the default country.
        "backup": AddressConfig(
            root="backup", address1="address1", city="city", state="state",
            postal_code="postal_code",
        ),
    },
    exceptions=("backup",),
)
ORDER_TYPES = {
    "o_orderkey": "sa.BigInteger", "o_custkey": "sa.BigInteger", "o_orderstatus": "sa.String(1)",
    "o_totalprice": "sa.Float", "o_orderdate": "sa.DateTime", "o_orderpriority": "sa.String(20)",
}


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round double columns, because engines add doubles in different orders."""
    return df.select(
        *(
            F.round(f.name, special.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def scratch(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid4().hex}"


# ---- frequency, describe, profile, statistics ------------------------------------------------


def freq_all_strings(spark, folder):
    return frequency.frequency(table(spark, folder, "orders"), "['orders']")


def freq_by_column(spark, folder):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_shipdate"]
    return frequency.frequency(table(spark, folder, "lineitem"), "lineitem", columns)


def freq_text(spark, folder):
    return frequency.frequency_text(table(spark, folder, "customer"))


def freq_text_by_column(spark, folder):
    return frequency.frequency_text(table(spark, folder, "part"), ["p_name", "p_size"])


def freq_long_texts(spark, folder):
    """Whole texts, of which only those that are kept are moved."""
    return frequency.frequency(table(spark, folder, "documents"), "documents", ["text", "lang"])


def freq_long_texts_all(spark, folder):
    """Every text of the documents and pages columns, also those that begin alike."""
    pages = table(spark, folder, "pages").selectExpr("html", "concat(repeat('same beginning ', 6), url) AS url")
    return frequency.frequency(pages, "pages", ["html", "url"], keep=None)


def describe_table(spark, folder):
    return report_numbers(describing.describe(table(spark, folder, "part")))


def report_numbers(report: DataFrame) -> DataFrame:
    """The describe report as one row per column and statistic, numbers rounded."""
    number = F.col("categories").isin("mean", "std", "min", "25%", "50%", "75%", "max")
    long = report.unpivot(["categories"], report.columns[1:], "column_name", "value")
    return long.select(
        "categories",
        "column_name",
        F.when(number, F.round(F.col("value").try_cast("double"), 3)).alias("number"),
        F.when(~number, F.col("value")).alias("text"),
    )


def describe_transposed(spark, folder):
    return rounded(describing.describe_columns(table(spark, folder, "orders"), "orders"), 3)


def numeric_stats(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = statistics.numeric_stats(table(spark, folder, "lineitem"), columns)
    return rounded(stats, 4, variance=1)


def numeric_stats_narrowed(spark, folder):
    """The same statistics through the path for tables too large for one task."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = statistics.numeric_stats(
        table(spark, folder, "lineitem"), columns, max_values_in_task=0
    )
    return rounded(stats, 4, variance=1)


def mean_stats(spark, folder):
    return rounded(statistics.mean_stats(table(spark, folder, "orders"), ["o_totalprice"]), 3)


def quartile_stats(spark, folder):
    return rounded(statistics.quartile_stats(table(spark, folder, "customer")), 4)


def date_quartiles(spark, folder):
    return statistics.date_quartile_stats(table(spark, folder, "events"))


def column_profile(spark, folder):
    return rounded(profile.profile_columns(table(spark, folder, "customer")), 4)


def histogram(spark, folder):
    return rounded(
        profile.histogram(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"]), 4
    )


def profile_output(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        output = profile_run(table(spark, folder, "supplier"), "supplier")[name]
        return report_numbers(output) if name == "describe" else rounded(output, 4 if name == "profile" else 3)

    return run


# ---- missing values --------------------------------------------------------------------------


def nan_statistics(spark, folder):
    rows = measures(spark, folder)
    stats = rounded(statistics.numeric_stats(rows, ["few", "many"]), 4, variance=1)
    ends = rounded(statistics.quartile_stats(rows, ["endless"]), 4)
    return stats.unionByName(ends, allowMissingColumns=True)


def nan_outliers(spark, folder):
    rows, columns = measures(spark, folder), ["few", "many", "endless"]
    flags = outliers.z_flags(rows, columns) | outliers.iqr_flags(rows, columns)
    flags["few_outside"] = outliers.bounds_flag(F.col("few"), F.lit(0.0), F.lit(9000.0))
    return rows.select("id").join(rows.withColumns(flags).select("id", *flags), "id")


def nan_profile(spark, folder):
    return rounded(profile.profile_columns(measures(spark, folder).select("few", "many")), 4)


def nan_nulls(spark, folder):
    return null_rows(measures(spark, folder), ["id", "few", "many"])


def nan_verdict(spark, folder):
    config = DatasetConfig(
        table="measures", primary_key=("id",), z_outliers=("few",), iqr_outliers=("many",), required=("few",)
    )
    return validate(measures(spark, folder), config, stage=False)["validation_summary"].select(
        "id", "few_isOutlier", "many_iq_outlier", "row_is_valid"
    )


# ---- outliers --------------------------------------------------------------------------------


def z_outliers(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", "value").withColumns(outliers.z_flags(events, ["value"]))


def z_scores(spark, folder):
    rows = contacts(spark, folder)
    score = outliers.z_scores(rows, ["revenue"])["revenue"]
    return rows.select("contact_id", F.round(score, 5).alias("z_score"))


def iqr_outliers(spark, folder):
    rows = contacts(spark, folder)
    return rows.select("contact_id", "revenue").withColumns(outliers.iqr_flags(rows, ["revenue"]))


def iqr_bounds(spark, folder):
    orders = table(spark, folder, "orders")
    columns = ["o_totalprice", "o_orderkey"]
    bounds = outliers.iqr_bounds(orders, columns)
    per_status = orders.groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("largest"))
    lower, upper = bounds["o_totalprice"]
    return per_status.select(
        "o_orderstatus", "largest", F.round(lower, 4).alias("lower"), F.round(upper, 4).alias("upper")
    )


def bounds_outliers(spark, folder):
    line = table(spark, folder, "lineitem")
    flag = outliers.bounds_flag(F.col("l_extendedprice"), F.lit(5000.0), F.lit(100000.0))
    return line.select("l_orderkey", "l_linenumber", "l_extendedprice", flag.alias("is_outlier"))


def date_iqr_outliers(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", "o_orderdate").withColumns(
        outliers.date_flags(orders, ["o_orderdate"])
    )


# ---- duplicates, nulls, projections ----------------------------------------------------------


def exact_duplicates(spark, folder):
    part = table(spark, folder, "part")
    return duplicates.exact_duplicates(part, ["p_name", "p_retailprice"], "p_partkey", "part")


def duplicate_texts(spark, folder):
    documents = table(spark, folder, "documents")
    return duplicates.exact_duplicates(documents, ["text"], "doc_id", "documents")


def duplicates_one_column(spark, folder):
    return duplicates.duplicates_by_column(contacts(spark, folder), "email", "contact_id")


def distinct_values(spark, folder):
    return duplicates.distinct_values(contacts(spark, folder), "first_name")


def null_required(spark, folder):
    documents, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    joined = documents.join(labels, "doc_id", "left")
    return null_rows(joined, ["doc_id", "lang", "quality", "toxic"])


def null_any_column(spark, folder):
    return null_rows(contacts(spark, folder))


def report_projection(spark, folder):
    rows = contacts(spark, folder)
    country = default_country(rows, "no_such_column", "US").alias("DCountry")
    return report_columns(
        rows.select("*", country), ["contact_id", "account_id"], ["email", "missing"], ["DCountry"]
    )


def identifiers(spark, folder):
    nation = table(spark, folder, "nation")
    listed = F.concat(F.lit(" ['"), F.col("n_name"), F.lit("'] "))
    return nation.select("n_nationkey", identifier(listed).alias("name"))


# ---- scrubbing -------------------------------------------------------------------------------


def scrub_file(spark, folder):
    return scrub_table(table(spark, folder, "documents"))


def scrub_text(spark, folder):
    turns = table(spark, folder, "conversations")
    blank = F.when(F.col("turn") == 0, F.lit("")).when(F.col("turn") == 1, F.lit("  "))
    return scrub_text_columns(turns.withColumn("note", F.coalesce(blank, "text")), ["note"])


def scrub_old(spark, folder):
    rows = contacts(spark, folder).withColumn(
        "revenue", F.when(F.col("country") == "CA", F.lit(float("inf"))).otherwise(F.col("revenue"))
    )
    blank = F.when(F.col("country") == "US", F.lit(" \t ")).otherwise(F.col("first_name"))
    return scrub_legacy(rows.withColumn("first_name", blank))


# ---- geography -------------------------------------------------------------------------------


def country_rules(spark, folder):
    rows = addresses(spark, folder)
    return rows.select(
        "address_id",
        geo.country_check("country").alias("is_code"),
        geo.country_format("country").alias("code"),
        geo.country_format(F.lower("country")).alias("code_of_lower"),
    )


def country_names(spark, folder):
    """Every country name, spread over the customers, back to its code."""
    names = F.array(*(F.lit(n) for n in countries().values()))
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.get(names, (F.col("c_custkey") % len(countries())).cast("int")).alias("country"),
    )
    return rows.select("c_custkey", "country", geo.country_format(F.lower("country")).alias("code"))


def state_rules(spark, folder):
    rows = addresses(spark, folder)
    code = geo.country_format("country")
    return rows.select(
        "address_id",
        geo.state_check("state", code).alias("state_ok"),
        geo.state_name_to_code("state", code).alias("code"),
        geo.state_name_to_code(F.upper("state"), code).alias("code_of_upper"),
        geo.country_by_state("state").alias("country_of_state"),
    )


def city_rules(spark, folder):
    rows = contacts(spark, folder)
    return rows.select("contact_id", geo.city_check("first_name").alias("city_ok"))


def title_texts(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", title_case("text").alias("title"))


def title_names(spark, folder):
    return contacts(spark, folder).select(
        "contact_id",
        title_case("first_name").alias("first_title"),
        title_case("last_name").alias("last_title"),
    )


# ---- postal codes ----------------------------------------------------------------------------


def zip_rules(spark, folder):
    rows = with_zip_lookup(addresses(spark, folder), "postal_code", zip_ref(spark))
    code = geo.country_format("country")
    hit = us_zip_code("zip_hit")
    return rows.select(
        "address_id",
        hit.alias("is_us_zip"),
        us_state_by_zip("zip_hit").alias("zip_state"),
        us_city_by_zip("zip_hit").alias("zip_city"),
        F.col("zip_hit.zip").alias("record_zip"),
        F.col("zip_hit.place").alias("record_place"),
        F.col("zip_hit.state").alias("record_state"),
        postal.zip_code_regex("postal_code", code).alias("fits"),
        postal.zip_code_check("postal_code", code, hit).alias("zip_ok"),
        postal.zip_format("postal_code", code, hit).alias("zip_text"),
    )


def zip_large_reference(spark, folder):
    """Lookups in a reference of thousands of ZIPs; one code is in a quarter of the rows."""
    records = zip_records(large_zip_ref(spark, folder))
    rows = with_zip_lookup(postal_codes(spark, folder), "postal_code", records)
    return rows.select(
        "o_orderkey", us_zip_code("zip_hit").alias("known"), us_city_by_zip("zip_hit").alias("place"),
        us_state_by_zip("zip_hit").alias("state"),
    )


def zip_patterns(spark, folder):
    """Nine countries' patterns over codes made from the keys."""
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'AU' WHEN 2 THEN 'BR' WHEN 3 THEN 'DE'
           WHEN 4 THEN 'CA' WHEN 5 THEN 'FR' WHEN 6 THEN 'JP' WHEN 7 THEN 'GB' WHEN 8 THEN 'IN'
           ELSE 'ZZ' END AS country""",
        """CASE o_custkey % 7 WHEN 0 THEN CAST(10000 + o_custkey AS STRING)
           WHEN 1 THEN CAST(10000 + o_custkey AS STRING) || '-1234' WHEN 2 THEN 'K1A 0B1'
           WHEN 3 THEN '123-4567' WHEN 4 THEN 'SW1A 1AA' WHEN 5 THEN '560 001'
           ELSE '01310100' END AS code""",
    )
    return rows.select(
        "o_orderkey", "country", "code", postal.zip_code_regex("code", "country").alias("fits")
    )


def zip_reverse(spark, folder):
    rows = addresses(spark, folder).select("address_id", "city", "state")
    return zip_lookup(rows, "city", "state", zip_ref(spark)).select(
        "address_id", F.array_join("zips", ",").alias("zips")
    )


# ---- phone, e-mail, web, names ---------------------------------------------------------------


def phone_rules_contacts(spark, folder):
    rows = contacts(spark, folder)
    code = geo.country_format("country")
    return rows.select(
        "contact_id",
        phone_rules.clean_phone_us("phone", code).alias("clean"),
        phone_rules.format_phone("phone", code).alias("formatted"),
        phone_rules.extension("phone", code).alias("ext"),
        phone_rules.phone_is_valid("phone", code).alias("is_valid"),
    )


def phone_validate(spark, folder):
    result = phone_rules.phone_cleaning("phone", "country")
    return contacts(spark, folder).select("contact_id", "phone", "country", result.alias("p")).select(
        "contact_id", "phone", "country", "p.*"
    )


def phone_in_documents(spark, folder):
    found = F.regexp_extract_all("text", F.lit(r"\(\d{3}\) \d{3}-\d{4}"), F.lit(0))
    documents = table(spark, folder, "documents").select("doc_id", F.explode(found).alias("phone"))
    result = phone_rules.phone_cleaning("phone", F.lit("US"))
    return documents.select("doc_id", "phone", result.alias("p")).select("doc_id", "phone", "p.*")


def email_rules(spark, folder):
    return contacts(spark, folder).select(
        "contact_id",
        contact_rules.email_check("email").alias("email_ok"),
        contact_rules.email_valid("email").alias("normalized"),
    )


def email_in_documents(spark, folder):
    found = F.regexp_extract_all("text", F.lit(r"\S+@\S+"), F.lit(0))
    documents = table(spark, folder, "documents").select("doc_id", F.explode(found).alias("email"))
    return documents.select(
        "doc_id",
        "email",
        contact_rules.email_check("email").alias("email_ok"),
        contact_rules.email_valid("email").alias("normalized"),
    )


def url_rules(spark, folder):
    pages = table(spark, folder, "pages")
    variants = {
        "as_given": F.col("url"),
        "no_scheme": F.regexp_replace("url", r"^https?://", ""),
        "one_slash": F.replace(F.col("url"), F.lit("//"), F.lit("/")),
        "mail": F.concat(F.lit("mailto:"), F.col("url")),
        "led_by_blank": F.concat(F.lit(" "), F.col("url")),
        "no_host": F.concat(F.lit("http:///"), F.col("url")),
        "open_bracket": F.replace(F.col("url"), F.lit("://"), F.lit("://[")),
        "nothing": F.lit(None).cast("string"),
    }
    return pages.select(
        "page_id", *(contact_rules.website_check(v).alias(n) for n, v in variants.items())
    )


def name_rules(spark, folder):
    return contacts(spark, folder).select(
        "contact_id",
        contact_rules.name_check("first_name").alias("name_ok"),
        contact_rules.name_format("first_name").alias("formatted"),
        contact_rules.name_format("last_name").alias("last_formatted"),
    )


# ---- addresses -------------------------------------------------------------------------------

ADDRESS_PARTS = {
    "address1": "address1", "address2": "address2", "city": "city", "state": "state",
    "postal_code": "postal_code", "country": "country",
}


def assembled(rows: DataFrame) -> DataFrame:
    text = address_text.assemble_address(
        "address1", "address2", F.lit(None).cast("string"), "city", "state", "postal_code", "country"
    )
    return rows.select("*", text.alias("full_text"), geo.country_format("country").alias("code"))


def address_assemble(spark, folder):
    return assembled(addresses(spark, folder)).select("address_id", "full_text")


def address_parse(spark, folder):
    rows = assembled(spread(addresses(spark, folder)))
    parsed = address_text.parse_address("full_text", "code").alias("p")
    return rows.select("address_id", parsed).select("address_id", "p.*")


def address_between(spark, folder):
    documents = table(spark, folder, "documents")
    found = address_text.address_between("text", F.lit("the"), "lang")
    return documents.select("doc_id", found.alias("between"))


def address_messages(spark, folder):
    cleaned = clean_addresses(addresses(spark, folder), "a", zip_ref(spark), **ADDRESS_PARTS)
    return cleaned.select(
        "address_id",
        "a_addr_is_valid",
        F.array_join("a_addr_error_messg", ",").alias("messages"),
        "a_street",
        "a_suite",
        "a_city",
        "a_state",
        "a_postal_code",
        "a_country",
    )


def address_key(spark, folder):
    cleaned = clean_addresses(addresses(spark, folder), "a", zip_ref(spark), **ADDRESS_PARTS)
    return cleaned.select("address_id", "a_full_address")


def address_duplicates(spark, folder):
    reports = validate(addresses(spark, folder), ADDRESS_CONFIG, zip_ref(spark), stage=False)
    return reports["duplicate_addresses"]


def address_summary(spark, folder):
    reports = validate(addresses(spark, folder), ADDRESS_CONFIG, zip_ref(spark), stage=False)
    outputs = [f"{root}_{name}" for root in ("main", "backup") for name in OUTPUTS]
    return reports["validation_summary"].select(
        "address_id",
        *(F.array_join(c, ",").alias(c) if c.endswith("_messg") else F.col(c) for c in outputs),
        "row_is_valid",
    )


def address_street_types(spark, folder):
    """Every street type, with directions and units, parsed out of one line."""
    rows = spread(street_lines(spark, folder))
    parsed = address_text.parse_address("line", F.lit("US")).alias("p")
    return rows.select("line_id", parsed).select("line_id", "p.*")


def address_frequency(spark, folder):
    reports = validate(addresses(spark, folder), ADDRESS_CONFIG, zip_ref(spark))
    return reports["check_frequency"]


# ---- validation run --------------------------------------------------------------------------


def contact_report(name: str, stage: bool = False) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return validate(contacts(spark, folder), CONTACT_CONFIG, stage=stage)[name]

    return run


def validation_summary(spark, folder):
    return contact_report("validation_summary")(spark, folder)


def stream_verdict(spark, folder):
    """The row rules on a stream of the contacts, written by a file sink and read back."""
    schema = table(spark, folder, "customer").schema
    source = spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/customer.parquet*")
    stream = source.selectExpr(*(f"{text} AS {name}" for name, text in CONTACT_COLUMNS.items()))
    flagged = flag_stream(stream, CONTACT_CONFIG)
    target = scratch(spark, "stream")
    query = (
        flagged.writeStream.format("parquet")
        .option("path", f"{target}/rows")
        .option("checkpointLocation", f"{target}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(flagged.schema).parquet(f"{target}/rows")


# ---- fuzzy matching --------------------------------------------------------------------------


def fuzzy_matches(spark, folder):
    return fuzzy.fuzzy_matches(table(spark, folder, "part"), "p_name")


def fuzzy_low_threshold(spark, folder):
    return fuzzy.fuzzy_matches(table(spark, folder, "part"), "p_name", threshold=70)


def fuzzy_suppliers_60(spark, folder):
    """Numbered names, nearly all alike."""
    return fuzzy.fuzzy_matches(table(spark, folder, "supplier"), "s_name", threshold=60)


def fuzzy_suppliers_85(spark, folder):
    return fuzzy.fuzzy_matches(table(spark, folder, "supplier"), "s_name")


def fuzzy_suppliers_95(spark, folder):
    return fuzzy.fuzzy_matches(table(spark, folder, "supplier"), "s_name", threshold=95)


def fuzzy_suppliers_all(spark, folder):
    """Every match that reaches the threshold, not only the best."""
    return fuzzy.fuzzy_matches(table(spark, folder, "supplier"), "s_name", threshold=94, keep=None)


def fuzzy_compare(spark, folder):
    config = DatasetConfig(table="part", primary_key=("p_partkey",), duplicates=("p_name",))
    return fuzzy_run(table(spark, folder, "part"), config)


def fuzzy_multi(spark, folder):
    return fuzzy.multi_fuzzy_matches(table(spark, folder, "part"), ["p_name", "p_type"], 60)


# ---- sources and sinks -----------------------------------------------------------------------


def csv_scan(spark, folder):
    """Documents through a delimited file: quotes, line breaks and null tokens."""
    documents = table(spark, folder, "documents").selectExpr(
        "doc_id",
        "text",
        """CASE doc_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '<NA>'
           WHEN 4 THEN 'na' ELSE lang END AS label""",
        "CASE doc_id % 3 WHEN 0 THEN 'NA' ELSE lang END AS country",
        """CASE doc_id % 5 WHEN 0 THEN 'NaN' WHEN 1 THEN 'many' ELSE CAST(n_chars AS STRING) END
           AS amount""",
    )
    path = scratch(spark, "csv")
    write_report(documents, path)
    scanned = read_csv(spark, path, numeric=["amount"], country_columns=["country"])
    return scanned.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def query_scan(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("scan_customer")
    table(spark, folder, "nation").createOrReplaceTempView("scan_nation")
    return read_query(
        spark,
        """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
           FROM scan_customer JOIN scan_nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    )


def query_file_scan(spark, folder):
    table(spark, folder, "supplier").createOrReplaceTempView("scan_supplier")
    path = scratch(spark, "sql")
    text = "SELECT s_suppkey, s_name FROM scan_supplier WHERE s_acctbal < 0;"
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
    return read_query_file(spark, path)


def table_sinks(spark, folder):
    """Replace with declared types, append, and read all back; another table is emptied again."""
    orders = table(spark, folder, "orders")
    name = f"sink_{uuid4().hex}"
    texts = orders.select(*(F.col(c).cast("string").alias(c) for c in orders.columns))
    replace_table(texts, [name], types=ORDER_TYPES)
    append_table(spark.table(name), name)
    emptied = f"{name}_emptied"
    replace_table(orders, emptied)
    truncate_table(spark, emptied)
    kept = spark.table(name).unionByName(spark.table(emptied), allowMissingColumns=True)
    return read_and_dropped(kept, name, emptied)


def read_and_dropped(rows: DataFrame, *tables: str) -> DataFrame:
    """The rows, kept in a staged table, after their catalog tables are dropped."""
    kept = staged(rows)
    for name in tables:
        rows.sparkSession.sql(f"DROP TABLE {name}")
    return kept


def report_sink(spark, folder):
    path = scratch(spark, "report")
    columns = ["contact_id", "first_name", "email", "phone"]
    write_report(contacts(spark, folder).select(*columns), path, DETAIL_SEPARATOR)
    back = read_csv(spark, path, sep=DETAIL_SEPARATOR)
    return back.withColumn("contact_id", F.col("contact_id").cast("bigint"))


def _order_metadata(spark: SparkSession) -> DataFrame:
    kinds = {"sa.String(1)": "char", "sa.String(20)": "varchar", "sa.Float": "float",
             "sa.DateTime": "datetime", "sa.BigInteger": "bigint"}
    rows = [("orders", c, kinds[t], t) for c, t in ORDER_TYPES.items()]
    rows.append(("lineitem", "l_comment", "nvarchar", "sa.String(44)"))
    return spark.createDataFrame(
        rows, "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, SA_COLUMN_FORMAT1 string"
    )


def _padded_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    texts = orders.select(*(F.col(c).cast("string").alias(c) for c in orders.columns))
    return texts.withColumns(
        {
            "o_orderstatus": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(""),
            "o_orderpriority": F.concat(F.lit(" \t"), F.col("o_orderpriority"), F.lit("é\n")),
        }
    )


def typed_load(spark, folder):
    name = f"load_{uuid4().hex}"
    load_with_metadata(_padded_orders(spark, folder), _order_metadata(spark), "orders", name)
    return read_and_dropped(spark.table(name), name)


def static_type_load(spark, folder):
    name = f"load_{uuid4().hex}"
    load_with_types(_padded_orders(spark, folder), ORDER_TYPES, name)
    return read_and_dropped(spark.table(name), name)


def batch_run(spark, folder):
    """A registry, files and a job: contacts validated file by file, unusable files passed over."""
    base = scratch(spark, "batch")
    good, bad = f"{base}/contacts.csv", f"{base}/other.csv"
    write_report(contacts(spark, folder), good)
    registry = {"contacts": CONTACT_CONFIG}

    def job(df: DataFrame, config: DatasetConfig, name: str) -> None:
        validate(df, config, stage=False)["validation_summary"].select(
            F.col("contact_id").cast("bigint"), "row_is_valid", F.lit(name).alias("dataset")
        ).write.parquet(f"{base}/out/{name}")

    status = run_files(spark, [good, bad, f"{base}/notes.txt"], registry, job)
    rows = spark.read.parquet(f"{base}/out/contacts")
    return status.drop("path").join(rows, "dataset", "left")


REGISTRY_JSON = """{
    "Contacts": {
        "db_table": ["contacts"], "db_primary_key": ["contact_id"], "reference_fields": ["account_id"],
        "default_country_field": ["country"], "duplicates": ["email", "first_name"],
        "isNull": ["first_name", "email", "phone"], "phone": ["phone"], "email": ["email"], "url": ["url"],
        "name": ["first_name"], "z_num_outliers": ["revenue"], "iq_num_outliers": ["revenue"],
        "exception_from_row_validation": ["url"]
    },
    "Supplier_Master": {
        "db_table": ["suppliers"], "db_primary_key": ["s_suppkey"], "isNull": [null],
        "iq_num_outliers": ["s_acctbal"], "address": {"hasAddress": false}
    },
    "no_key": {"db_table": ["none"], "db_primary_key": [null]}
}"""
SOURCE_NAMES = {"CRM_Contact_Export": "contacts", "gp_vendors.csv": "SupplierMaster", "Orphan": "missing"}


def registry_run(spark, folder):
    """A JSON registry and a map from source names to datasets; four files at a time, unusable ones passed over."""
    base = scratch(spark, "registry")
    write_report(contacts(spark, folder), f"{base}/crm_contact_export.csv")
    write_report(table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"), f"{base}/GPVendors.csv")

    def job(df: DataFrame, config: DatasetConfig, name: str) -> None:
        validate(df, config, stage=False)["validation_summary"].select(
            F.col(config.key).cast("bigint").alias("key"), "row_is_valid", F.lit(name).alias("dataset")
        ).write.parquet(f"{base}/out/{config.table}")

    files = [f"{base}/{name}.csv" for name in ("crm_contact_export", "GPVendors", "orphan", "NoKey")]
    status = run_files(spark, files, load_registry(REGISTRY_JSON), job, names=SOURCE_NAMES)
    rows = spark.read.parquet(f"{base}/out/contacts", f"{base}/out/suppliers")
    return status.drop("path").join(rows, "dataset", "left")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        freq_all_strings, freq_by_column, freq_text, freq_text_by_column, freq_long_texts, freq_long_texts_all, describe_table,
        describe_transposed, numeric_stats, numeric_stats_narrowed, mean_stats, quartile_stats,
        date_quartiles, column_profile, histogram, nan_statistics, nan_outliers, nan_profile, nan_nulls,
        nan_verdict, z_outliers, z_scores,
        iqr_outliers, iqr_bounds, bounds_outliers, date_iqr_outliers, exact_duplicates,
        duplicate_texts, duplicates_one_column, distinct_values, null_required, null_any_column,
        report_projection, identifiers, scrub_file, scrub_text, scrub_old, country_rules,
        country_names, state_rules, city_rules, title_texts, title_names, zip_rules, zip_large_reference, zip_patterns,
        zip_reverse, phone_rules_contacts, phone_validate, phone_in_documents, email_rules,
        email_in_documents, url_rules, name_rules, address_assemble, address_parse,
        address_between, address_messages, address_key, address_duplicates, address_summary,
        address_frequency, address_street_types, validation_summary, stream_verdict, fuzzy_matches,
        fuzzy_low_threshold, fuzzy_suppliers_60, fuzzy_suppliers_85, fuzzy_suppliers_95, fuzzy_suppliers_all, fuzzy_compare, fuzzy_multi, csv_scan, query_scan, query_file_scan,
        table_sinks, report_sink, typed_load, static_type_load, batch_run, registry_run,
    )
}
QUERIES |= {
    **{
        f"profile_run_{label}": profile_output(name)
        for label, name in {
            "describe": "describe_transposed", "report": "describe", "frequency": "frequency",
            "frequency_text": "frequency_text", "profile": "profile",
        }.items()
    },
    "contact_phone_detail": contact_report("phone"),
    "contact_email_detail": contact_report("email"),
    "contact_url_detail": contact_report("url"),
    "contact_name_detail": contact_report("name"),
    "contact_z_detail": contact_report("z_outliers"),
    "contact_iqr_detail": contact_report("iqr_outliers"),
    "contact_duplicates": contact_report("exact_duplicates"),
    "contact_duplicates_email": contact_report("duplicates_email"),
    "contact_phone_frequency": contact_report("phone_frequency"),
    "contact_email_frequency": contact_report("email_frequency"),
    "contact_iqr_outliers_frequency": contact_report("iqr_outliers_frequency"),
    "contact_nulls": contact_report("null_required_fields"),
    "check_frequency": contact_report("check_frequency", stage=True),
    "row_frequency": contact_report("row_frequency", stage=True),
    "column_frequency": contact_report("column_frequency", stage=True),
}
