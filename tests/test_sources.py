"""Files, metadata, types, sinks and configuration."""

import json
import threading

import pytest
from pyspark.sql import types as T

from rowproof.config import DatasetConfig, load_registry, resolve_config
from rowproof.plans.runs import fuzzy_run, load_with_metadata, load_with_types, profile_run
from rowproof.plans.validation import validate, write_reports
from rowproof.operators import columns
from rowproof.sources import sinks, tables

RAW = {
    "db_schema": ["replica"], "db_table": ["People"], "db_primary_key": ["id"], "reference_fields": ["org"],
    "default_country_field": [None], "default_country_code": ["US"], "duplicates": ["email"],
    "isNull": ["email", "gone"], "address": {"hasAddress": False, "addresses": {}}, "phone": ["phone", "gone"],
    "email": ["email"], "url": [None], "name": ["name"], "z_num_outliers": ["pay"],
    "iq_num_outliers": ["pay"], "date_outliers": ["since"],
}
CSV = """id,org,name,email,phone,pay,since,land
1,x,Ann,a@b.com,(978) 877-3200,10,2020-01-01,NA
2,x,"Bo ""B"" O",a@b.com,978-877-3201,NaN,2020-01-02,NA
3,,"two
lines",N/A,null,12x,2020-01-03,US
"""


@pytest.fixture
def people(tmp_path):
    path = tmp_path / "people_.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_config():
    registry = load_registry(json.dumps({"Peo_ple": RAW, "keyless": RAW | {"db_primary_key": [None]}}))
    config = resolve_config("/data/PEOPLE_.csv", registry)
    assert config.key == "id" and config.base_fields == ["id", "org"] and config.url == ()
    assert config.exceptions == () and config.numeric_columns == ["pay"] and config.schema == "replica"
    assert resolve_config("other", registry) is None
    assert not registry["keyless"].has_key
    with pytest.raises(ValueError):
        registry["keyless"].key


def test_address_config():
    group = {"address_root_name": "main", "full_address": None, "address1": "a", "address2": None, "address3": None,
             "city": "c", "state": "s", "postal_code": "z", "country": "land"}
    raw = RAW | {"address": {"hasAddress": True, "addresses": {"k": group}}}
    config = DatasetConfig.from_dict(raw)
    assert config.addresses["k"].root == "main" and config.country_columns == ["land"]


def test_read_csv(spark, people):
    df = tables.read_csv(spark, people, numeric=["pay"], dates=["since"], country_columns=["land"])
    rows = df.collect()
    assert rows[0].land == "NA" and rows[1].name == 'Bo "B" O' and rows[2].name == "two\nlines"
    assert [r.pay for r in rows] == [10.0, None, None]
    assert (rows[2].org, rows[2].email, rows[2].phone) == (None, None, None)
    assert rows[0].since.day == 1 and rows[0].id == "1"


def test_null_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("v,w\n" + "".join(f'"{t}",x\n' for t in tables.NULL_TOKENS) + "na,x\n NA,x\n")
    values = [r.v for r in tables.read_csv(spark, str(path)).collect()]
    assert len(tables.NULL_TOKENS) == 19 and values == [None] * 19 + ["na", " NA"]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "n double, s string")
    assert [r.n for r in columns.nan_to_null(df).collect()] == [None, 1.0]


def test_run_files(spark, people, tmp_path):
    registry = {"people": DatasetConfig.from_dict(RAW), "keyless": DatasetConfig(table="k", primary_key=())}
    seen = []
    paths = [people, f"{tmp_path}/nothing/people.csv", "x.txt", "unknown.csv", "keyless.csv"]
    status = tables.run_files(
        spark, paths, registry, lambda df, config, name: seen.append((config.table, df.count()))
    )
    assert [r.status for r in status.collect()] == ["done", "failed", "skipped", "skipped", "skipped"]
    assert seen == [("People", 3)]


def test_types():
    types = {"id": "sa.BigInteger", "name": "sa.String(256)", "ok": "sa.Boolean"}
    resolved = tables.resolve_types(types, ["id", "name"])
    assert resolved == {"id": T.LongType(), "name": T.VarcharType(256)}
    assert tables.text_columns_of_types(types) == ["name"]
    assert sinks.column_types(resolved) == "`id` BIGINT, `name` VARCHAR(256)"
    with pytest.raises(KeyError):
        tables.resolve_types(types, ["gone"])
    with pytest.raises(ValueError):
        tables.resolve_types({"id": "os.system"}, ["id"])


def test_loads(spark):
    df = spark.createDataFrame([("1", " a\t", ""), ("x", "é", "no")], "id string, name string, ok string")
    types = {"id": "sa.BigInteger", "name": "sa.String(256)", "ok": "sa.Boolean"}
    load_with_types(df, types, ["loaded_types"])
    assert sorted(map(tuple, spark.table("loaded_types").collect()), key=str) == [
        (1, "a", None), (None, None, False)]
    metadata = spark.createDataFrame(
        [("t", "id", "bigint", "sa.BigInteger"), ("t", "name", "nvarchar", "sa.String(9)"),
         ("t", "ok", "bit", "sa.Boolean"), ("u", "x", "char", "sa.String(1)")],
        "TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, SA_COLUMN_FORMAT1 string")
    load_with_metadata(df, metadata, "t", "loaded_metadata")
    sinks.append_table(spark.table("loaded_metadata"), "loaded_metadata")
    assert spark.table("loaded_metadata").count() == 4
    sinks.truncate_table(spark, "loaded_metadata")
    assert spark.table("loaded_metadata").count() == 0
    assert tables.schema_text_columns(df) == ["id", "name", "ok"]


def test_validation_of_a_file(spark, people, tmp_path):
    config = DatasetConfig.from_dict(RAW)
    reports = validate(tables.read_dataset(spark, people, config), config)
    summary = {r.id: r for r in reports["validation_summary"].collect()}
    assert summary["1"].row_is_valid and not summary["2"].row_is_valid and not summary["3"].row_is_valid
    assert summary["2"].phone_formatted == "(978) 877-3201" and summary["1"].DCountry == "US"
    assert summary["2"].name_check is False and summary["3"].name_check is False
    assert {r.table_primary_key for r in reports["exact_duplicates"].collect()} == {"1", "2"}
    assert [r.id for r in reports["null_required_fields"].collect()] == ["3"]
    assert reports["null_required_fields"].columns == ["id", "org", "email"]
    assert reports["phone"].columns == [
        "id", "org", "row_is_valid", "phone", "DCountry", "phone_is_valid", "phone_formatted", "phone_ext_formatted"]
    assert "since_date_outlier" in reports["date_outliers"].columns
    assert {r.table_values: r.value_counts for r in reports["row_frequency"].collect()} == {"true": 1, "false": 2}
    folder = str(tmp_path / "out")
    write_reports(reports, folder, "people")
    back = tables.read_csv(spark, f"{folder}/email_people", sep="|")
    assert back.count() == 3 and "email_normalized" in back.columns


def test_exceptions_are_left_out_of_the_verdict(spark, people):
    config = DatasetConfig.from_dict(RAW | {"exception_from_row_validation": ["name", "phone", "email"]})
    reports = validate(tables.read_dataset(spark, people, config), config, stage=False)
    assert all(r.row_is_valid for r in reports["validation_summary"].collect())


def test_no_rules(spark):
    df = spark.range(3)
    reports = validate(df, DatasetConfig(table="t", primary_key=("id",)), stage=False)
    assert set(reports) == {"validation_summary", "row_frequency", "column_frequency"}
    assert reports["row_frequency"].first().table_values == "true"


def test_runs(spark):
    df = spark.createDataFrame([("1", "acme corp"), ("2", "acme corp."), ("3", "zzz")], "id string, name string")
    assert set(profile_run(df, "t")) == {
        "describe", "describe_transposed", "frequency", "frequency_text", "profile"}
    config = DatasetConfig(table="t", primary_key=("id",), duplicates=("name",))
    [row] = fuzzy_run(df, config).collect()
    assert (row.value, row.token_sort_ratio, row.table_column) == ("acme corp.", "acme corp: 100", "name")
    assert fuzzy_run(df, DatasetConfig(table="t", primary_key=(), duplicates=("name",))) is None


def test_query_sources(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("five")
    path = tmp_path / "q.sql"
    path.write_text("SELECT count(*) AS n\nFROM five;\n")
    assert tables.read_query_file(spark, str(path)).first().n == 5


def test_staged_tables_go_when_their_run_ends(spark):
    from rowproof.sources.staging import staged, staging_run

    outside = staged(spark.range(3).toDF("x"))
    with staging_run(spark):
        inside = staged(spark.range(5).toDF("x"))
        path = inside.inputFiles()[0]
        assert inside.count() == 5
    assert outside.count() == 3
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def test_database_reads_can_be_divided():
    split = tables.Split("id", "0", "1000", 8)
    options = tables.jdbc_read_options("SELECT * FROM t", {"url": "jdbc:x"}, split)
    assert options["dbtable"] == "(SELECT * FROM t) AS rows_to_read" and "query" not in options
    assert (options["partitionColumn"], options["numPartitions"], options["fetchsize"]) == ("id", "8", "10000")
    assert tables.jdbc_read_options("q", {"url": "u"}) == {"url": "u", "query": "q"}


def test_declared_lengths_are_kept_and_guarded(spark):
    name = "declared_lengths"
    types = {"a": "sa.String(2)", "b": "sa.Integer"}
    sinks.replace_table(spark.createDataFrame([("ab", "1")], "a string, b string"), name, types=types)
    kinds = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert kinds == {"a": "varchar(2)", "b": "int"}
    with pytest.raises(Exception, match="(?i)length"):
        sinks.replace_table(spark.createDataFrame([("abcdef", "1")], "a string, b string"), name, types=types)
    assert [tuple(r) for r in spark.table(name).collect()] == [("ab", 1)]
    spark.sql(f"DROP TABLE {name}")


def test_a_failing_job_does_not_stop_the_other_files(spark, tmp_path):
    for name in ("bad", "good"):
        (tmp_path / f"{name}.csv").write_text("id\n1\n")
    config = DatasetConfig(table="t", primary_key=("id",))

    def job(df, config, name):
        if name == "bad":
            raise KeyError("gone")

    paths = [f"{tmp_path}/{n}.csv" for n in ("bad", "good")]
    rows = tables.run_files(spark, paths, {"bad": config, "good": config}, job).collect()
    assert [(r.dataset, r.status) for r in rows] == [("bad", "failed"), ("good", "done")]


def test_a_slow_file_does_not_hold_up_the_others(spark, tmp_path):
    """The first file's job waits until all others are done; statuses come in the order of the files."""
    names = ["slow", "b", "c", "d", "e"]
    for name in names:
        (tmp_path / f"{name}.csv").write_text("id,v\n1,a\n")
    registry = {n: DatasetConfig(table=n, primary_key=("id",)) for n in names}
    others, lock, counted = threading.Event(), threading.Lock(), []

    def job(df, config, name):
        if name == "slow":
            assert others.wait(60)
        rows = df.count()
        with lock:
            counted.append((name, rows, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
            if len(counted) == 4:
                others.set()
        if name == "d":
            raise ValueError("no good")

    paths = [str(tmp_path / f"{n}.csv") for n in names]
    status = tables.run_files(spark, paths, registry, job, at_once=2).collect()
    assert [(r.dataset, r.status) for r in status] == [(n, "failed" if n == "d" else "done") for n in names]
    assert sorted(counted) == sorted((n, 1, n) for n in names) and counted[-1][0] == "slow"


def test_names_of_sources():
    registry = {"Contacts": DatasetConfig(table="contacts", primary_key=("id",)), "own": DatasetConfig(table="own", primary_key=("id",))}
    names = {"CRM_Export": "contacts", "gone": "nowhere"}
    found = [resolve_config(n, registry, names) for n in ("crmexport.csv", "/in/CRM_EXPORT.CSV", "own", "gone", "contacts", "other")]
    assert [c and c.table for c in found] == ["contacts", "contacts", "own", None, "contacts", None]
