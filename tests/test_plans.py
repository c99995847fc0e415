"""Plans that must hold at any size."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from rowproof.config import AddressConfig, DatasetConfig
from rowproof.operators.address import clean_addresses
from rowproof.operators.duplicates import exact_duplicates
from rowproof.plans.validation import flag_rows

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - {"stream_verdict"}))
def test_no_python_and_no_global_window(spark, name):
    plan = plan_of(Q.QUERIES[name](spark, FOLDER))
    assert "EvalPython" not in plan and "InPandas" not in plan
    for line in plan.splitlines():
        if " Window [" in line:
            assert "], [" in line.split("AS __rank")[-1], line
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_row_rules_do_not_shuffle_the_rows(spark):
    plan = plan_of(Q.validation_summary(spark, FOLDER))
    rows = [line for line in plan.splitlines() if "Exchange" in line]
    assert rows and all("SinglePartition" in line for line in rows)


def test_filters_and_columns_reach_the_scan(spark):
    part = Q.table(spark, FOLDER, "part")
    plan = plan_of(exact_duplicates(part, ["p_name"], "p_partkey", "part"))
    assert "IsNotNull(p_name)" in plan and "p_brand" not in plan and "p_retailprice" not in plan


def test_fuzzy_ranks_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(Q.fuzzy_matches(spark, FOLDER))


def test_statistics_read_one_column(spark):
    orders = Q.table(spark, FOLDER, "orders")
    flags = Q.outliers.z_flags(orders, ["o_totalprice"])
    plan = plan_of(orders.select("o_orderkey", *(v.alias(k) for k, v in flags.items())))
    assert "o_orderpriority" not in plan
    assert plan.count("Exchange SinglePartition") <= 2


def test_costly_address_rows_are_dealt_to_tasks(spark, tmp_path):
    """One file of one row group is one read task; its addresses are parsed in several."""
    rows = spark.range(25_000).selectExpr(
        "id", "(20 + id % 40) || ' Main St' AS a", "'Miami' AS c", "'FL' AS s", "'33101' AS z"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "rows"))
    read = spark.read.parquet(str(tmp_path / "rows"))
    zips = spark.createDataFrame([("33101", "Miami", "FL")], "zip string, place string, state string")
    group = AddressConfig(root="m", address1="a", city="c", state="s", postal_code="z")
    config = DatasetConfig(table="t", primary_key=("id",), addresses={"m": group, "n": replace(group, root="n")})
    flagged, _ = flag_rows(read, config, zips)
    one = clean_addresses(read, "m", zips, address1="a", city="c", state="s", postal_code="z")
    for out in (flagged, one):
        counts = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(counts) == 3 and sum(r["count"] for r in counts) == 25_000
        assert out.select("id").distinct().count() == 25_000
