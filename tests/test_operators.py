"""Edge tables: nulls, ties, zero spread, one row, no rows, hot values."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowproof.operators import describe, duplicates, frequency, outliers, profile, quantiles, statistics
from rowproof.operators.project import null_rows, scrub_legacy, scrub_table, scrub_text_columns


def test_frequency_ties_nulls_and_limit(spark):
    rows = [(f"v{i:03d}",) for i in range(60)] + [("hot",)] * 40 + [(None,)] * 5
    df = spark.createDataFrame(rows, "v string")
    got = frequency.frequency(df, "['t']").orderBy(F.desc("value_counts"), F.asc_nulls_last("table_values"))
    rows = got.collect()
    assert len(rows) == 50
    assert [(r.table_values, r.value_counts) for r in rows[:4]] == [
        ("hot", 40), (None, 5), ("v000", 1), ("v001", 1),
    ]
    assert rows[0].value_percent == pytest.approx(40 / 105) and rows[0].table_name == "t"
    text = frequency.frequency_text(df).where("rank = 1").first()
    assert (text.column_name, text.percent) == ("v", "38.1%")


def test_long_values_are_counted_by_keys(spark):
    """Values that begin alike tie by their whole texts, and no shuffle of the counts holds a long text."""
    long = "x" * 70
    rows = [(f"{long}{i % 80:02d}" + "y" * 5000,) for i in range(160)] + [(long[:64],), (long[:64],), (None,)]
    df = spark.createDataFrame(rows, "v string")
    for keep in (5, 50, None):
        found = frequency.frequency(df, "t", keep=keep).orderBy(F.desc("value_counts"), F.asc_nulls_last("table_values")).collect()
        wanted = sorted({r[0] for r in rows if r[0]})
        assert [r.table_values for r in found if r.value_counts == 2] == wanted[:keep]
    sizes = []
    for repeat in (100, 4000):
        texts = spark.range(3000).select(F.concat(F.repeat(F.lit("word "), repeat), F.col("id").cast("string")).alias("v"))
        counts = frequency.key_counts(texts, ["v"])
        sizes.append(counts.agg(F.sum(F.length("key"))).first()[0])
    assert sizes[0] == sizes[1]


def test_frequency_of_nothing(spark):
    assert frequency.frequency(spark.createDataFrame([], "v string"), "t").count() == 0


def test_frequency_is_one_shuffle_of_counts(spark):
    df = spark.range(1000).select(*(F.col("id").cast("string").alias(c) for c in "abc"))
    rows = frequency.frequency(df, "t")
    assert rows.count() == 150
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Range (0, 1000") == 1 and "ReusedExchange" in plan
    assert "BatchEvalPython" not in plan


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 2), (3, None, 2), (4, None, None), (5, "b", 3)], "k int, s string, n int"
    )
    rows = {tuple(r) for r in duplicates.exact_duplicates(df, ["s", "n"], "k", "t").collect()}
    assert rows == {("1", "a", "s", "t"), ("2", "a", "s", "t"), ("2", "2", "n", "t"), ("3", "2", "n", "t")}
    assert [tuple(r) for r in duplicates.duplicates_by_column(df, "s", "k").collect()] == [(1, "a"), (2, "a")]
    assert [r.s for r in duplicates.distinct_values(df, "s").orderBy("s").collect()] == ["a", "b"]


def test_null_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "y", "x"), (None, "y", None)], "a int, b string, c string")
    assert null_rows(df, ["b", "a"]).columns == ["b", "a"]
    assert null_rows(df, ["b", "a"]).count() == 2
    assert null_rows(df).count() == 2


def test_scrubbing(spark):
    df = spark.createDataFrame([("é\tx ", "", 1.0), (None, " \n", math.inf), ("", None, -math.inf)], "a string, b string, n double")
    assert [tuple(r) for r in scrub_table(df).collect()] == [
        (" x ", "", 1.0), (None, "  ", math.inf), ("", None, -math.inf)]
    assert [tuple(r) for r in scrub_text_columns(df, ["a", "b"]).collect()] == [
        ("x", None, 1.0), (None, "", math.inf), (None, None, -math.inf)]
    assert [tuple(r) for r in scrub_legacy(df).collect()] == [
        (" x", None, 1.0), (None, None, None), (None, None, -math.inf)]


def test_outliers(spark):
    rows = [(i, 1.0 * (i % 5)) for i in range(60)] + [(60, 1000.0), (61, None)]
    df = spark.createDataFrame(rows, "k int, x double")
    flags = outliers.z_flags(df, ["x"]) | outliers.iqr_flags(df, ["x"])
    flagged = df.withColumns(flags).where("x_isOutlier OR x_iq_outlier").collect()
    assert [r.k for r in flagged] == [60]
    plan = df.withColumns(flags)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_outliers_without_spread(spark):
    for rows in ([(1.0,)] * 5, [(None,)], []):
        df = spark.createDataFrame(rows, "x double")
        out = df.withColumns(outliers.z_flags(df, ["x"]) | outliers.iqr_flags(df, ["x"]))
        assert not any(r.x_isOutlier or r.x_iq_outlier for r in out.collect())


def test_date_outliers(spark):
    df = spark.sql("SELECT timestamp_seconds(id * 3600) AS d FROM range(100) UNION ALL SELECT timestamp'2100-01-01'")
    flagged = df.withColumns(outliers.date_flags(df, ["d"])).where("d_date_outlier").collect()
    assert [r.d.year for r in flagged] == [2100]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5]), st.floats(-1e6, 1e6)), max_size=60),
    st.integers(2, 40),
)
def test_narrowing_is_exact(spark, values, accuracy):
    """Tiny sketches make many passes; the answer must not depend on them."""
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quantiles, "SKETCH_ACCURACY", accuracy)
        patch.setattr(quantiles, "MAX_FETCHED", 3)
        found = quantiles._narrow(df, ["x"], probabilities)["x"]
    present = [v for v in values if v is not None]
    if not present:
        assert found == [None] * len(probabilities)
    else:
        assert found == pytest.approx(list(np.quantile(present, probabilities)), rel=1e-9, abs=1e-9)


def test_narrowing_with_a_hot_value(spark):
    df = spark.sql("SELECT CASE WHEN id % 3 = 0 THEN 7.0D ELSE double(id % 1001) END AS x FROM range(30000)")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quantiles, "SKETCH_ACCURACY", 50)
        patch.setattr(quantiles, "MAX_FETCHED", 20)
        found = quantiles._narrow(df, ["x"], [0.1, 0.34, 0.5, 0.99])["x"]
    assert found == pytest.approx(list(np.quantile(df.toPandas()["x"], [0.1, 0.34, 0.5, 0.99])))


def test_statistics_match_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, None, 10.0], "y": [5, 5, 5, 5]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y long")
    rows = {r.column_name: r for r in statistics.numeric_stats(df).collect()}
    assert rows["x"].std == pytest.approx(pdf.x.std()) and rows["x"].median == pdf.x.median()
    assert rows["x"].third_quartile == pdf.x.quantile(0.75)
    assert rows["x"].upper == pytest.approx(pdf.x.mean() + 3 * pdf.x.std())
    assert (rows["y"].variance, rows["y"].iq_upper) == (0, 5)
    assert statistics.mean_stats(df).count() == statistics.quartile_stats(df).count() == 2


def test_describe_and_profile_of_small_tables(spark):
    df = spark.createDataFrame([("a", 1.0, True), (None, None, False)], "s string, n double, b boolean")
    rows = {r.column_name: r for r in describe.describe_columns(df, "t").collect()}
    assert (rows["s"].counts, rows["s"].nulls, rows["s"].top_values, rows["s"].unique_values) == (1, 1, "a", 1)
    assert (rows["n"].mean, rows["n"].std, rows["n"].total_rows) == (1.0, None, 2)
    assert rows["b"].unique_values == 2
    wide = {r.categories: r for r in describe.describe(df).collect()}
    assert list(wide)[:4] == ["count", "unique", "top", "freq"] and wide["null_counts"].s == "1"
    empty = profile.profile_columns(df.limit(0)).collect()
    assert {(r.n, r.n_distinct, r.p_missing, r.is_unique) for r in empty} == {(0, 0, None, False)}
    assert {r.column_name: r.is_unique for r in profile.profile_columns(df).collect()} == {
        "s": True, "n": True, "b": True}


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [(r.bin, r.n) for r in profile.histogram(df, ["x"], 4).collect()] == [(0, 2)]
