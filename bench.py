"""Headline queries: warm-up, then the median of three runs each, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks import queries as Q
from checks.relations import table
from rowproof.operators import frequency, outliers

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def line_frequency(spark, folder):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"]
    return frequency.frequency(table(spark, folder, "lineitem"), "lineitem", columns)


def order_outliers(spark, folder):
    orders = table(spark, folder, "orders")
    flags = outliers.z_flags(orders, ["o_totalprice"]) | outliers.iqr_flags(orders, ["o_totalprice"])
    return orders.withColumns(flags)


HEADLINES = {
    "frequency_lineitem": line_frequency,
    "numeric_stats_lineitem": Q.numeric_stats,
    "numeric_stats_narrowed": Q.numeric_stats_narrowed,
    "describe_orders": Q.describe_transposed,
    "column_profile_customer": Q.column_profile,
    "outliers_orders": order_outliers,
    "exact_duplicates_documents": Q.duplicate_texts,
    "scrub_documents": Q.scrub_file,
    "title_documents": Q.title_texts,
    "phone_in_documents": Q.phone_in_documents,
    "validation_contacts": Q.validation_summary,
    "check_frequency_contacts": Q.QUERIES["check_frequency"],
    "address_cleaning": Q.address_messages,
    "fuzzy_compare_part": Q.fuzzy_compare,
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        HEADLINES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("/sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
