"""Compare all registered queries: `python -m checks.run_all FOLDER [query ...]`."""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES


def main(folder: str, wanted: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = duck(folder), 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            found = differences(QUERIES[name](spark, folder), connection, ORACLES[name])
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok'} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print(f"    {line[:1500]}", flush=True)
    print(f"{failures} failures", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
