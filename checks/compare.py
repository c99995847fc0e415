"""Run a registered query beside its DuckDB equivalent and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime, timezone
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(value)
    if isinstance(value, datetime) and value.tzinfo is not None:
        return value.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(value, date) and not isinstance(value, datetime):
        return datetime(value.year, value.month, value.day)
    return value


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Nothing when names, rows and value kinds agree, else what differs."""
    relation = connection.sql(sql)
    names, wanted_names = sorted(df.columns), sorted(relation.columns)
    if names != wanted_names:
        return [f"columns {names} / {wanted_names}"]
    order = [relation.columns.index(n) for n in names]
    have = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    want = Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    kinds = [
        (n, {type(r[i]) for r in have}, {type(r[i]) for r in want})
        for i, n in enumerate(names)
        if {type(r[i]) for r in have} != {type(r[i]) for r in want}
    ]
    found = [f"kinds {k}" for k in kinds] if have == want else []
    missing, extra = want - have, have - want
    if missing or extra:
        found.append(f"columns {names}")
        found.append(f"{sum(have.values())} rows / {sum(want.values())} wanted")
        found += [f"missing {r}" for r in list(missing)[:3]] + [f"extra {r}" for r in list(extra)[:3]]
    return found
