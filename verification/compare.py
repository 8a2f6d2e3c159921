"""Run registered queries in Spark and their SQL in DuckDB and compare: columns, row count, values without order.

    python -m verification.compare [--sf DIR] [NAME ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from verification import ORACLES, QUERIES
from verification.views import DRIVER_TABLES


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("coursemart-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, bool):
        return repr(value)
    return repr(value)


def canonical(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    ours = canonical(frame.columns, frame.collect())
    result = con.execute(ORACLES[name])
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    return (
        f"{sum(ours[1].values())} rows against {sum(theirs[1].values())}; "
        f"only Spark: {list((ours[1] - theirs[1]).items())[:2]}; only SQL: {list((theirs[1] - ours[1]).items())[:2]}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), database(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        begin = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, con, name, args.sf)
            else:
                problem = None if QUERIES[name](spark, args.sf).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{kind} {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
