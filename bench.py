"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to the end (into the no-op sink) once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from coursemart.plans import Settings, build  # noqa: E402
from coursemart.session import scratch_path  # noqa: E402
from verification import QUERIES  # noqa: E402
from verification.views import EXCLUDED_NAMES, EXCLUDED_TERMS, lms_source  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

OPERATORS = [
    "self_anti_join_min",
    "dedupe_on_key",
    "dense_sequence",
    "latest_per_key",
    "account_volume_batches",
    "date_in_quarter",
    "wordcount",
    "word_frequency",
    "text_word_frequency",
    "catalog_xml_to_rows",
    "classify_html_response",
    "export_by_account_batches",
    "snapshot_retention",
    "check_stale",
]
HEADLINE = [name for name in QUERIES if name.startswith("tbl_") and not name.endswith("_key_fix")] + OPERATORS


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("coursemart-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def main() -> None:
    spark = session()
    settings = Settings(excluded_term_ids=EXCLUDED_TERMS, excluded_term_names=EXCLUDED_NAMES)
    jobs = {
        name: (lambda name=name: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
        for name in HEADLINE
    }
    # The whole refresh: all tables written one after the other, each reading those before it.
    jobs["build_all_tables"] = lambda: build(
        spark, lms_source(spark, SF_DIR), scratch_path(spark, "build"), settings=settings
    )
    times = {}
    for name, job in jobs.items():
        job()
        times[name] = round(median(seconds(job) for _ in range(RUNS)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
