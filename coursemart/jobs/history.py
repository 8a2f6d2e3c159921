"""The load log: one row per table build."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.calendar import utc_literal, utc_to_local_text
from coursemart.operators.keys import latest_per_key


def load_log_entry(df: DataFrame, name: str, at: datetime | None = None) -> DataFrame:
    """(tbl_name, time_refreshed, num_rows) of one built table; ``at`` is UTC, by default now."""
    moment = utc_literal(at) if at else F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.localtimestamp()
    )
    return df.agg(F.count("*").alias("num_rows")).select(
        F.lit(name).alias("tbl_name"), moment.alias("time_refreshed"), "num_rows"
    )


def append_load_log(df: DataFrame, name: str, path: str, at: datetime | None = None) -> None:
    load_log_entry(df, name, at).write.mode("append").parquet(path)


def load_log_history(load_log: DataFrame, zone: str = "UTC") -> DataFrame:
    """All load events by table name, with the local time of each."""
    return load_log.select(
        "tbl_name", utc_to_local_text("time_refreshed", zone).alias("last_refreshed"), "num_rows"
    ).orderBy("tbl_name", "last_refreshed")


def load_log_latest(load_log: DataFrame, zone: str = "UTC") -> DataFrame:
    """The newest load event of each table."""
    return load_log_history(latest_per_key(load_log, "tbl_name", "time_refreshed"), zone)
