"""Word frequencies, load log, snapshots and quality checks over the driver's tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.jobs import (
    append_load_log,
    asof,
    health_findings,
    latest,
    load_log_history,
    load_log_latest,
    log_errors,
    read_snapshots,
    retain,
    shrunken,
    snapshot,
    split_attribute_prefix,
    stale,
    word_frequency,
)
from coursemart.jobs.text import STOPWORDS, TREEBANK_RULES
from coursemart.session import scratch_path
from coursemart.sources import log_file_lines, split_lines
from verification.registry import check
from verification.tables import STEPS
from verification.views import mart, table

# --- words -----------------------------------------------------------------------------------------------------------


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_STOP = ", ".join(_sql_text(word) for word in STOPWORDS)
_KEPT = rf"length(token) > 1 AND token NOT IN ({_STOP}) AND NOT regexp_full_match(token, '\p{{N}}+')"


def _treebank(text: str) -> str:
    for pattern, replacement in TREEBANK_RULES:
        for group in "123":
            replacement = replacement.replace(f"${group}", f"\\{group}")
        text = f"regexp_replace({text}, {_sql_text(pattern)}, {_sql_text(replacement)}, 'g')"
    return text


def _frequencies(lines: str, attribute: str, tokens: str) -> str:
    return f"""
        SELECT attribute, lower(token) AS word, count(*) AS frequency
          FROM (SELECT {attribute} AS attribute, unnest({tokens}) AS token FROM ({lines}) AS l) AS t
         WHERE {_KEPT} GROUP BY attribute, lower(token)"""


_LINES = "SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents"
_TREEBANK_TOKENS = rf"regexp_split_to_array({_treebank('line')}, '\s+')"


@check("text_word_frequency", _frequencies(_LINES, "source", _TREEBANK_TOKENS))
def text_word_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return word_frequency(split_lines(table(spark, sf, "documents"), "text", "source"), "line", "source")


@check(
    "word_frequency",
    _frequencies("SELECT text, lang FROM documents", "lang", r"regexp_extract_all(text, '[\p{L}\p{N}_'']+')"),
)
def word_frequency_check(spark: SparkSession, sf: str) -> DataFrame:
    return word_frequency(table(spark, sf, "documents"), "text", "lang", tokenizer="words")


@check(
    "word_frequency_all",
    _frequencies("SELECT text FROM conversations", "'all'", r"regexp_extract_all(text, '[\p{L}\p{N}_'']+')"),
)
def word_frequency_all(spark: SparkSession, sf: str) -> DataFrame:
    return word_frequency(table(spark, sf, "conversations"), "text", tokenizer="words")


@check(
    "split_attribute_prefix",
    """SELECT split_part(line, ',', 1) AS attribute, substr(line, strpos(line, ',') + 1) AS text
         FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) AS l WHERE contains(line, ',')""",
)
def split_attribute_prefix_check(spark: SparkSession, sf: str) -> DataFrame:
    return split_attribute_prefix(split_lines(table(spark, sf, "documents"), "text"))


# --- load log --------------------------------------------------------------------------------------------------------

_LOG_TEXT = "strftime(time_refreshed, '%Y-%m-%d %H:%M:%S') || ' UTC' AS last_refreshed"
_LOG = "SELECT o_orderpriority AS tbl_name, o_orderdate AS time_refreshed, o_orderkey AS num_rows FROM orders"


def _load_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderpriority AS tbl_name", "o_orderdate AS time_refreshed", "o_orderkey AS num_rows"
    )


@check("load_log_history", f"SELECT tbl_name, {_LOG_TEXT}, num_rows FROM ({_LOG}) AS l")
def load_log_history_check(spark: SparkSession, sf: str) -> DataFrame:
    return load_log_history(_load_log(spark, sf))


@check(
    "load_log_latest",
    f"""SELECT tbl_name, {_LOG_TEXT}, num_rows FROM (
            SELECT *, row_number() OVER (PARTITION BY tbl_name ORDER BY time_refreshed DESC, num_rows DESC) AS rn
              FROM ({_LOG}) AS l) AS w WHERE rn = 1""",
)
def load_log_latest_check(spark: SparkSession, sf: str) -> DataFrame:
    return load_log_latest(_load_log(spark, sf))


@check(
    "load_log_append",
    """SELECT 'Terms' AS tbl_name, TIMESTAMP '2020-01-02 03:04:05' AS time_refreshed, (SELECT count(*) FROM Terms) AS num_rows
       UNION ALL
       SELECT 'Courses', TIMESTAMP '2020-01-02 03:04:06', (SELECT count(*) FROM Courses)""",
    STEPS,
)
def load_log_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "load-log")
    here = mart(spark, sf)
    append_load_log(here.aux("Terms"), "Terms", path, datetime(2020, 1, 2, 3, 4, 5))
    append_load_log(here.aux("Courses"), "Courses", path, datetime(2020, 1, 2, 3, 4, 6))
    return spark.read.parquet(path)


# --- snapshots: the orders of one month are one snapshot ---------------------------------------------------------------

_MONTHS = "SELECT o_orderpriority AS root, date_trunc('month', o_orderdate) AS snapshot_ts, o_orderkey, o_custkey FROM orders"


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderpriority AS root",
        "CAST(date_trunc('month', o_orderdate) AS timestamp_ntz) AS snapshot_ts",
        "o_orderkey",
        "o_custkey",
    )


@check(
    "snapshot_latest",
    f"""WITH m AS ({_MONTHS}) SELECT root, o_orderkey, o_custkey FROM m
         WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM m)""",
)
def snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest(_monthly(spark, sf))


@check(
    "snapshot_asof",
    f"""WITH m AS ({_MONTHS}) SELECT root, o_orderkey, o_custkey FROM m
         WHERE snapshot_ts = TIMESTAMP '1998-05-01 00:00:00'""",
)
def snapshot_asof(spark: SparkSession, sf: str) -> DataFrame:
    return asof(_monthly(spark, sf), datetime(1998, 5, 1))


@check(
    "snapshot_retention",
    f"""WITH m AS ({_MONTHS}) SELECT root, snapshot_ts, o_orderkey, o_custkey FROM (
            SELECT *, dense_rank() OVER (PARTITION BY root ORDER BY snapshot_ts DESC) AS r FROM m) AS w WHERE r <= 2""",
)
def snapshot_retention(spark: SparkSession, sf: str) -> DataFrame:
    return retain(_monthly(spark, sf), 2, "root")


@check(
    "snapshot_tables",
    """SELECT *, TIMESTAMP '2019-01-01 11:00:10' AS snapshot_ts FROM Terms
       UNION ALL
       SELECT *, TIMESTAMP '2019-11-01 11:00:10.123456' AS snapshot_ts FROM Terms WHERE term_name <> 'Default Term'""",
    STEPS,
)
def snapshot_tables(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "snapshots")
    terms = mart(spark, sf).aux("Terms")
    snapshot(terms, base, "Terms", datetime(2019, 1, 1, 11, 0, 10))
    snapshot(terms.where("term_name <> 'Default Term'"), base, "Terms", datetime(2019, 11, 1, 11, 0, 10, 123456))
    return read_snapshots(spark, base, "Terms")


# --- quality ---------------------------------------------------------------------------------------------------------

_SIZES = """
    WITH sizes AS (SELECT o_orderpriority AS tbl_name, count(*) FILTER (WHERE o_orderstatus = 'F') AS size
                     FROM orders GROUP BY o_orderpriority),
         baseline AS (SELECT o_orderpriority AS tbl_name, count(*) FILTER (WHERE o_orderstatus = 'P') AS expected
                        FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority)"""


def _sizes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")

    def counted(rows: DataFrame, status: str, name: str) -> DataFrame:
        return rows.groupBy(F.col("o_orderpriority").alias("tbl_name")).agg(
            F.count_if(F.col("o_orderstatus") == status).alias(name)
        )

    return counted(orders, "F", "size"), counted(orders.where("o_orderpriority <> '5-LOW'"), "P", "expected")


@check(
    "check_shrunken",
    f"""{_SIZES} SELECT s.tbl_name, s.size, coalesce(b.expected, s.size) AS expected
          FROM sizes s LEFT JOIN baseline b ON s.tbl_name = b.tbl_name
         WHERE s.size < b.expected OR s.size = 0""",
)
def check_shrunken(spark: SparkSession, sf: str) -> DataFrame:
    return shrunken(*_sizes(spark, sf))[0]


@check(
    "check_shrunken_baseline",
    f"""{_SIZES} SELECT tbl_name, greatest(s.size, coalesce(b.expected, s.size)) AS expected
          FROM sizes s LEFT JOIN baseline b USING (tbl_name)""",
)
def check_shrunken_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return shrunken(*_sizes(spark, sf))[1]


@check(
    "check_stale",
    """SELECT CAST(user_id AS VARCHAR) AS tbl_name, max(ts) AS ts FROM events GROUP BY user_id
        HAVING max(ts) < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
)
def check_stale(spark: SparkSession, sf: str) -> DataFrame:
    return stale(table(spark, sf, "events").selectExpr("CAST(user_id AS string) AS tbl_name", "ts"))


@check(
    "check_log_errors",
    """SELECT strftime(ts, '%Y-%m-%d') AS file,
              CASE event_type WHEN 'error' THEN 'an ERROR of user ' ELSE event_type || ' by user ' END || user_id AS line
         FROM events
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AND event_type = 'error'""",
)
def check_log_errors(spark: SparkSession, sf: str) -> DataFrame:
    return log_errors(_event_log(spark, sf))


def _event_log(spark: SparkSession, sf: str) -> DataFrame:
    """One log per day, one line per event."""
    logs = table(spark, sf, "events").selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS day",
        "CAST(CAST(ts AS date) AS timestamp_ntz) AS day_time",
        "CASE event_type WHEN 'error' THEN 'an ERROR of user ' ELSE event_type || ' by user ' END || user_id AS body",
    )
    return log_file_lines(logs, "day", "day_time", "body")


@check(
    "health_findings",
    f"""{_SIZES}
        SELECT 'missing' AS kind, t AS subject, '' AS detail FROM (SELECT unnest(['1-URGENT', '5-LOW', 'Rooms', 'Plans']) AS t) AS r
         WHERE t NOT IN (SELECT o_orderpriority FROM orders)
        UNION ALL
        SELECT 'shrunken', s.tbl_name, s.size || ' of ' || coalesce(b.expected, s.size)
          FROM sizes s LEFT JOIN baseline b ON s.tbl_name = b.tbl_name WHERE s.size < b.expected OR s.size = 0
        UNION ALL
        SELECT 'log', strftime(ts, '%Y-%m-%d'), 'an ERROR of user ' || user_id FROM events
         WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AND event_type = 'error'""",
)
def health_findings_check(spark: SparkSession, sf: str) -> DataFrame:
    present = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("tbl_name")).distinct()
    required = ["1-URGENT", "5-LOW", "Rooms", "Plans"]
    return health_findings(present, required, *_sizes(spark, sf), _event_log(spark, sf))
