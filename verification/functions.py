"""Column functions over the driver's dates, texts and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions import (
    date_in_quarter,
    parse_snapshot_name,
    qualified_db_name,
    qualified_table_name,
    quarter_lower_date,
    quarter_upper_date,
    replace_spaces,
    utc_to_local_text,
    wordcount,
)
from coursemart.plans import TABLES
from coursemart.plans.requirements import REQUIREMENTS, requirement_flags
from verification.registry import check
from verification.views import lms_source, table

_QUARTER = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'fall' WHEN '2' THEN 'Winter' WHEN '3' THEN 'spring' "
    "WHEN '4' THEN 'SUMMER' ELSE 'autumn' END"
)


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderdate", f"{_QUARTER} AS quarter", "year(o_orderdate) - o_custkey % 2 AS academic_year"
    )


_MONTH = "month(o_orderdate)"
_IN_QUARTER = f"""
    SELECT o_orderkey,
           CASE WHEN {_MONTH} IN (9, 10, 11) THEN lower(quarter) = 'fall' AND year(o_orderdate) = academic_year
                WHEN {_MONTH} IN (6, 7, 8) THEN lower(quarter) = 'summer' AND year(o_orderdate) = academic_year + 1
                WHEN {_MONTH} IN (3, 4, 5) THEN lower(quarter) = 'spring' AND year(o_orderdate) = academic_year + 1
                WHEN {_MONTH} = 12 THEN year(o_orderdate) = academic_year
                ELSE year(o_orderdate) = academic_year + 1 END AS in_quarter,
           CASE WHEN {_MONTH} IN (9, 10, 11) THEN lower(quarter) = 'fall'
                WHEN {_MONTH} IN (6, 7, 8) THEN lower(quarter) = 'summer'
                WHEN {_MONTH} IN (3, 4, 5) THEN lower(quarter) = 'spring'
                ELSE lower(quarter) = 'winter' END AS in_quarter_any_year
      FROM (SELECT o_orderkey, o_orderdate, {_QUARTER} AS quarter, year(o_orderdate) - o_custkey % 2 AS academic_year
              FROM orders) AS d"""


@check("date_in_quarter", _IN_QUARTER)
def date_in_quarter_check(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf).select(
        "o_orderkey",
        date_in_quarter("o_orderdate", F.col("quarter"), F.col("academic_year").cast("string")).alias("in_quarter"),
        date_in_quarter("o_orderdate", F.col("quarter"), "%").alias("in_quarter_any_year"),
    )


def _quarter_dates(days: str) -> str:
    return f"""
    SELECT o_orderkey, {days} AS day
      FROM (SELECT o_orderkey, lower({_QUARTER}) AS quarter, year(o_orderdate) - o_custkey % 2 AS y FROM orders) AS d"""


@check(
    "quarter_lower_date",
    _quarter_dates(
        "CASE quarter WHEN 'fall' THEN make_date(y, 9, 1) WHEN 'winter' THEN make_date(y, 12, 1) "
        "WHEN 'spring' THEN make_date(y + 1, 3, 1) WHEN 'summer' THEN make_date(y + 1, 6, 1) END"
    ),
)
def quarter_lower_date_check(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf).select(
        "o_orderkey", quarter_lower_date(F.col("quarter"), F.col("academic_year").cast("string")).alias("day")
    )


@check(
    "quarter_upper_date",
    _quarter_dates(
        "CASE quarter WHEN 'fall' THEN make_date(y, 11, 30) WHEN 'winter' THEN make_date(y + 1, 2, 28) "
        "WHEN 'spring' THEN make_date(y + 1, 5, 31) WHEN 'summer' THEN make_date(y + 1, 8, 31) END"
    ),
)
def quarter_upper_date_check(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf).select(
        "o_orderkey", quarter_upper_date(F.col("quarter"), F.col("academic_year").cast("string")).alias("day")
    )


_WORDS = r"CAST(coalesce(len(regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+')), 0) AS INTEGER)"


@check(
    "wordcount",
    f"""SELECT doc_id, {_WORDS.format(text="left(text, greatest(length(text) - 1, 0))")} AS words,
               {_WORDS.format(text="text")} AS words_exact FROM documents""",
)
def wordcount_check(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", wordcount("text").alias("words"), wordcount("text", exact=True).alias("words_exact")
    )


@check(
    "sum_wordcount",
    f"""SELECT lang, CAST(sum({_WORDS.format(text="left(text, greatest(length(text) - 1, 0))")}) AS BIGINT) AS words
          FROM documents GROUP BY lang""",
)
def sum_wordcount(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("lang").agg(F.sum(wordcount("text")).alias("words"))


@check(
    "substring_index",
    """SELECT id, split_part(name, ' ', 1) AS quarter, split_part(name, ' ', -1) AS year FROM enrollment_term_dim""",
)
def substring_index(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["enrollment_term_dim"].select(
        "id",
        F.substring_index("name", " ", 1).alias("quarter"),
        F.substring_index("name", " ", -1).alias("year"),
    )


# Requirement lists as they occur in the catalog, chosen by the size of a part.
_GERS = (
    "CASE p_size % 6 WHEN 0 THEN 'THINK, WAY-ER,Writing 1' WHEN 1 THEN 'GER:DB-Hum, WAY-A-II' WHEN 2 THEN '' "
    "WHEN 3 THEN 'Language,GER:EC-Gender , Way-SMA' WHEN 4 THEN 'GER: DB-NatSci, WAY-SMA' END"
)


@check(
    "find_in_set_flag",
    "SELECT p_partkey, "
    + ", ".join(
        f"CASE WHEN list_contains(string_split(lower(replace({_GERS}, ' ', '')), ','), lower('{tag}')) "
        f"THEN 1 ELSE 0 END AS {flag}"
        for flag, tag in REQUIREMENTS.items()
    )
    + " FROM part",
)
def find_in_set_flag_check(spark: SparkSession, sf: str) -> DataFrame:
    lists = table(spark, sf, "part").selectExpr("p_partkey", f"{_GERS} AS gers")
    return lists.select("p_partkey", *requirement_flags("gers"))


@check("replace_spaces", "SELECT p_partkey, replace(p_name, ' ', '') AS name FROM part")
def replace_spaces_check(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", replace_spaces("p_name").alias("name"))


_QUALIFIED = "CASE WHEN p_size % 2 = 0 THEN p_type || '.' || p_name || '.x' ELSE p_name END"


@check(
    "qualified_db_name",
    f"""SELECT p_partkey, CASE WHEN strpos(n, '.') = 0 THEN 'current_db' ELSE split_part(n, '.', 1) END AS db
          FROM (SELECT p_partkey, {_QUALIFIED} AS n FROM part) AS q""",
)
def qualified_db_name_check(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").selectExpr("p_partkey", f"{_QUALIFIED} AS n")
    return names.select("p_partkey", qualified_db_name("n", "current_db").alias("db"))


@check(
    "qualified_table_name",
    f"""SELECT p_partkey, substr(n, strpos(n, '.') + 1) AS tbl FROM (SELECT p_partkey, {_QUALIFIED} AS n FROM part) AS q""",
)
def qualified_table_name_check(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").selectExpr("p_partkey", f"{_QUALIFIED} AS n")
    return names.select("p_partkey", qualified_table_name("n").alias("tbl"))


# Snapshot names: known and unknown tables, with and without a fraction, some of them malformed.
_SNAPSHOT_ROOT = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Terms' WHEN '2' THEN 'ExploreCourses' WHEN '3' THEN 'foo' "
    "WHEN '4' THEN 'old_Courses' ELSE '' END"
)
_SNAPSHOT_TAIL = "CASE o_orderstatus WHEN 'F' THEN '_11_51_03' WHEN 'O' THEN '_11_51_03_1234' ELSE '_25_51_03_123456' END"


@check(
    "parse_snapshot_name",
    f"""SELECT o_orderkey, CASE WHEN ok THEN root END AS root, CASE WHEN ok THEN date_text END AS date_text,
               CASE WHEN ok THEN taken_at END AS taken_at
          FROM (SELECT o_orderkey,
                       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Terms' WHEN '2' THEN 'ExploreCourses'
                                                          WHEN '4' THEN 'Courses' END AS root,
                       strftime(o_orderdate, '%Y_%m_%d') || {_SNAPSHOT_TAIL} AS date_text,
                       o_orderstatus <> 'P' AND substr(o_orderpriority, 1, 1) IN ('1', '2', '4') AS ok,
                       date_trunc('day', o_orderdate) + INTERVAL 42663 SECOND
                       + CASE o_orderstatus WHEN 'O' THEN INTERVAL 123400 MICROSECOND ELSE INTERVAL 0 SECOND END AS taken_at
                  FROM orders) AS s""",
)
def parse_snapshot_name_check(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"{_SNAPSHOT_ROOT} || '_' || date_format(o_orderdate, 'yyyy_MM_dd') || {_SNAPSHOT_TAIL} AS name",
    )
    return names.select("o_orderkey", parse_snapshot_name("name", TABLES).alias("p")).select("o_orderkey", "p.*")


@check(
    "utc_to_local_text",
    """SELECT o_orderkey, strftime(local, '%Y-%m-%d %H:%M:%S')
              || CASE date_diff('hour', local, o_orderdate) WHEN 7 THEN ' PDT' ELSE ' PST' END AS local_text
         FROM (SELECT o_orderkey, o_orderdate,
                      o_orderdate AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles' AS local FROM orders) AS t""",
)
def utc_to_local_text_check(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", utc_to_local_text("o_orderdate", "America/Los_Angeles").alias("local_text")
    )
