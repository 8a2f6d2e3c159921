"""LMS-shaped raw tables derived from the driver's tables by plain projections.

The text is one dialect that Spark and DuckDB share, but for ``{N}`` (the number of parts) and two functions whose names
differ. Every view grows with the table it is taken from.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from coursemart.plans.registry import Mart, Settings
from coursemart.sources.raw import LmsSource, raw_schema

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _term(key: str) -> str:
    return f"(1995 + CAST(floor(({key} % 28) / 4) AS BIGINT)) * 10 + {key} % 4 + 1"


_QUARTER_ID = "CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS BIGINT)"

VIEWS = {
    "account_dim": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
    "user_dim": "SELECT c_custkey AS id, c_name AS name FROM customer",
    "role_dim": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS id,
               CASE r_regionkey WHEN 0 THEN 'StudentEnrollment' WHEN 1 THEN 'TeacherEnrollment'
                                WHEN 2 THEN 'TaEnrollment' WHEN 3 THEN 'Grader' ELSE 'ObserverEnrollment' END AS name
          FROM region""",
    "enrollment_term_dim": f"""
        SELECT {_QUARTER_ID} AS id,
               CASE WHEN {_QUARTER_ID} = 19951 THEN 'Default Term'
                    ELSE CASE quarter(o_orderdate) WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer'
                                                   ELSE 'Fall' END
                         || ' ' || CAST(year(o_orderdate) AS STRING) END AS name,
               min(o_orderdate) AS date_start, max(o_orderdate) AS date_end
          FROM orders GROUP BY year(o_orderdate), quarter(o_orderdate)""",
    "course_dim": f"""
        SELECT p_partkey AS id, p_partkey % 27 AS account_id, {_term("p_partkey")} AS enrollment_term_id,
               p_name AS name, p_brand AS code,
               {{timestamp}}(CAST(1995 + p_size % 6 AS INT), CAST(1 + p_size % 12 AS INT), 1, 0, 0, 0) AS start_at,
               CASE p_type WHEN 'SMALL' THEN 'deleted' WHEN 'PROMO' THEN 'claimed' ELSE 'available' END
                   AS workflow_state
          FROM part""",
    "enrollment_dim": """
        SELECT o_orderkey AS id, o_custkey AS user_id, (2 * o_orderkey) % {N} AS course_id,
               o_orderkey % 3 AS course_section_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS role_id,
               CASE substr(o_orderpriority, 1, 1)
                   WHEN '1' THEN 'StudentEnrollment' WHEN '2' THEN 'TeacherEnrollment' WHEN '3' THEN 'TaEnrollment'
                   WHEN '4' THEN 'DesignerEnrollment' ELSE 'ObserverEnrollment' END AS type,
               CASE o_orderstatus WHEN 'P' THEN 'completed' ELSE 'active' END AS workflow_state
          FROM orders""",
    "submission_dim": """
        SELECT o_orderkey AS id, o_orderkey % (4 * {N}) AS assignment_id, o_custkey AS user_id,
               o_custkey % 7 AS grader_id, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END AS quiz_submission_id,
               o_orderstatus AS published_grade, o_orderdate AS submitted_at,
               o_orderdate + INTERVAL 7 DAY AS graded_at,
               CASE o_orderstatus WHEN 'F' THEN 'graded' ELSE 'not_graded' END AS grade_state,
               'not_excused' AS excused
          FROM orders""",
    "submission_fact": f"""
        SELECT o_orderkey AS submission_id, o_orderkey % (4 * {{N}}) AS assignment_id, o_orderkey % {{N}} AS course_id,
               {_term("(o_orderkey % {N})")} AS enrollment_term_id, (o_orderkey % {{N}}) % 27 AS account_id,
               o_orderkey % (2 * {{N}}) AS assignment_group_id, o_totalprice AS published_score
          FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "assignment_dim": """
        SELECT o_orderkey AS id, o_orderkey % {N} AS course_id, o_orderkey % (2 * {N}) AS assignment_group_id,
               o_orderpriority AS title, o_orderstatus AS description, 'online_upload' AS submission_types,
               o_totalprice AS points_possible, 'points' AS grading_type,
               CASE o_orderstatus WHEN 'P' THEN 'unpublished' ELSE 'published' END AS workflow_state
          FROM orders""",
    "assignment_fact": """
        SELECT o_orderkey AS assignment_id, o_orderkey % {N} AS course_id, o_totalprice AS points_possible
          FROM orders""",
    "assignment_group_dim": """
        SELECT p_partkey AS id, p_partkey AS course_id, p_name AS name FROM part
        UNION ALL
        SELECT p_partkey + {N} AS id, CASE WHEN p_partkey % 11 = 0 THEN p_partkey + 1 ELSE p_partkey END AS course_id,
               p_name AS name
          FROM part""",
    "assignment_group_fact": """
        SELECT p_partkey AS assignment_group_id, p_partkey AS course_id, p_retailprice AS group_weight FROM part""",
    "assignment_group_score_fact": """
        SELECT o_orderkey AS score_id, o_orderkey % (2 * {N}) AS assignment_group_id, o_orderkey % {N} AS course_id,
               o_totalprice AS current_score, o_totalprice / 2 AS final_score
          FROM orders""",
    "quiz_dim": """
        SELECT event_id AS id, event_type AS quiz_type, 'quiz ' || CAST(event_id AS STRING) AS name, ts AS due_at,
               event_id % (4 * {N}) AS assignment_id,
               CASE event_type WHEN 'error' THEN 'deleted' ELSE 'published' END AS workflow_state
          FROM events""",
    "quiz_fact": """
        SELECT event_id AS quiz_id, (3 * event_id) % ({N} + 40) AS course_id, value AS points_possible,
               CAST(event_id % 90 AS INT) AS time_limit, CAST(event_id % 3 AS INT) AS allowed_attempts
          FROM events WHERE event_type <> 'signup'""",
    "discussion_topic_dim": """
        SELECT doc_id AS id, text AS title, CASE WHEN doc_id % 3 = 0 THEN 'Announcement' END AS type,
               {timestamp}(2018, CAST(1 + doc_id % 12 AS INT), CAST(1 + doc_id % 28 AS INT), 0, 0, 0) AS posted_at,
               (3 * doc_id) % ({N} + 20) AS course_id,
               CASE source WHEN 'src0' THEN 'deleted' ELSE 'active' END AS workflow_state
          FROM documents""",
    "discussion_topic_fact": """
        SELECT doc_id AS discussion_topic_id, doc_id % 150 AS user_id, CAST(n_chars AS INT) AS message_length
          FROM documents WHERE source <> 'src1'""",
    "discussion_entry_fact": """
        SELECT conv_id * 10 + turn AS discussion_entry_id, conv_id * 3 AS topic_id, conv_id % 150 AS user_id
          FROM conversations""",
    "module_dim": """
        SELECT s_suppkey AS id, (5 * s_suppkey) % {N} AS course_id, s_name AS name,
               CASE s_nationkey WHEN 9 THEN 'deleted' ELSE 'active' END AS workflow_state
          FROM supplier""",
    "module_fact": f"""
        SELECT s_suppkey AS module_id, CAST(s_nationkey AS BIGINT) AS account_id,
               {_term("s_suppkey")} AS enrollment_term_id, s_suppkey AS wiki_id
          FROM supplier WHERE s_acctbal > 0""",
    "module_item_dim": """
        SELECT event_id AS id, 'item ' || CAST(event_id AS STRING) AS title, event_id % {N} AS course_id,
               event_id % {S} AS module_id,
               CASE WHEN event_id % 2 = 0 THEN 'Assignment' ELSE 'WikiPage' END AS content_type,
               CASE event_type WHEN 'error' THEN 'deleted' ELSE 'active' END AS workflow_state
          FROM events""",
    "module_progression_completion_requirement_dim": """
        SELECT event_id AS id, event_id - event_id % 3 AS module_item_id,
               CASE WHEN event_id % 2 = 0 THEN 'must_view' ELSE 'must_submit' END AS requirement_type,
               CASE event_type WHEN 'purchase' THEN 'complete' ELSE 'incomplete' END AS completion_status
          FROM events""",
    "module_progression_dim": """
        SELECT event_id AS id, user_id % 60 AS module_id,
               CASE event_type WHEN 'signup' THEN 'started' WHEN 'purchase' THEN 'completed' ELSE 'locked' END
                   AS workflow_state
          FROM events""",
    "module_progression_fact": "SELECT event_id AS module_progression_id FROM events WHERE event_type <> 'click'",
    "wiki_dim": "SELECT page_id AS id, url AS title, 'Course' AS parent_type FROM pages",
    "wiki_fact": f"""
        SELECT page_id AS wiki_id, page_id % 27 AS account_id, page_id % {{N}} AS parent_course_id,
               {_term("page_id")} AS enrollment_term_id
          FROM pages""",
    "wiki_page_dim": """
        SELECT page_id AS id, url AS title, CASE WHEN page_id % 2 = 0 THEN 'teachers' ELSE 'public' END AS editing_roles,
               CASE WHEN url LIKE '%page=2%' THEN 'deleted' ELSE 'active' END AS workflow_state
          FROM pages""",
    "wiki_page_fact": """
        SELECT page_id AS wiki_page_id, page_id AS wiki_id, (7 * page_id) % ({N} + 20) AS parent_course_id,
               CAST(length(html) AS INT) AS view_count
          FROM pages""",
}

# Terms and names that the checks exclude, in place of the defaults, which do not occur in the derived data.
EXCLUDED_TERMS = (19953, 20002)
EXCLUDED_NAMES = ("Default Term",)


_opened: dict[tuple[str, str, str], DataFrame] = {}
_sources: dict[tuple[str, str], LmsSource] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its files are listed and their schema read once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _opened:
        _opened[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _opened[key]


def _mentioned(sql: str, names) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in names if name in words]


def lms_source(spark: SparkSession, sf_dir: str) -> LmsSource:
    """The raw tables as Spark DataFrames, each made when it is first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _sources:
        return _sources[key]
    counts: dict[str, int] = {}

    def rows(name: str) -> int:
        if name not in counts:
            counts[name] = table(spark, sf_dir, name).count()
        return counts[name]

    def view(name: str):
        def make() -> DataFrame:
            sql = VIEWS[name].replace("{timestamp}", "make_timestamp_ntz")
            if "{N}" in sql:
                sql = sql.replace("{N}", f"{rows('part')}L")
            if "{S}" in sql:
                sql = sql.replace("{S}", f"{rows('supplier')}L")
            inputs = _mentioned(sql.split("FROM", 1)[1], DRIVER_TABLES)
            for used in inputs:
                sql = re.sub(rf"(?<=FROM ){used}\b", f"{{{used}}}", sql)
            frame = spark.sql(sql, **{used: table(spark, sf_dir, used) for used in inputs})
            return frame.selectExpr(*(f"CAST({f.name} AS {f.dataType.simpleString()}) {f.name}" for f in raw_schema(name)))

        return make

    _sources[key] = LmsSource({name: view(name) for name in VIEWS})
    return _sources[key]


def mart(spark: SparkSession, sf_dir: str, **settings) -> Mart:
    return Mart(
        lms_source(spark, sf_dir),
        Settings(excluded_term_ids=EXCLUDED_TERMS, excluded_term_names=EXCLUDED_NAMES, **settings),
    )


def duckdb_view(name: str) -> str:
    sql = VIEWS[name].replace("{timestamp}", "make_timestamp")
    return sql.replace("{N}", "(SELECT count(*) FROM part)").replace("{S}", "(SELECT count(*) FROM supplier)")


def with_views(sql: str, steps: dict[str, str] | None = None) -> str:
    """``sql`` after a WITH clause holding the raw views and the named ``steps`` it (transitively) mentions."""
    definitions = {**{name: duckdb_view(name) for name in VIEWS}, **(steps or {})}
    needed: list[str] = []

    def need(text: str) -> None:
        for name in _mentioned(text, definitions):
            if name not in needed:
                need(definitions[name])
                if name not in needed:
                    needed.append(name)

    need(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({definitions[name]})" for name in needed) + f"\n{sql}"
