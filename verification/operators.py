"""Projections, filters, joins, aggregates, orderings and set operations on the LMS views and the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions import is_one_of, none_of, same_text, term_year
from coursemart.functions.catalog import INSTRUCTOR_LIMIT
from coursemart.functions.text import cap_list
from coursemart.jobs import volumes
from coursemart.operators import (
    anti_join_append,
    batch_sizes,
    common_keys,
    conditional_counts,
    count_matches_outer,
    count_pairs_by_key,
    dedupe_on_key,
    delete_matching,
    delete_where,
    dense_sequence,
    enrich_left,
    keep_min_per_key,
    latest_per_key,
    missing_keys,
    newest_n,
    restrict_to_keys,
    union_sources,
    volume_batches,
)
from coursemart.plans.courses import teachable_courses
from coursemart.plans.people import role_of_type
from coursemart.sources import read_table
from verification.registry import check, first_row
from verification.tables import STEPS
from verification.views import EXCLUDED_NAMES, EXCLUDED_TERMS, lms_source, mart, table

# --- scans -----------------------------------------------------------------------------------------------------------


@check("scan_table", "SELECT * FROM customer")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/customer.parquet")


@check(
    "scan_multi_db_union",
    """SELECT o_custkey AS user_id, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
       UNION ALL
       SELECT o_custkey AS user_id, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey""",
)
def scan_multi_db_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    databases = {
        "school_north": orders.where("o_orderstatus = 'F'"),
        "school_south": orders.where("o_orderstatus = 'O'"),
        "archive": orders.where("o_orderstatus = 'P'"),
    }
    return union_sources(
        databases, "SCHOOL%", {"user_id": F.col("o_custkey"), "n": F.count("*")}, group_by=[F.col("o_custkey")]
    )


# --- projections and filters -----------------------------------------------------------------------------------------


@check("project_rename", "SELECT id AS account_id, name AS account_name FROM account_dim")
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["account_dim"].selectExpr("id AS account_id", "name AS account_name")


@check(
    "project_null_placeholders",
    """SELECT id AS course_id, CAST(NULL AS VARCHAR) AS term_name, CAST(NULL AS INTEGER) AS units_max,
              CAST(NULL AS TIMESTAMP) AS date_end FROM course_dim""",
)
def project_null_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["course_dim"].select(
        F.col("id").alias("course_id"),
        F.lit(None).cast("string").alias("term_name"),
        F.lit(None).cast("int").alias("units_max"),
        F.lit(None).cast("timestamp_ntz").alias("date_end"),
    )


@check("project_star_plus", "SELECT r.*, CAST(NULL AS VARCHAR) AS instructor_team FROM role_dim r")
def project_star_plus(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["role_dim"].select("*", F.lit(None).cast("string").alias("instructor_team"))


@check(
    "case_map",
    """SELECT id, CASE type WHEN 'TeacherEnrollment' THEN 'instructor' WHEN 'StudentEnrollment' THEN 'student'
                            WHEN 'TaEnrollment' THEN 'TA' WHEN 'DesignerEnrollment' THEN 'designer'
                            WHEN 'ObserverEnrollment' THEN 'observer' END AS role
         FROM enrollment_dim""",
)
def case_map(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["enrollment_dim"].select("id", role_of_type().alias("role"))


@check("filter_eq", "SELECT id, title FROM discussion_topic_dim WHERE workflow_state = 'active'")
def filter_eq(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["discussion_topic_dim"].where(same_text("workflow_state", "Active ")).select("id", "title")


@check("filter_in", "SELECT id, name FROM course_dim WHERE workflow_state IN ('claimed', 'available')")
def filter_in(spark: SparkSession, sf: str) -> DataFrame:
    return (
        lms_source(spark, sf)["course_dim"]
        .where(is_one_of("workflow_state", ("claimed", "available")))
        .select("id", "name")
    )


@check(
    "filter_not_in",
    """SELECT d.id, d.name FROM enrollment_term_dim d
        WHERE d.name NOT IN ('Default Term', 'Test Term') AND d.id NOT IN (19953, 20002)""",
)
def filter_not_in(spark: SparkSession, sf: str) -> DataFrame:
    return (
        lms_source(spark, sf)["enrollment_term_dim"]
        .where(none_of("name", (*EXCLUDED_NAMES, "Test Term")) & ~F.col("id").isin(*EXCLUDED_TERMS))
        .select("id", "name")
    )


_QUARTERS = """
    SELECT c.id AS course_id, t.name AS quarter_name_canvas,
           CASE c.workflow_state WHEN 'available' THEN 'Fall' WHEN 'claimed' THEN 'Spring' END AS quarter_name_peoplesoft
      FROM course_dim c LEFT JOIN enrollment_term_dim t ON c.enrollment_term_id = t.id"""


def _quarter_rows(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    offered = F.when(same_text("workflow_state", "available"), "Fall").when(
        same_text("workflow_state", "claimed"), "Spring"
    )
    courses = lms["course_dim"].select(
        F.col("id").alias("course_id"), "enrollment_term_id", offered.alias("quarter_name_peoplesoft")
    )
    return enrich_left(
        courses, lms["enrollment_term_dim"], {"enrollment_term_id": "id"}, {"quarter_name_canvas": "name"}
    ).drop("enrollment_term_id")


@check(
    "filter_neq_nullsafe_guard",
    f"""SELECT * FROM ({_QUARTERS}) AS q
         WHERE quarter_name_canvas IS NOT NULL AND quarter_name_peoplesoft IS NOT NULL
           AND quarter_name_peoplesoft <> split_part(quarter_name_canvas, ' ', 1)""",
)
def filter_neq_nullsafe_guard(spark: SparkSession, sf: str) -> DataFrame:
    return _quarter_rows(spark, sf).where(
        F.col("quarter_name_peoplesoft") != F.substring_index("quarter_name_canvas", " ", 1)
    )


@check(
    "delete_where",
    f"""SELECT * FROM ({_QUARTERS}) AS q
         WHERE quarter_name_canvas IS NULL OR quarter_name_peoplesoft IS NULL
            OR quarter_name_peoplesoft = split_part(quarter_name_canvas, ' ', 1)""",
)
def delete_where_check(spark: SparkSession, sf: str) -> DataFrame:
    return delete_where(
        _quarter_rows(spark, sf),
        F.col("quarter_name_peoplesoft") != F.substring_index("quarter_name_canvas", " ", 1),
    )


@check("filter_is_null", "SELECT id FROM discussion_topic_dim WHERE type IS NULL")
def filter_is_null(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["discussion_topic_dim"].where(F.col("type").isNull()).select("id")


@check(
    "filter_between",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20",
)
def filter_between(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "lineitem")
        .where(F.col("l_quantity").between(10, 20))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@check(
    "filter_like_regexp",
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' OR regexp_matches(p_name, '(ring|bolt)$')",
)
def filter_like_regexp(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf, "part").where(name.like("small%") | name.rlike("(ring|bolt)$")).select("p_partkey", "p_name")


@check("fill_null_default", "SELECT id, coalesce(type, 'Discussion') AS type FROM discussion_topic_dim")
def fill_null_default(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["discussion_topic_dim"].select(
        "id", F.coalesce("type", F.lit("Discussion")).alias("type")
    )


# --- joins -----------------------------------------------------------------------------------------------------------


@check("left_join", "SELECT d.id, f.account_id, f.wiki_id FROM module_dim d LEFT JOIN module_fact f ON d.id = f.module_id")
def left_join(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    return (
        lms["module_dim"]
        .select("id")
        .join(lms["module_fact"], F.col("id") == F.col("module_id"), "left")
        .select("id", "account_id", "wiki_id")
    )


@check(
    "left_join_filtered_right",
    """SELECT c.id AS course_id, e.user_id FROM course_dim c LEFT JOIN enrollment_dim e ON c.id = e.course_id
        WHERE c.workflow_state = 'available' AND e.workflow_state = 'active'
          AND c.enrollment_term_id NOT IN (19953, 20002)""",
)
def left_join_filtered_right(spark: SparkSession, sf: str) -> DataFrame:
    here = mart(spark, sf)
    taken = here.raw("enrollment_dim").select("course_id", "user_id", F.col("workflow_state").alias("enrolment_state"))
    return (
        teachable_courses(here)
        .select("id")
        .join(taken, F.col("id") == F.col("course_id"), "left")
        .where(same_text("enrolment_state", "active"))
        .select("course_id", "user_id")
    )


@check(
    "enrich_left",
    f"""SELECT u.id AS user_id, u.name, e.type, e.course_id
          FROM user_dim u LEFT JOIN {first_row("enrollment_dim", "user_id", "course_id, type")} e ON u.id = e.user_id""",
)
def enrich_left_check(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    return enrich_left(
        lms["user_dim"].withColumnRenamed("id", "user_id"),
        lms["enrollment_dim"],
        {"user_id": "user_id"},
        {"type": "type", "course_id": "course_id"},
        order_by=["course_id"],
    )


@check(
    "enrich_left_keep",
    """SELECT c.id AS course_id, coalesce(t.name, c.code) AS label
         FROM course_dim c LEFT JOIN (SELECT * FROM enrollment_term_dim WHERE name NOT IN ('Default Term')) t
           ON c.enrollment_term_id = t.id""",
)
def enrich_left_keep(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    return enrich_left(
        lms["course_dim"].selectExpr("id AS course_id", "enrollment_term_id", "code AS label"),
        lms["enrollment_term_dim"],
        {"enrollment_term_id": "id"},
        {"label": "name"},
        unmatched="keep",
        condition=none_of("name", EXCLUDED_NAMES),
    ).drop("enrollment_term_id")


@check(
    "join_multi_key",
    """SELECT d.id, f.course_id, f.published_score FROM submission_dim d
         LEFT JOIN submission_fact f ON d.id = f.submission_id AND d.assignment_id = f.assignment_id""",
)
def join_multi_key(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    facts = lms["submission_fact"].select(
        F.col("submission_id").alias("id"), "assignment_id", "course_id", "published_score"
    )
    return (
        lms["submission_dim"]
        .select("id", "assignment_id")
        .join(facts, ["id", "assignment_id"], "left")
        .select("id", "course_id", "published_score")
    )


_APPEND = """
    SELECT course_id, id AS assignment_id, CAST(NULL AS BIGINT) AS quiz_id FROM assignment_dim WHERE workflow_state = 'published'
    UNION ALL
    SELECT q.course_id, NULL, q.quiz_id FROM quiz_fact q
     WHERE NOT EXISTS (SELECT 1 FROM assignment_dim a
                        WHERE a.workflow_state = 'published' AND a.course_id = q.course_id)"""


@check("anti_join_append", _APPEND)
def anti_join_append_check(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    assignments = lms["assignment_dim"].where(same_text("workflow_state", "published"))
    return anti_join_append(
        assignments.select("course_id", F.col("id").alias("assignment_id"), F.lit(None).cast("long").alias("quiz_id")),
        lms["quiz_fact"],
        {"course_id": "course_id"},
        {"course_id": "course_id", "quiz_id": "quiz_id"},
    )


@check(
    "union_all_append",
    """SELECT course_id, id, name FROM quiz_dim d JOIN quiz_fact f ON d.id = f.quiz_id
       UNION ALL SELECT course_id, id, NULL FROM assignment_dim""",
)
def union_all_append(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    quizzes = lms["quiz_dim"].join(lms["quiz_fact"], F.col("id") == F.col("quiz_id")).select("course_id", "id", "name")
    return quizzes.unionByName(lms["assignment_dim"].select("course_id", "id"), allowMissingColumns=True)


_NULLABLE = """
    SELECT l_orderkey, nullif(l_partkey, 7) AS l_partkey, nullif(l_linenumber, 3) AS l_linenumber, l_quantity FROM lineitem"""


@check(
    "self_anti_join_min",
    f"""WITH t AS ({_NULLABLE})
        SELECT t1.* FROM t t1 WHERE NOT EXISTS (
            SELECT 1 FROM t t2 WHERE t1.l_partkey = t2.l_partkey AND t1.l_linenumber = t2.l_linenumber
                                 AND t1.l_orderkey > t2.l_orderkey)""",
)
def self_anti_join_min(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "nullif(l_partkey, 7) AS l_partkey", "nullif(l_linenumber, 3) AS l_linenumber", "l_quantity"
    )
    return keep_min_per_key(rows, ["l_partkey", "l_linenumber"], "l_orderkey")


@check(
    "min_per_key_keep",
    """SELECT p_partkey, p_name, p_type FROM (
           SELECT *, min(p_partkey) OVER (PARTITION BY p_name, p_type) AS least FROM part) AS w
        WHERE p_partkey = least""",
)
def min_per_key_keep(spark: SparkSession, sf: str) -> DataFrame:
    return keep_min_per_key(
        table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), ["p_name", "p_type"], "p_partkey"
    )


@check(
    "delete_join",
    """SELECT a.id, a.course_id FROM assignment_dim a
        WHERE NOT EXISTS (SELECT 1 FROM course_dim c WHERE c.id = a.course_id AND c.workflow_state <> 'available')""",
)
def delete_join(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    return delete_matching(
        lms["assignment_dim"].select("id", "course_id"),
        lms["course_dim"],
        {"course_id": "id"},
        ~same_text("workflow_state", "available"),
    )


@check(
    "self_join_chain_3",
    """SELECT c.id AS course_id, d.name AS quarter_name, d.date_end
         FROM course_dim c
         LEFT JOIN (SELECT e.* FROM enrollment_term_dim e JOIN Terms t ON e.id = t.term_id
                     WHERE t.term_name NOT IN ('Default Term')) d ON c.enrollment_term_id = d.id""",
    STEPS,
)
def self_join_chain_3(spark: SparkSession, sf: str) -> DataFrame:
    here = mart(spark, sf)
    named = here.aux("Terms").where(none_of("term_name", EXCLUDED_NAMES)).select("term_id")
    days = here.raw("enrollment_term_dim").join(named, F.col("id") == F.col("term_id"))
    courses = here.raw("course_dim").select(F.col("id").alias("course_id"), "enrollment_term_id")
    return enrich_left(
        courses, days, {"enrollment_term_id": "id"}, {"quarter_name": "name", "date_end": "date_end"}
    ).drop("enrollment_term_id")


@check(
    "join_aggregated_subquery",
    """SELECT c.id, n.enrollments FROM course_dim c
         LEFT JOIN (SELECT course_id, count(*) AS enrollments FROM enrollment_dim GROUP BY course_id) n
           ON c.id = n.course_id""",
)
def join_aggregated_subquery(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    counts = lms["enrollment_dim"].groupBy("course_id").agg(F.count("*").alias("enrollments"))
    return enrich_left(
        lms["course_dim"].select("id"), counts, {"id": "course_id"}, {"enrollments": "enrollments"}
    )


@check(
    "semi_join_terms",
    """SELECT f.submission_id, f.enrollment_term_id FROM submission_fact f
        WHERE f.enrollment_term_id IN (
            SELECT term_id FROM Terms
             WHERE coalesce(TRY_CAST(split_part(term_name, ' ', -1) AS INTEGER), 0) >= 1999)""",
    STEPS,
)
def semi_join_terms(spark: SparkSession, sf: str) -> DataFrame:
    here = mart(spark, sf)
    return restrict_to_keys(
        here.raw("submission_fact").select("submission_id", "enrollment_term_id"),
        here.aux("Terms").where(term_year("term_name") >= 1999),
        {"enrollment_term_id": "term_id"},
    )


@check(
    "missing_keys",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def missing_keys_check(spark: SparkSession, sf: str) -> DataFrame:
    present = table(spark, sf, "orders").where("o_orderstatus = 'P'").selectExpr("o_custkey AS c_custkey")
    return missing_keys(table(spark, sf, "customer"), present, ["c_custkey"])


@check("except_names", "SELECT account_id FROM course_dim EXCEPT SELECT id FROM account_dim")
def except_names(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    known = lms["account_dim"].selectExpr("id AS account_id")
    return missing_keys(lms["course_dim"], known, ["account_id"])


@check("intersect_names", "SELECT account_id FROM course_dim INTERSECT SELECT id FROM account_dim")
def intersect_names(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    known = lms["account_dim"].selectExpr("id AS account_id")
    return common_keys(lms["course_dim"], known, ["account_id"])


# --- aggregates ------------------------------------------------------------------------------------------------------


@check("distinct_rows", "SELECT DISTINCT user_id, type FROM enrollment_dim")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["enrollment_dim"].select("user_id", "type").distinct()


@check("count_star_by_key", "SELECT module_id, count(*) AS n FROM module_progression_dim GROUP BY module_id")
def count_star_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["module_progression_dim"].groupBy("module_id").agg(F.count("*").alias("n"))


@check(
    "count_col_outer",
    """SELECT b.course_id, count(b.course_id) AS n
         FROM courses_base b LEFT JOIN enrollment_dim e ON b.course_id = e.course_id GROUP BY b.course_id""",
    STEPS,
)
def count_col_outer(spark: SparkSession, sf: str) -> DataFrame:
    here = mart(spark, sf)
    return count_matches_outer(here.aux("Courses").select("course_id"), here.raw("enrollment_dim"), "course_id")


@check(
    "count_col_outer_exact",
    """SELECT b.course_id, count(e.id) AS n
         FROM courses_base b LEFT JOIN enrollment_dim e ON b.course_id = e.course_id GROUP BY b.course_id""",
    STEPS,
)
def count_col_outer_exact(spark: SparkSession, sf: str) -> DataFrame:
    here = mart(spark, sf)
    courses = here.aux("Courses").select("course_id")
    return count_matches_outer(courses, here.raw("enrollment_dim"), "course_id", exact=True)


@check(
    "count_outer_right_key",
    """SELECT t.id AS topic_id, n.n FROM discussion_topic_dim t
         LEFT JOIN (SELECT e.topic_id, count(*) AS n
                      FROM discussion_topic_dim d LEFT JOIN discussion_entry_fact e ON d.id = e.topic_id
                     GROUP BY e.topic_id) n ON t.id = n.topic_id""",
)
def count_outer_right_key(spark: SparkSession, sf: str) -> DataFrame:
    lms = lms_source(spark, sf)
    topics = lms["discussion_topic_dim"].selectExpr("id AS topic_id")
    pairs = count_pairs_by_key(topics, "topic_id", lms["discussion_entry_fact"], "topic_id")
    return enrich_left(topics, pairs, {"topic_id": "topic_id"}, {"n": "n"})


@check(
    "group_concat_distinct",
    """SELECT course_id, string_agg(DISTINCT type, ', ' ORDER BY type) AS types
         FROM enrollment_dim GROUP BY course_id""",
)
def group_concat_distinct(spark: SparkSession, sf: str) -> DataFrame:
    from coursemart.functions import join_names

    return lms_source(spark, sf)["enrollment_dim"].groupBy("course_id").agg(join_names("type").alias("types"))


_BATCHES = """
    SELECT account_id, count(*) AS num_rows,
           CASE WHEN count(*) >= 450 AND account_id IS NOT NULL THEN CAST(account_id AS VARCHAR) ELSE 'shared' END AS batch
      FROM submission_fact GROUP BY account_id"""


@check("account_volume_batches", _BATCHES)
def account_volume_batches(spark: SparkSession, sf: str) -> DataFrame:
    return volume_batches(lms_source(spark, sf)["submission_fact"], "account_id", 450)


@check(
    "account_batch_sizes",
    f"SELECT batch, count(*) AS num_keys, CAST(sum(num_rows) AS BIGINT) AS num_rows FROM ({_BATCHES}) AS b GROUP BY batch",
)
def account_batch_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return batch_sizes(volume_batches(lms_source(spark, sf)["submission_fact"], "account_id", 450))


@check("max_value", "SELECT max(id) AS max_id FROM enrollment_dim")
def max_value(spark: SparkSession, sf: str) -> DataFrame:
    return lms_source(spark, sf)["enrollment_dim"].agg(F.max("id").alias("max_id"))


@check("row_count", "SELECT count(*) AS num_rows FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").agg(F.count("*").alias("num_rows"))


_LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)


@check(
    "dedupe_on_key",
    f"""SELECT l_orderkey, l_linenumber, {_LINE_ORDER} FROM
        {first_row("lineitem", "l_orderkey, l_linenumber", _LINE_ORDER)} AS x""",
)
def dedupe_on_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_on_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@check(
    "latest_per_key",
    """SELECT user_id, ts, event_id, event_type FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS w
        WHERE rn = 1""",
)
def latest_per_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts")


@check(
    "conditional_counts",
    """SELECT module_id, nullif(count(*) FILTER (WHERE workflow_state = 'started'), 0) AS num_started,
              nullif(count(*) FILTER (WHERE workflow_state = 'completed'), 0) AS num_completed
         FROM module_progression_dim GROUP BY module_id""",
)
def conditional_counts_check(spark: SparkSession, sf: str) -> DataFrame:
    return conditional_counts(
        lms_source(spark, sf)["module_progression_dim"],
        "module_id",
        {
            "num_started": same_text("workflow_state", "started"),
            "num_completed": same_text("workflow_state", "completed"),
        },
    )


# --- windows, orderings ----------------------------------------------------------------------------------------------


@check(
    "dense_sequence",
    """SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS seq_num,
              l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem""",
)
def dense_sequence_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dense_sequence(rows, ["l_shipdate", "l_orderkey", "l_linenumber"])


_NEWEST = """
    SELECT o_orderpriority, o_orderdate,
           CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) AS INTEGER) AS rank
      FROM (SELECT DISTINCT o_orderpriority, o_orderdate FROM orders) AS d"""


@check("rank_newest_n", f"SELECT * FROM ({_NEWEST}) AS w WHERE rank <= 3")
def rank_newest_n(spark: SparkSession, sf: str) -> DataFrame:
    return newest_n(table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", 3)


@check(
    "sort_snapshots_desc",
    "SELECT DISTINCT o_orderpriority AS root, o_orderdate AS taken_at FROM orders ORDER BY taken_at DESC, root",
)
def sort_snapshots_desc(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "orders").selectExpr("o_orderpriority AS root", "o_orderdate AS taken_at").distinct()
    return names.orderBy(F.desc("taken_at"), "root")


@check(
    "order_by_count_desc",
    "SELECT account_id, count(*) AS n FROM submission_fact GROUP BY account_id ORDER BY n DESC, account_id",
)
def order_by_count_desc(spark: SparkSession, sf: str) -> DataFrame:
    counts = lms_source(spark, sf)["submission_fact"].groupBy("account_id").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "account_id")


@check("order_by_name", "SELECT n_name, n_nationkey FROM nation ORDER BY n_name")
def order_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select("n_name", "n_nationkey").orderBy("n_name")


@check("limit_1", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def limit_1(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(1)


@check(
    "cap_list_10",
    """SELECT p_partkey, array_to_string([p_name || '-' || i FOR i IN range(1, least(p_size, 10) + 1)], ', ')
                         || CASE WHEN p_size > 10 THEN '...' ELSE '' END AS names
         FROM part""",
)
def cap_list_10(spark: SparkSession, sf: str) -> DataFrame:
    numbers = F.filter(F.sequence(F.lit(0), F.col("p_size")), lambda i: i > 0)
    names = F.transform(numbers, lambda i: F.concat_ws("-", "p_name", i))
    return table(spark, sf, "part").select("p_partkey", cap_list(names, INSTRUCTOR_LIMIT).alias("names"))


@check(
    "volumes_by_key",
    "SELECT event_type AS tbl_name, count(*) AS size FROM events GROUP BY event_type",
)
def volumes_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return volumes(table(spark, sf, "events"), "event_type")
