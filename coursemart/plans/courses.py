"""Courses, who teaches them and who takes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.text import is_one_of, join_names, none_of, same_text
from coursemart.operators import count_matches_outer, delete_where, enrich_left, join_distinct
from coursemart.plans.registry import Mart, auxiliary_table


@auxiliary_table(
    "Courses",
    """account_id bigint, course_id bigint, enrollment_term_id bigint, term_name varchar(60),
    account_name varchar(255), course_name varchar(255), stanford_course_id int, code varchar(255),
    date_end datetime, quarter_name_canvas varchar(16), quarter_name_peoplesoft varchar(40), acad_year varchar(25),
    course_code varchar(30), subject varchar(15), units_max int, ger_fulfillment varchar(255), acad_group varchar(25),
    department varchar(40), acad_career varchar(10), instructors varchar(255), enrollment bigint,
    workflow_state varchar(40)""",
)
def courses(mart: Mart, exact_enrollment: bool = False) -> DataFrame:
    """Published and unpublished courses of known accounts.

    The catalog columns have no source among the raw tables and stay NULL; they are part of the table so that catalog
    data can be filled in. The enrolment count is at least 1 unless ``exact_enrollment``.
    """
    named_terms = mart.aux("Terms").where(none_of("term_name", mart.settings.excluded_term_names))
    term_days = mart.raw("enrollment_term_dim").join(
        named_terms.select("term_id", "term_name"), F.col("id") == F.col("term_id")
    )
    base = (
        mart.raw("account_dim")
        .select(F.col("id").alias("account_id"))
        .join(mart.raw("course_dim").where(is_one_of("workflow_state", ("claimed", "available"))), "account_id")
        .select(
            "account_id",
            F.col("id").alias("course_id"),
            "enrollment_term_id",
            F.col("name").alias("course_name"),
            "code",
            "workflow_state",
            F.lit(None).cast("string").alias("quarter_name_peoplesoft"),
        )
    )
    enrolled = count_matches_outer(base, mart.raw("enrollment_dim"), "course_id", exact_enrollment)
    in_quarter = enrich_left(
        base,
        term_days,
        {"enrollment_term_id": "id"},
        {"quarter_name_canvas": "name", "date_end": "date_end", "term_name": "term_name"},
        spread_by=["course_id"],
    )
    with_account = enrich_left(
        in_quarter, mart.aux("Accounts"), {"account_id": "account_id"}, {"account_name": "account_name"},
        spread_by=["course_id"],
    )
    with_enrollment = enrich_left(with_account, enrolled, {"course_id": "course_id"}, {"enrollment": "n"})
    return delete_where(
        with_enrollment,
        F.col("quarter_name_peoplesoft") != F.substring_index("quarter_name_canvas", " ", 1),
    )


def teachable_courses(mart: Mart) -> DataFrame:
    """Available courses outside the excluded terms."""
    return mart.raw("course_dim").where(
        same_text("workflow_state", "available") & ~F.col("enrollment_term_id").isin(*mart.settings.excluded_term_ids)
    )


@auxiliary_table(
    "CourseInstructor",
    """user_id bigint, course_id bigint, enrollment_term_id bigint, instructor_name varchar(255),
    course_name varchar(255), enrollment_term_name varchar(50)""",
)
def course_instructor(mart: Mart) -> DataFrame:
    # Course and term names are looked up once per course, before the courses meet their many enrolments.
    offered = enrich_left(
        teachable_courses(mart).select(F.col("id").alias("course_id"), "enrollment_term_id"),
        mart.raw("course_dim"),
        {"course_id": "id"},
        {"course_name": "name"},
    )
    offered = enrich_left(
        offered,
        mart.raw("enrollment_term_dim"),
        {"enrollment_term_id": "id"},
        {"enrollment_term_name": "name"},
    )
    teaching = (
        mart.raw("enrollment_dim")
        .where(same_text("workflow_state", "active") & same_text("type", "TeacherEnrollment"))
        .select("user_id", "course_id")
    )
    return join_distinct(
        offered.join(teaching, "course_id"), mart.aux("Instructors"), "user_id", spread_by=["course_id"]
    )


@auxiliary_table("CourseInstructorTeams", "course_id bigint, enrollment_term_id bigint, instructor_team text")
def course_instructor_teams(mart: Mart) -> DataFrame:
    return (
        mart.aux("CourseInstructor")
        .groupBy("course_id", "enrollment_term_id")
        .agg(join_names("instructor_name").alias("instructor_team"))
    )


@auxiliary_table(
    "CourseEnrollment",
    """course_id bigint, account_id bigint, enrollmentid bigint, enrollment_term_id bigint,
    enrollment_term_name varchar(50), course_name varchar(256), course_code varchar(256), course_section_id bigint,
    start_at timestamp, enrollment_type varchar(256), user_id bigint, instructor_team text""",
)
def course_enrollment(mart: Mart) -> DataFrame:
    on_course_and_term = {"course_id": "course_id", "enrollment_term_id": "enrollment_term_id"}
    offered = teachable_courses(mart).select(
        F.col("id").alias("course_id"),
        "account_id",
        "enrollment_term_id",
        F.col("name").alias("course_name"),
        F.col("code").alias("course_code"),
        "start_at",
    )
    # Both lookups depend on the course only, so they happen before the enrolments multiply the rows.
    offered = enrich_left(
        offered, mart.aux("CourseInstructor"), on_course_and_term, {"enrollment_term_name": "enrollment_term_name"}
    )
    offered = enrich_left(
        offered, mart.aux("CourseInstructorTeams"), on_course_and_term, {"instructor_team": "instructor_team"}
    )
    taken = (
        mart.raw("enrollment_dim")
        .where(same_text("workflow_state", "active"))
        .select(
            F.col("id").alias("enrollmentid"), "course_id", "course_section_id", F.col("type").alias("enrollment_type"),
            "user_id",
        )
    )
    return offered.join(taken, "course_id")
