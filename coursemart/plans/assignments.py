"""Assignments, quizzes and submissions."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.text import same_text
from coursemart.operators import anti_join_append, delete_where, enrich_left, enrich_per_key
from coursemart.plans.registry import Mart, auxiliary_table


@auxiliary_table(
    "AssignmentSubmissions",
    """account_id bigint, course_id bigint, course_name varchar(255), term_name varchar(60), submission_id bigint,
    assignment_id bigint, assignment_name varchar(255), assignment_description text, quiz_submission_id bigint,
    grader_id bigint, user_id bigint, enrollment_term_id bigint, assignment_group_id bigint, grade_letter varchar(255),
    grade_numeric double, points_possible double, submitted_at timestamp, graded_at timestamp, grade_state char(36),
    excused char(36), student_name varchar(255)""",
)
def assignment_submissions(mart: Mart) -> DataFrame:
    graded = (
        mart.raw("submission_fact")
        .where(~F.col("enrollment_term_id").isin(*mart.settings.excluded_term_ids))
        .select(
            "submission_id", "assignment_id", "account_id", "course_id", "enrollment_term_id", "assignment_group_id",
            F.col("published_score").alias("grade_numeric"),
        )
    )
    rows = (
        mart.raw("submission_dim")
        .withColumnsRenamed({"id": "submission_id", "published_grade": "grade_letter"})
        .join(graded, ["submission_id", "assignment_id"])
    )
    rows = enrich_left(
        rows, mart.aux("Students"), {"user_id": "user_id"}, {"student_name": "student_name"}, spread_by=["submission_id"]
    )
    # The other lookups depend on assignment, course and term alone, of which there are far fewer than submissions. They come
    # last, so that the descriptions are not carried through another shuffle.
    return enrich_per_key(rows, ["assignment_id", "course_id", "enrollment_term_id"], partial(_described, mart), graded)


def _described(mart: Mart, keys: DataFrame) -> DataFrame:
    """Names, points and description for (assignment_id, course_id, enrollment_term_id)."""
    named = enrich_left(
        keys,
        mart.raw("course_dim"),
        {"enrollment_term_id": "enrollment_term_id", "course_id": "id"},
        {"course_name": "name"},
    )
    named = enrich_left(named, mart.aux("Terms"), {"enrollment_term_id": "term_id"}, {"term_name": "term_name"})
    rated = enrich_left(
        named,
        mart.raw("assignment_fact"),
        {"assignment_id": "assignment_id", "course_id": "course_id"},
        {"points_possible": "points_possible"},
    )
    return enrich_left(
        rated,
        mart.raw("assignment_dim"),
        {"assignment_id": "id" if mart.settings.key_fix else "assignment_group_id"},
        {"assignment_name": "title", "assignment_description": "description"},
        order_by=["id"],
    )


@auxiliary_table(
    "QuizDimFact",
    """id bigint, quiz_type varchar(256), name varchar(256), due_at timestamp, assignment_id bigint,
    points_possible double, time_limit int, allowed_attempts int, course_id bigint""",
    in_build=False,
)
def quiz_dim_fact(mart: Mart) -> DataFrame:
    facts = mart.raw("quiz_fact").select(
        "quiz_id", "course_id", "points_possible", "time_limit", "allowed_attempts"
    )
    return (
        mart.raw("quiz_dim")
        .where(same_text("workflow_state", "published"))
        .join(facts, F.col("id") == F.col("quiz_id"), "left")
    )


def course_facts(mart: Mart) -> DataFrame:
    """(course_id, course_name, account_id, offending, term_name), one row per course.

    Name and account come from an available row of the course; ``offending`` says that it has a row in another state.
    """
    available = same_text("workflow_state", "available")
    per_course = (
        mart.raw("course_dim")
        .groupBy(F.col("id").alias("course_id"))
        .agg(
            F.min(
                F.when(
                    available,
                    F.struct(
                        F.col("name").isNull().alias("no_name"), "name",
                        F.col("account_id").isNull().alias("no_account"), "account_id",
                    ),
                )
            ).alias("_named"),
            F.bool_or(~available).alias("offending"),
        )
    )
    return enrich_left(
        per_course.select(
            "course_id",
            F.col("_named.name").alias("course_name"),
            F.col("_named.account_id").alias("account_id"),
            "offending",
        ),
        mart.aux("Courses"),
        {"course_id": "course_id"},
        {"term_name": "term_name"},
    )


@auxiliary_table(
    "CourseAssignments",
    """account_id bigint, course_id bigint, course_name varchar(255), term_name varchar(60), assignment_id bigint,
    assignment_group_id bigint, assignment_name varchar(255), submission_types varchar(255), points_possible double,
    grading_type varchar(255), due_at timestamp, quiz_id bigint, quiz_type varchar(30), quiz_name varchar(255),
    quiz_assignment_id bigint, quiz_time_limit int, quiz_allowed_attempts int, group_assignment_name varchar(255),
    group_assignment_weight double, current_score double, final_score double""",
)
def course_assignments(mart: Mart) -> DataFrame:
    groups = mart.raw("assignment_group_dim").select(
        F.col("id").alias("assignment_group_id"), "course_id", F.col("name").alias("group_assignment_name")
    )
    published = (
        mart.raw("assignment_dim")
        .where(same_text("workflow_state", "published"))
        .select(
            F.col("id").alias("assignment_id"), "course_id", "assignment_group_id",
            F.col("title").alias("assignment_name"), "submission_types", "points_possible", "grading_type",
        )
        .join(groups, ["assignment_group_id", "course_id"])
    )
    quizzes = mart.aux("QuizDimFact")
    quiz_columns = {
        "quiz_id": "id",
        "quiz_type": "quiz_type",
        "quiz_name": "name",
        "due_at": "due_at",
        "quiz_time_limit": "time_limit",
        "quiz_allowed_attempts": "allowed_attempts",
    }
    with_quiz = enrich_left(
        published,
        quizzes,
        {"course_id": "course_id"},
        {**quiz_columns, "quiz_assignment_id": "assignment_id"},
        order_by=["id"],
        spread_by=["assignment_id"],
    )
    # Quizzes of courses without a published assignment become rows of their own.
    rows = anti_join_append(
        with_quiz,
        quizzes,
        {"course_id": "course_id"},
        {**quiz_columns, "points_possible": "points_possible", "course_id": "course_id"},
    )
    row_id = ["assignment_id", "quiz_id"]
    # Everything that depends on the course alone comes from one lookup, instead of one join per column.
    rows = enrich_left(
        rows,
        course_facts(mart),
        {"course_id": "course_id"},
        {c: c for c in ("course_name", "account_id", "term_name", "offending")},
        spread_by=row_id,
    )
    rows = delete_where(rows, F.col("offending"))
    rows = enrich_left(
        rows,
        mart.raw("assignment_group_score_fact"),
        {"assignment_group_id": "assignment_group_id", "course_id": "course_id"},
        {"current_score": "current_score", "final_score": "final_score"},
        order_by=["score_id"],
        spread_by=row_id,
    )
    return enrich_left(
        rows,
        mart.raw("assignment_group_fact"),
        {"assignment_group_id" if mart.settings.key_fix else "assignment_id": "assignment_group_id"},
        {"group_assignment_weight": "group_weight"},
        spread_by=row_id,
    )
