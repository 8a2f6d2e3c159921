"""Accounts, terms and the people tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.text import same_text
from coursemart.operators import dense_sequence, enrich_left, restrict_to_keys
from coursemart.plans.registry import Mart, auxiliary_table

# What each enrolment type is called.
ROLE_OF_TYPE = {
    "TeacherEnrollment": "instructor",
    "StudentEnrollment": "student",
    "TaEnrollment": "TA",
    "DesignerEnrollment": "designer",
    "ObserverEnrollment": "observer",
}


@auxiliary_table("Accounts", "account_id bigint, account_name varchar(255)")
def accounts(mart: Mart) -> DataFrame:
    return mart.raw("account_dim").select(F.col("id").alias("account_id"), F.col("name").alias("account_name"))


@auxiliary_table("Terms", "term_id bigint, term_name varchar(60), start_date timestamp")
def terms(mart: Mart) -> DataFrame:
    return (
        mart.raw("enrollment_term_dim")
        .select(F.col("id").alias("term_id"), F.col("name").alias("term_name"), F.col("date_start").alias("start_date"))
        .distinct()
    )


def role_of_type(enrolment_type: str = "type"):
    """Role of an enrolment type; NULL for a type not listed."""
    role = F.lit(None).cast("string")
    for known, name in ROLE_OF_TYPE.items():
        role = F.when(same_text(enrolment_type, known), name).otherwise(role)
    return role


def enrolments(mart: Mart) -> DataFrame:
    """One row per enrolment: the table of all users before it is numbered and named."""
    return mart.raw("enrollment_dim").select(
        F.col("id").alias("enrollment_id"), "user_id", "type", role_of_type().alias("role"), "workflow_state"
    )


def with_user_name(rows: DataFrame, mart: Mart, spread_by: str) -> DataFrame:
    return enrich_left(rows, mart.raw("user_dim"), {"user_id": "id"}, {"name": "name"}, spread_by=[spread_by])


def enrolled_users(mart: Mart) -> DataFrame:
    return with_user_name(enrolments(mart), mart, "enrollment_id")


@auxiliary_table(
    "AllUsers",
    "seq_num bigint, user_id bigint, name varchar(255), type varchar(30), role varchar(30), workflow_state varchar(20)",
)
def all_users(mart: Mart) -> DataFrame:
    # Numbering comes before the names, so it moves narrow rows, and the names are joined once.
    return with_user_name(dense_sequence(enrolments(mart), ["enrollment_id"], "seq_num"), mart, "seq_num")


def people_in_role(mart: Mart, role: str, name_column: str, active_only: bool = True) -> DataFrame:
    """Distinct (user, name) of everyone who holds the role in some enrolment."""
    enrolments = mart.raw("enrollment_dim")
    if active_only:
        enrolments = enrolments.where(same_text("workflow_state", "active"))
    in_role = restrict_to_keys(
        enrolments.select("user_id", "role_id"), mart.raw("role_dim").where(same_text("name", role)), {"role_id": "id"}
    )
    users = mart.raw("user_dim").select(F.col("id").alias("_id"), F.col("name").alias(name_column))
    # Enrolments shrink to users before the join; a user with several names keeps them all.
    ids = in_role.select("user_id").distinct()
    return ids.join(users, F.col("user_id") == F.col("_id"), "left").select("user_id", name_column).distinct()


@auxiliary_table("Students", "user_id bigint, student_name varchar(255)")
def students(mart: Mart) -> DataFrame:
    return people_in_role(mart, "StudentEnrollment", "student_name")


@auxiliary_table("Instructors", "user_id bigint, instructor_name varchar(255)")
def instructors(mart: Mart) -> DataFrame:
    return people_in_role(mart, "TeacherEnrollment", "instructor_name", active_only=False)


@auxiliary_table("TeachingAssistants", "user_id bigint, ta_name varchar(255)")
def teaching_assistants(mart: Mart) -> DataFrame:
    return people_in_role(mart, "TAEnrollment", "ta_name")


@auxiliary_table("Graders", "user_id bigint, grader_name varchar(255)")
def graders(mart: Mart) -> DataFrame:
    return people_in_role(mart, "Grader", "grader_name")
