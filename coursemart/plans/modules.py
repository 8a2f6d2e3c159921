"""Modules, module items and wikis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.text import same_text
from coursemart.operators import conditional_counts, enrich_left, left_join_large
from coursemart.plans.registry import Mart, auxiliary_table


def with_course_name(mart: Mart, df: DataFrame, row_id: list[str]) -> DataFrame:
    return enrich_left(
        df, mart.aux("Courses"), {"course_id": "course_id"}, {"course_name": "course_name"}, spread_by=row_id
    )


def with_term_name(mart: Mart, df: DataFrame, row_id: list[str]) -> DataFrame:
    return enrich_left(
        df, mart.aux("Terms"), {"enrollment_term_id": "term_id"}, {"term_name": "term_name"}, spread_by=row_id
    )


@auxiliary_table(
    "Modules",
    """id bigint, course_id bigint, course_name text, module_name text, account_id bigint, enrollment_term_id bigint,
    term_name varchar(20), wiki_id bigint, wiki_title text""",
)
def modules(mart: Mart) -> DataFrame:
    facts = mart.raw("module_fact").select("module_id", "account_id", "enrollment_term_id", "wiki_id")
    rows = (
        mart.raw("module_dim")
        .where(same_text("workflow_state", "active"))
        .select("id", "course_id", F.col("name").alias("module_name"))
        .join(facts, F.col("id") == F.col("module_id"), "left")
    )
    rows = with_course_name(mart, rows, ["id"])
    rows = enrich_left(rows, mart.raw("wiki_dim"), {"wiki_id": "id"}, {"wiki_title": "title"}, spread_by=["id"])
    return with_term_name(mart, rows, ["id"])


@auxiliary_table(
    "ModuleItems",
    """id bigint, title text, course_id bigint, module_id bigint, content_type varchar(50),
    requirement_type varchar(36), completion_status varchar(36), num_started bigint, num_completed bigint""",
)
def module_items(mart: Mart) -> DataFrame:
    requirements = mart.raw("module_progression_completion_requirement_dim").select(
        F.col("module_item_id").alias("id"), "requirement_type", "completion_status"
    )
    active = (
        mart.raw("module_item_dim")
        .where(same_text("workflow_state", "active"))
        .select("id", "title", "course_id", "module_id", "content_type")
    )
    # Every learner has a row per requirement of an item, so the requirements are by far the larger side.
    items = left_join_large(active, requirements, ["id"])
    # A progression counts once per fact row it has, and once if it has none.
    fact_rows = (
        mart.raw("module_progression_fact")
        .groupBy(F.col("module_progression_id").alias("_progression"))
        .agg(F.count("*").alias("_rows"))
    )
    progressions = enrich_left(
        mart.raw("module_progression_dim")
        .where(same_text("workflow_state", "started") | same_text("workflow_state", "completed"))
        .select("id", "module_id", "workflow_state"),
        fact_rows,
        {"id": "_progression"},
        {"_rows": "_rows"},
    )
    progress = conditional_counts(
        progressions.withColumn("_weight", F.coalesce("_rows", F.lit(1))),
        "module_id",
        {
            "num_started": same_text("workflow_state", "started"),
            "num_completed": same_text("workflow_state", "completed"),
        },
        weight="_weight",
    )
    counts = {"num_started": "num_started", "num_completed": "num_completed"}
    return enrich_left(items, progress, {"module_id": "module_id"}, counts, spread_by=["id"])


@auxiliary_table(
    "Wikis",
    """wiki_id bigint, account_id bigint, course_id bigint, course_name text, enrollment_term_id bigint,
    term_name varchar(30), wiki_title text, wiki_type varchar(10)""",
)
def wikis(mart: Mart) -> DataFrame:
    described = mart.raw("wiki_dim").select(
        "id", F.col("title").alias("wiki_title"), F.col("parent_type").alias("wiki_type")
    )
    rows = (
        mart.raw("wiki_fact")
        .select("wiki_id", "account_id", F.col("parent_course_id").alias("course_id"), "enrollment_term_id")
        .join(described, F.col("wiki_id") == F.col("id"), "left")
    )
    return with_term_name(mart, with_course_name(mart, rows, ["wiki_id"]), ["wiki_id"])


@auxiliary_table(
    "WikiPages",
    """wiki_page_id bigint, wiki_id bigint, course_id bigint, course_name text, wiki_page_title text, view_count int,
    editing_roles varchar(60)""",
)
def wiki_pages(mart: Mart) -> DataFrame:
    pages = (
        mart.raw("wiki_page_dim")
        .where(same_text("workflow_state", "active"))
        .select("id", F.col("title").alias("wiki_page_title"), "editing_roles")
    )
    rows = (
        mart.raw("wiki_page_fact")
        .select("wiki_page_id", "wiki_id", F.col("parent_course_id").alias("course_id"), "view_count")
        .join(pages, F.col("wiki_page_id") == F.col("id"))
    )
    return with_course_name(mart, rows, ["wiki_page_id"])
