"""Discussion topics and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.functions.text import same_text
from coursemart.operators import count_pairs_by_key, enrich_left
from coursemart.plans.people import enrolled_users
from coursemart.plans.registry import Mart, auxiliary_table


def active_topics(mart: Mart) -> DataFrame:
    """Active topics with the columns of their course; NULLs where the course is unknown."""
    course = mart.raw("course_dim").select(
        F.col("id").alias("_course"), F.col("name").alias("course_name"), F.col("code").alias("course_code"),
        F.col("start_at").alias("course_start"), F.col("enrollment_term_id").alias("course_enrollment_term_id"),
        F.col("account_id").alias("course_account_id"),
    )
    topic = (
        mart.raw("discussion_topic_dim")
        .where(same_text("workflow_state", "active"))
        .select(F.col("id").alias("topic_id"), "title", "type", "posted_at", "course_id")
    )
    return topic.join(course, F.col("course_id") == F.col("_course"), "left").drop("_course")


@auxiliary_table(
    "DiscussionMessages",
    """disc_title varchar(256), disc_author_id bigint, disc_author_role varchar(40), disc_posted_at timestamp,
    disc_course_id bigint, disc_course_name varchar(255), disc_course_code varchar(100),
    disc_course_start_date timestamp, disc_id bigint, disc_type varchar(20)""",
)
def discussion_messages(mart: Mart) -> DataFrame:
    messages = active_topics(mart).select(
        F.col("title").alias("disc_title"), F.col("posted_at").alias("disc_posted_at"),
        F.col("course_id").alias("disc_course_id"), F.col("course_name").alias("disc_course_name"),
        F.col("course_code").alias("disc_course_code"), F.col("course_start").alias("disc_course_start_date"),
        F.col("topic_id").alias("disc_id"), F.col("type").alias("disc_type"),
    )
    messages = enrich_left(
        messages,
        mart.raw("discussion_entry_fact"),
        {"disc_id": "topic_id" if mart.settings.key_fix else "discussion_entry_id"},
        {"disc_author_id": "user_id"},
        order_by=["discussion_entry_id"],
        spread_by=["disc_id"],
    )
    return enrich_left(
        messages,
        mart.raw("enrollment_dim"),
        {"disc_author_id": "user_id"},
        {"disc_author_role": "type"},
        order_by=["id"],
        spread_by=["disc_id"],
    )


@auxiliary_table(
    "DiscussionTopics",
    """disc_topic_id bigint, disc_topic_author_id bigint, disc_topic_author_name varchar(255),
    disc_topic_author_role varchar(40), disc_topic_title varchar(256), course_enrollment_term_id bigint,
    course_account_id bigint, disc_topic_msg_length int, disc_topic_posted_at timestamp, course_id bigint,
    course_name varchar(255), course_code varchar(100), catnbr varchar(20), disc_topic_course_start_date timestamp,
    disc_topic_type varchar(20), disc_topic_num_contribs bigint""",
)
def discussion_topics(mart: Mart) -> DataFrame:
    topics = active_topics(mart).select(
        F.col("topic_id").alias("disc_topic_id"), F.col("title").alias("disc_topic_title"),
        "course_enrollment_term_id", "course_account_id", F.col("posted_at").alias("disc_topic_posted_at"),
        "course_id", "course_name", "course_code", F.col("course_start").alias("disc_topic_course_start_date"),
        F.coalesce("type", F.lit("Discussion")).alias("disc_topic_type"),
    )
    row_id = ["disc_topic_id"]
    contributions = count_pairs_by_key(topics, "disc_topic_id", mart.raw("discussion_entry_fact"), "topic_id")
    topics = enrich_left(
        topics,
        mart.raw("discussion_topic_fact"),
        {"disc_topic_id": "discussion_topic_id"},
        {"disc_topic_author_id": "user_id", "disc_topic_msg_length": "message_length"},
        spread_by=row_id,
    )
    # The numbering of AllUsers only serves as tie rule, and it follows the enrolment id: no need to number anyone here.
    everyone, first = (
        (mart.built["AllUsers"], "seq_num") if "AllUsers" in mart.built else (enrolled_users(mart), "enrollment_id")
    )
    topics = enrich_left(
        topics,
        everyone,
        {"disc_topic_author_id": "user_id"},
        {"disc_topic_author_role": "role", "disc_topic_author_name": "name"},
        order_by=[first],
        spread_by=row_id,
    )
    topics = enrich_left(
        topics, mart.aux("Courses"), {"course_id": "course_id"}, {"catnbr": "course_code"}, spread_by=row_id
    )
    return enrich_left(
        topics, contributions, {"disc_topic_id": "topic_id"}, {"disc_topic_num_contribs": "n"}, spread_by=row_id
    )
