"""Raw star-schema tables: declared columns and readers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType, TimestampNTZType

# The raw columns the tables below are built from, all nullable.
RAW_COLUMNS = {
    "account_dim": "id bigint, name string",
    "assignment_dim": (
        "id bigint, course_id bigint, assignment_group_id bigint, title string, description string, "
        "submission_types string, points_possible double, grading_type string, workflow_state string"
    ),
    "assignment_fact": "assignment_id bigint, course_id bigint, points_possible double",
    "assignment_group_dim": "id bigint, course_id bigint, name string",
    "assignment_group_fact": "assignment_group_id bigint, course_id bigint, group_weight double",
    "assignment_group_score_fact": (
        "score_id bigint, assignment_group_id bigint, course_id bigint, current_score double, final_score double"
    ),
    "course_dim": (
        "id bigint, account_id bigint, enrollment_term_id bigint, name string, code string, start_at timestamp_ntz, "
        "workflow_state string"
    ),
    "discussion_entry_fact": "discussion_entry_id bigint, topic_id bigint, user_id bigint",
    "discussion_topic_dim": (
        "id bigint, course_id bigint, title string, type string, posted_at timestamp_ntz, workflow_state string"
    ),
    "discussion_topic_fact": "discussion_topic_id bigint, user_id bigint, message_length int",
    "enrollment_dim": (
        "id bigint, course_section_id bigint, role_id bigint, course_id bigint, user_id bigint, type string, "
        "workflow_state string"
    ),
    "enrollment_term_dim": "id bigint, name string, date_start timestamp_ntz, date_end timestamp_ntz",
    "module_dim": "id bigint, course_id bigint, name string, workflow_state string",
    "module_fact": "module_id bigint, account_id bigint, enrollment_term_id bigint, wiki_id bigint",
    "module_item_dim": (
        "id bigint, title string, course_id bigint, module_id bigint, content_type string, workflow_state string"
    ),
    "module_progression_completion_requirement_dim": (
        "id bigint, module_item_id bigint, requirement_type string, completion_status string"
    ),
    "module_progression_dim": "id bigint, module_id bigint, workflow_state string",
    "module_progression_fact": "module_progression_id bigint",
    "quiz_dim": (
        "id bigint, assignment_id bigint, name string, quiz_type string, workflow_state string, due_at timestamp_ntz"
    ),
    "quiz_fact": (
        "quiz_id bigint, course_id bigint, points_possible double, time_limit int, allowed_attempts int"
    ),
    "role_dim": "id bigint, name string",
    "submission_dim": (
        "id bigint, assignment_id bigint, grader_id bigint, quiz_submission_id bigint, user_id bigint, "
        "published_grade string, submitted_at timestamp_ntz, graded_at timestamp_ntz, grade_state string, "
        "excused string"
    ),
    "submission_fact": (
        "submission_id bigint, assignment_id bigint, course_id bigint, enrollment_term_id bigint, account_id bigint, "
        "assignment_group_id bigint, published_score double"
    ),
    "user_dim": "id bigint, name string",
    "wiki_dim": "id bigint, title string, parent_type string",
    "wiki_fact": "wiki_id bigint, account_id bigint, parent_course_id bigint, enrollment_term_id bigint",
    "wiki_page_dim": "id bigint, title string, editing_roles string, workflow_state string",
    "wiki_page_fact": "wiki_page_id bigint, wiki_id bigint, parent_course_id bigint, view_count int",
}


def raw_schema(name: str) -> StructType:
    return StructType.fromDDL(RAW_COLUMNS[name])


def read_table(spark: SparkSession, location: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A whole table from files (``parquet``, ``orc``, ...), the catalog (``table``) or a database (``jdbc``).

    For ``jdbc`` the location is the table name and ``options`` hold the connection; pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` so that the read is split over the cluster.
    """
    if fmt == "table":
        return spark.read.table(location)
    reader = spark.read.format(fmt).options(**options)
    return reader.option("dbtable", location).load() if fmt == "jdbc" else reader.load(location)


def _typed(c: Column, kind: DataType, is_text: bool) -> Column:
    """``c`` in a declared type where it can be, else NULL; all-zero dates are NULL."""
    if not is_text:
        return c.cast(kind)
    if isinstance(kind, TimestampNTZType):
        return F.try_to_timestamp(c).cast(kind)
    return c.try_cast(kind)


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "string"


#: A date or time of nothing but zeros, which stands for a missing one.
_ZERO_DATE = r"^[0:. T/-]*$"


def _unreadable(df: DataFrame, field) -> Column:
    """Whether a column holds text that is neither of its declared type nor a zero date."""
    c = F.col(field.name)
    if not _is_text(df, field.name) or isinstance(field.dataType, StringType):
        return F.lit(False)
    missing = c.rlike(_ZERO_DATE) & (c != "") if isinstance(field.dataType, (TimestampNTZType, DateType)) else F.lit(False)
    return c.isNotNull() & ~missing & _typed(c, field.dataType, True).isNull()


def clean_zero_dates(df: DataFrame, schema: StructType) -> DataFrame:
    """Bring columns to the declared types; all-zero dates become NULL, and other text that is not of its type is an error.

    ``unreadable_values`` lists such text instead.
    """

    def typed(field):
        value = _typed(F.col(field.name), field.dataType, _is_text(df, field.name))
        message = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), F.col(field.name).cast("string"))
        checked = F.when(_unreadable(df, field), F.raise_error(message).cast(field.dataType)).otherwise(value)
        return checked.alias(field.name)

    return df.select(*(typed(field) for field in schema))


def unreadable_values(df: DataFrame, schema: StructType) -> DataFrame:
    """(column_name, value, n) of text that ``clean_zero_dates`` would refuse; empty means the table is fine."""
    found = [
        F.when(_unreadable(df, f), F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("value")))
        for f in schema
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*found))).alias("_v"))
    return rows.groupBy("_v.column_name", "_v.value").agg(F.count("*").alias("n"))


def read_raw(spark: SparkSession, name: str, location: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A raw table with its declared columns and types only."""
    return clean_zero_dates(read_table(spark, location, fmt, **options), raw_schema(name))


def read_excerpt(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """A headerless comma-separated table dump with optional quotes, backslash escapes and ``\\N`` for NULL.

    Records end with a line feed. Text may hold line breaks, so a file is read by one task; for dumps without any,
    ``multi_line=False`` lets a large file be split between many. A record with too few or too many values, and text that is not of its
    column's type, is an error; all-zero dates are NULL.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = StructType([StructField(f.name, StringType()) for f in declared])
    found = (
        spark.read.schema(texts)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", "\\")
        .option("nullValue", "\\N")
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .option("lineSep", "\n")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return clean_zero_dates(found, declared)


class LmsSource:
    """Where raw tables come from: a mapping of table name to DataFrame or to a function returning one."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._tables = dict(tables)

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, fmt: str = "parquet", suffix: str = "", **options: str):
        """Every declared raw table as ``folder/<name><suffix>``, opened when it is first asked for."""
        return cls(
            {
                name: (lambda name=name: read_raw(spark, name, f"{folder}/{name}{suffix}", fmt, **options))
                for name in RAW_COLUMNS
            }
        )

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str):
        return cls(
            {name: (lambda name=name: read_raw(spark, name, f"{database}.{name}", "table")) for name in RAW_COLUMNS}
        )

    @classmethod
    def from_jdbc(
        cls, spark: SparkSession, partitions: Mapping[str, Mapping[str, str]] | None = None, **options: str
    ):
        """All raw tables of one database. ``partitions`` gives each large table its own ``partitionColumn``,
        ``lowerBound``, ``upperBound`` and ``numPartitions``; a table without them is read by one task."""
        split = partitions or {}
        return cls(
            {
                name: (lambda name=name: read_raw(spark, name, name, "jdbc", **{**options, **split.get(name, {})}))
                for name in RAW_COLUMNS
            }
        )

    def __contains__(self, name: str) -> bool:
        return name in self._tables

    def __getitem__(self, name: str) -> DataFrame:
        found = self._tables[name]
        if not isinstance(found, DataFrame):
            found = self._tables[name] = found()
        return found
