"""The same functions for SQL users, as temporary SQL functions that Catalyst expands in place."""

from __future__ import annotations

from pyspark.sql import SparkSession

from coursemart.functions.calendar import QUARTER_ENDS, QUARTER_STARTS


def _quarter_day(days: dict[str, tuple[int, int, int]]) -> str:
    branches = " ".join(
        f"WHEN '{name}' THEN make_date(academic_year + {later}, {month}, {day})"
        for name, (later, month, day) in days.items()
    )
    return f"CASE lower(rtrim(quarter)) {branches} END"


def _named(name: str, later: int) -> str:
    in_year = f"academic_year = '%' OR year(day) = TRY_CAST(academic_year AS INT) + {later}"
    return f"({in_year}) AND lower(quarter) = '{name}'"


# The names under which the functions are known, with their parameters and results.
SQL_FUNCTIONS = {
    "wordcount": (
        "str STRING",
        "INT",
        r"coalesce(regexp_count(left(str, length(str) - 1), r'[\p{L}\p{N}]+'), 0)",
    ),
    "dateInQuarter": (
        "day TIMESTAMP_NTZ, quarter STRING, academic_year STRING",
        "BOOLEAN",
        f"""CASE quarter(add_months(CAST(day AS DATE), 1))
                WHEN 4 THEN {_named("fall", 0)} WHEN 3 THEN {_named("summer", 1)} WHEN 2 THEN {_named("spring", 1)}
                ELSE CASE WHEN academic_year = '%' THEN lower(quarter) = 'winter'
                          WHEN month(day) = 12 THEN year(day) = TRY_CAST(academic_year AS INT)
                          ELSE year(day) = TRY_CAST(academic_year AS INT) + 1 END END""",
    ),
    "makeUpperQuarterDate": ("quarter STRING, academic_year INT", "DATE", _quarter_day(QUARTER_ENDS)),
    "makeLowQuarterDate": ("quarter STRING, academic_year INT", "DATE", _quarter_day(QUARTER_STARTS)),
    "DATABASE_NAME": (
        "table_name STRING",
        "STRING",
        "CASE WHEN instr(table_name, '.') = 0 THEN current_database() ELSE substring_index(table_name, '.', 1) END",
    ),
    "TABLE_BASENAME": ("table_name STRING", "STRING", "substring(table_name, instr(table_name, '.') + 1)"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to this session's SQL and return their names."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)
