"""Student units and the degree requirements a course fills; the catalog table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.functions.text import replace_spaces
from coursemart.operators import keep_min_per_key, left_join_large
from coursemart.plans.registry import Mart, auxiliary_table
from coursemart.sources.catalog import catalog_rows

# Flag column and the requirement it stands for.
REQUIREMENTS = {
    "EC_EthicReas": "GER:EC-EthicReas",
    "WAY_ER": "WAY-ER",
    "WAY_FR": "WAY-FR",
    "DB_EngrAppSci": "GER:DB-EngrAppSci",
    "WAY_SMA": "WAY-SMA",
    "DB_NatSci": "GER:DB-NatSci",
    "DB_SocSci": "GER:DB-SocSci",
    "WAY_ED": "WAY-ED",
    "WAY_SI": "WAY-SI",
    "DB_Hum": "GER:DB-Hum",
    "Language": "Language",
    "WAY_A_II": "WAY-A-II",
    "WAY_CE": "WAY-CE",
    "EC_GlobalCom": "GER:EC-GlobalCom",
    "WAY_AQR": "WAY-AQR",
    "DB_Math": "GER:DB-Math",
    "EC_Gender": "GER:EC-Gender",
    "EC_AmerCul": "GER:EC-AmerCul",
    "Writing_2": "Writing 2",
    "Writing_1": "Writing 1",
    "THINK": "THINK",
    "IHUM_1": "GER:IHUM-1",
    "Writing_SLE": "Writing SLE",
}

FLAG_COLUMNS = (
    "course_name varchar(255), course_id bigint, stanford_course_id int, quarter_name_canvas varchar(30), "
    + ", ".join(f"{flag} tinyint" for flag in REQUIREMENTS)
)


@auxiliary_table(
    "StudentUnits",
    """account_id bigint, account_name varchar(255), enrollment_term_id bigint, quarter_name_canvas varchar(16),
    quarter_name_peoplesoft varchar(40), term_start timestamp, course_id bigint, course_name varchar(255),
    instructors varchar(255), units_max int, enrollment int""",
)
def student_units(mart: Mart) -> DataFrame:
    taught = mart.aux("Courses").select(
        "account_id", "enrollment_term_id", "quarter_name_canvas", "quarter_name_peoplesoft", "course_id",
        "course_name", "instructors", "units_max", "enrollment",
    )
    return left_join_large(mart.aux("Accounts"), taught, ["account_id"])


def requirement_flags(comma_list: str) -> list[Column]:
    """One 0/1 column per requirement. The list is split once per row and shared by all of them.

    Spaces are taken out of the list but not out of the requirement, so those with a space in their name never match.
    """
    elements = F.split(F.lower(replace_spaces(comma_list)), ",")
    return [
        F.when(F.array_contains(elements, tag.lower()), 1).otherwise(0).alias(flag)
        for flag, tag in REQUIREMENTS.items()
    ]


@auxiliary_table("RequirementsFill", FLAG_COLUMNS)
def requirements_fill(mart: Mart) -> DataFrame:
    return mart.aux("Courses").select(
        "course_name", "course_id", "stanford_course_id", "quarter_name_canvas", *requirement_flags("ger_fulfillment")
    )


@auxiliary_table("RequirementsFillUniq", FLAG_COLUMNS)
def requirements_fill_uniq(mart: Mart) -> DataFrame:
    return keep_min_per_key(
        mart.aux("RequirementsFill"), ["stanford_course_id", "quarter_name_canvas"], "course_id"
    )


@auxiliary_table(
    "ExploreCourses",
    """course_code varchar(15), subject varchar(15), course_name varchar(255), units_min int, units_max int,
    acad_year varchar(25), course_id int, acad_group varchar(25), department varchar(40), acad_career varchar(10),
    ger_fulfillment varchar(255), quarter_name varchar(40), instructors varchar(255)""",
)
def explore_courses(mart: Mart) -> DataFrame:
    """The catalog; the source supplies it as ``catalog`` (CSV rows) or ``catalog_xml`` (nested records)."""
    if "catalog" in mart.source:
        return mart.raw("catalog")
    return catalog_rows(mart.raw("catalog_xml"))
