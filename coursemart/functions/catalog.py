"""Fields of one course-catalog record, from the nested columns that the XML source yields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coursemart.functions.text import cap_list

# Fixed values of the catalog format.
QUARTER_ATTRIBUTE = "NQTR"
NO_QUARTER = '""'
NO_INSTRUCTOR = "None listed"
INSTRUCTOR_LIMIT = 10


def course_code(subject: Column, code: Column) -> Column:
    return F.concat(subject, code)


def person_name(person: Column) -> Column:
    """``first[ middle] last`` from a struct(firstName, middleName, lastName); missing parts are empty."""
    middle = F.coalesce(person["middleName"], F.lit(""))
    return F.concat(
        F.coalesce(person["firstName"], F.lit("")),
        F.when(middle != "", F.concat(F.lit(" "), middle)).otherwise(""),
        F.lit(" "),
        F.coalesce(person["lastName"], F.lit("")),
    )


def instructor_list(people: Column) -> Column:
    """Names of all instructors, repeated names included; after ten of them an ellipsis."""
    names = F.transform(people, person_name)
    return F.when(F.coalesce(F.size(people), F.lit(0)) > 0, cap_list(names, INSTRUCTOR_LIMIT)).otherwise(
        NO_INSTRUCTOR
    )


def quarter_names(attributes: Column) -> Column:
    """Comma-joined quarters in which the course is given, ``Autumn`` spelled ``Fall``."""
    quarters = F.transform(
        F.filter(attributes, lambda a: (a["name"] == QUARTER_ATTRIBUTE) & a["description"].isNotNull()),
        lambda a: F.when(a["description"] == "Autumn", "Fall").otherwise(a["description"]),
    )
    return F.coalesce(F.nullif(F.array_join(quarters, ","), F.lit("")), F.lit(NO_QUARTER))
