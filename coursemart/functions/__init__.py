from coursemart.functions.calendar import date_in_quarter, quarter_lower_date, quarter_upper_date, utc_to_local_text
from coursemart.functions.catalog import course_code, instructor_list, person_name, quarter_names
from coursemart.functions.names import (
    parse_snapshot_name,
    qualified_db_name,
    qualified_table_name,
    term_year,
)
from coursemart.functions.sql import register_sql_functions
from coursemart.functions.text import (
    cap_list,
    collated,
    find_in_set_flag,
    is_one_of,
    join_names,
    none_of,
    replace_spaces,
    same_text,
    sanitize_text,
    wordcount,
)

__all__ = [
    "cap_list",
    "collated",
    "course_code",
    "date_in_quarter",
    "find_in_set_flag",
    "instructor_list",
    "is_one_of",
    "join_names",
    "none_of",
    "parse_snapshot_name",
    "person_name",
    "qualified_db_name",
    "qualified_table_name",
    "quarter_lower_date",
    "quarter_names",
    "quarter_upper_date",
    "register_sql_functions",
    "replace_spaces",
    "same_text",
    "sanitize_text",
    "term_year",
    "utc_to_local_text",
    "wordcount",
]
