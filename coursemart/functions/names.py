"""Functions on table, snapshot and term names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date part of a snapshot name, with optional fraction of a second.
SNAPSHOT_DATE_PATTERN = r"\d{4}(?:_\d{2}){5}_?\d*$"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qualified_db_name(name: Column | str, current: str) -> Column:
    """The part before the first ``.``, or ``current`` for a bare name."""
    text = _column(name)
    return F.when(F.instr(text, ".") == 0, F.lit(current)).otherwise(F.substring_index(text, ".", 1))


def qualified_table_name(name: Column | str) -> Column:
    """The part after the first ``.``, or the whole of a bare name."""
    text = _column(name)
    return F.substring(text, F.instr(text, ".") + F.lit(1), F.length(text))


def parse_snapshot_name(name: Column | str, roots: Iterable[str]) -> Column:
    """``<root>_<date>`` -> struct(root, date_text, taken_at); all NULL unless the root is known and the date is real.

    The root need not start the name: an unknown prefix before a known root is ignored.
    """
    text = _column(name)
    known = "|".join(re.escape(root) for root in roots)
    pattern = f"({known})_({SNAPSHOT_DATE_PATTERN})"
    root = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    date_text = F.regexp_extract(text, pattern, 2)
    # One to six fraction digits are allowed, with their own underscore.
    well_formed = date_text.rlike(r"^\d{4}(_\d{2}){5}(_\d{1,6})?$")
    taken_at = F.when(
        well_formed, F.try_to_timestamp(date_text, F.lit("yyyy_MM_dd_HH_mm_ss[_SSSSSS]"))
    ).cast("timestamp_ntz")
    valid = root.isNotNull() & taken_at.isNotNull()
    return F.struct(
        F.when(valid, root).alias("root"),
        F.when(valid, date_text).alias("date_text"),
        F.when(valid, taken_at).alias("taken_at"),
    )


def term_year(term_name: Column | str) -> Column:
    """The year at the end of a term name such as ``Winter 2016``; 0 when the last word is no number."""
    last_word = F.substring_index(_column(term_name), " ", -1)
    return F.when(_column(term_name).isNotNull(), F.coalesce(last_word.try_cast("int"), F.lit(0)))
