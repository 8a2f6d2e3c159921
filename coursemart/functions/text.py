"""Text functions. All are native expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _folded(c: Column | str) -> Column:
    return F.lower(F.rtrim(_column(c)))


def same_text(c: Column | str, literal: str) -> Column:
    """Equality that ignores case and trailing spaces, as the source tables' collation does."""
    return _folded(c) == literal.rstrip(" ").lower()


def is_one_of(c: Column | str, literals: Iterable[str]) -> Column:
    return _folded(c).isin([text.rstrip(" ").lower() for text in literals])


def none_of(c: Column | str, literals: Iterable[str]) -> Column:
    """``NOT IN``: a NULL value is neither in nor out, so a filter drops it."""
    return ~is_one_of(c, literals)


def collated(c: Column | str) -> Column:
    """The column under full case-, accent- and trailing-space-insensitive Unicode comparison."""
    return F.collate(_column(c), "UNICODE_CI_AI_RTRIM")


def wordcount(c: Column | str, exact: bool = False) -> Column:
    """Number of alphanumeric runs; 0 for NULL.

    The source routine never looks at the last character, so a one-character word at the very end is missed. ``exact``
    counts that one too.
    """
    text = _column(c)
    looked_at = text if exact else F.left(text, F.length(text) - 1)
    return F.coalesce(F.regexp_count(looked_at, F.lit(r"[\p{L}\p{N}]+")), F.lit(0))


def replace_spaces(c: Column | str) -> Column:
    return F.replace(_column(c), F.lit(" "), F.lit(""))


def find_in_set_flag(tag: str, comma_list: Column | str) -> Column:
    """1 when ``tag`` is an element of the comma list after all spaces are taken out of the list, else 0.

    Because the list loses its spaces and the tag does not, a tag holding a space never matches. Case is ignored, as in
    every comparison of the source tables. NULL lists give 0.
    """
    elements = F.lower(replace_spaces(comma_list))
    return F.when(F.find_in_set(F.lit(tag.lower()), elements) > 0, 1).otherwise(0)


def join_names(column: str, sep: str = ", ") -> Column:
    """Aggregate: the distinct non-NULL values in ascending order, joined; NULL when there is none."""
    return F.expr(f"listagg(DISTINCT `{column}`, '{sep}') WITHIN GROUP (ORDER BY `{column}`)")


def sanitize_text(c: Column | str) -> Column:
    """Embedded tabs become eight spaces and line feeds one space."""
    return F.replace(F.replace(_column(c), F.lit("\t"), F.lit(" " * 8)), F.lit("\n"), F.lit(" "))


def cap_list(items: Column | str, limit: int = 10, sep: str = ", ", more: str = "...") -> Column:
    """Join at most ``limit`` items; longer lists end in ``more``."""
    values = _column(items)
    return F.concat(
        F.array_join(F.slice(values, 1, limit), sep),
        F.when(F.size(values) > limit, more).otherwise(""),
    )
