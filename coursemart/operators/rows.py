"""Operators that add, drop or compare rows: appends, deletes, key comparisons, unions of many sources."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.operators.enrich import join_winners, winner_per_key


def _filter_join(
    df: DataFrame, other: DataFrame, on: Mapping[str, str], how: str, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Semi or anti join against the distinct keys of ``other``: its hot keys collapse before they are shuffled."""
    keys = other.select(*(F.col(theirs).alias(f"_key{i}") for i, theirs in enumerate(on.values())))
    distinct_keys = winner_per_key(keys, keys.columns, [], slot=True)
    joined = join_winners(
        df, distinct_keys, dict(zip(on, keys.columns)), how, df.columns if spread_by is None else spread_by
    )
    return joined.select(*df.columns)


def left_join_large(df: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left outer join for a right side that is the large one or may have hot keys.

    Spark can split a hot key of the right side, or stream that side past a broadcast left one, in an inner join only. So
    the matches come from an inner join and the left rows without a match are appended.
    """
    matched = df.join(right, list(on))
    alone = _filter_join(df, right, {k: k for k in on}, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE ... WHERE predicate``: rows stay where the predicate is false or NULL."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_matching(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], predicate: Column) -> DataFrame:
    """``DELETE df FROM df LEFT JOIN lookup ... WHERE predicate(lookup)``: unmatched rows stay."""
    return _filter_join(df, lookup.where(predicate), on, "left_anti")


def anti_join_append(
    df: DataFrame, extra: DataFrame, on: Mapping[str, str], columns: Mapping[str, str]
) -> DataFrame:
    """Append the rows of ``extra`` whose key has no row in ``df``.

    ``on`` maps columns of ``extra`` to columns of ``df``; ``columns`` maps target columns to columns of ``extra``. The
    target columns not named become NULL.
    """
    leftovers = _filter_join(extra, df, on, "left_anti")
    return df.unionByName(
        leftovers.select(*(F.col(source).alias(target) for target, source in columns.items())),
        allowMissingColumns=True,
    )


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``."""
    return _filter_join(df, keys, on, "left_semi")


def missing_keys(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct expected keys that nothing present carries."""
    return _filter_join(expected.select(*on).distinct(), present, {k: k for k in on}, "left_anti")


def common_keys(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct expected keys that are present."""
    return _filter_join(expected.select(*on).distinct(), present, {k: k for k in on}, "left_semi")


def _like(name: str, pattern: str) -> bool:
    """SQL ``LIKE`` without regard to case."""
    parts = {"%": ".*", "_": "."}
    return re.fullmatch("".join(parts.get(ch, re.escape(ch)) for ch in pattern), name, re.I | re.S) is not None


def union_sources(
    frames: Mapping[str, DataFrame],
    name_like: str,
    columns: Mapping[str, Column],
    where: Column | None = None,
    group_by: Sequence[Column] | None = None,
) -> DataFrame:
    """The same query over every source whose name is ``LIKE name_like``, appended into one result.

    ``columns`` maps result names to expressions; with ``group_by`` the expressions are aggregates and are evaluated for
    each source by itself, as separate queries would.
    """
    chosen = [frame for name, frame in frames.items() if _like(name, name_like)]
    if not chosen:
        raise ValueError(f"no source is named like {name_like!r}")
    outputs = [expression.alias(name) for name, expression in columns.items()]

    def query(frame: DataFrame) -> DataFrame:
        rows = frame if where is None else frame.where(where)
        if group_by is None:
            return rows.select(*outputs)
        return rows.groupBy(*group_by).agg(*outputs).select(*columns)

    return reduce(DataFrame.unionByName, [query(frame) for frame in chosen])
