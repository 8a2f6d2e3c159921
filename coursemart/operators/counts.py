"""Counts over outer joins, computed from per-key counts instead of the joined rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias(name))


def count_matches_outer(left: DataFrame, right: DataFrame, on: str, exact: bool = False) -> DataFrame:
    """``SELECT key, COUNT(left.key) FROM left LEFT JOIN right USING(key) GROUP BY key`` as (key, n).

    The counted column is the left one, so a key without any match counts 1, and duplicate left rows multiply. ``exact``
    counts the matching right rows instead, 0 when there are none.
    """
    here = _count_by(left, on, "_left")
    there = _count_by(right, on, "_right")
    matches = F.coalesce(F.col("_right"), F.lit(0))
    n = matches if exact else F.col("_left") * F.greatest(matches, F.lit(1))
    return here.join(there, "_key", "left").select(F.col("_key").alias(on), n.alias("n"))


def count_pairs_by_key(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """``COUNT(*)`` of the joined pairs per right key as (right_key, n); keys without a pair do not appear."""
    here = _count_by(left, left_key, "_left")
    there = _count_by(right, right_key, "_right")
    return here.join(there, "_key").select(
        F.col("_key").alias(right_key), (F.col("_left") * F.col("_right")).alias("n")
    )


def conditional_counts(df: DataFrame, key: str, conditions: Mapping[str, Column], weight: str | None = None) -> DataFrame:
    """Several conditional counts per key in one pass; NULL (not 0) where nothing satisfies a condition."""
    unit = F.lit(1) if weight is None else F.col(weight)
    return df.groupBy(key).agg(
        *(F.sum(F.when(condition, unit)).alias(name) for name, condition in conditions.items())
    )
