"""Lookup enrichment: fill columns of a table from a lookup without ever changing the table's row count.

How it scales
-------------
* The lookup is reduced to one winner per key by ``min(struct)``. That aggregate combines on the map side, so a key with
  billions of lookup rows sends one row per map task through the shuffle.
* Small lookups are broadcast by Spark itself, below the size it has estimated or, under AQE, measured. There is no
  forced broadcast.
* Otherwise both join inputs are plain exchanges, the shape in which AQE can cut a hot key of the left side into many
  tasks. A lookup coming straight out of a grouping on the join key would already be partitioned by it; Spark would then
  join without an exchange on that side and AQE could not split anything. The extra key ``_slot`` prevents that.
* ``_slot`` also spreads the left rows whose key is NULL (and that can match nothing) over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOT = "_slot"
NULL_KEY_SLOTS = 4096


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def any_null(columns: Iterable[str]) -> str:
    """SQL text: is one of the columns NULL?"""
    return "(" + " OR ".join(f"{quoted(c)} IS NULL" for c in columns) + ")"


def ordered_struct(columns: Sequence[str]) -> str:
    """SQL text of a struct that sorts by the columns in turn, NULLs last; column i is its field ``v<i>``."""
    fields = (f"{quoted(c)} IS NULL AS n{i}, {quoted(c)} AS v{i}" for i, c in enumerate(columns))
    return f"struct({', '.join(fields)})"


#: Types whose minimum a hash aggregate keeps in a fixed-width buffer, with no sort of the rows.
FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def least_per_key(df: DataFrame, keys: Sequence[str], ranked: Sequence[str]) -> DataFrame:
    """One whole row per key of ``df``: the least by ``ranked`` in turn, NULLs last. Keys hold no NULL.

    Two steps instead of a sort of whole rows: the least first column per key, and how many rows the key has, come from a hash
    aggregate of narrow rows; the rows that reach it are fetched by a join on the key. A key with one row is done there; only
    keys with several rows go through a ``min`` of a struct of the remaining columns, over the rows that reached the least first
    value, to break exact ties. The first column has to be of a fixed-width type.
    """
    first = ranked[0]
    if not isinstance(df.schema[first].dataType, FIXED_WIDTH):
        raise ValueError(f"the first order column {first!r} must have a fixed-width type")
    inner = [f"_lk{i}" for i in range(len(keys))]
    least = df.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, inner))).agg(
        F.min(first).alias("_least"), F.count("*").alias("_rows")
    )
    condition = reduce(lambda a, b: a & b, (F.col(k) == F.col(n) for k, n in zip(keys, inner)))
    reached = df.join(least, condition).where(F.col(first).eqNullSafe(F.col("_least")))
    single = reached.where(F.col("_rows") == 1).select(*df.columns)
    # Exact ties: the least struct of the remaining columns per key, over the rows that reached the least first value only.
    order = [*ranked, *(c for c in df.columns if c not in keys and c not in ranked)]
    best = reached.where(F.col("_rows") > 1).groupBy(*keys).agg(F.expr(f"min({ordered_struct(order)}) AS _best"))
    several = best.selectExpr(*(quoted(c) if c in keys else f"_best.v{order.index(c)} AS {quoted(c)}" for c in df.columns))
    return single.unionByName(several)


def winner_per_key(
    lookup: DataFrame, keys: Sequence[str], values: Sequence[str], order_by: Sequence[str] = (), slot: bool = False
) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the values themselves, NULLs last.

    Rows with a NULL in the key are left out, since they match nothing. ``slot`` adds the constant column that lets
    the result be joined with skew handling.
    """
    outputs = [v for v in dict.fromkeys(values) if v not in keys]
    ranked = [*order_by, *(v for v in outputs if v not in order_by)]
    complete = lookup.where(f"NOT {any_null(keys)}")
    if len(ranked) > 1 and isinstance(lookup.schema[ranked[0]].dataType, FIXED_WIDTH):
        # Least order key first, then the row of it: no sort of whole lookup rows.
        best = least_per_key(complete.select(*keys, *ranked), keys, ranked)
        return best.select(*keys, *outputs, *([F.lit(0).cast("long").alias(SLOT)] if slot else []))
    if len(ranked) == 1:
        # min() passes over NULLs by itself, and on a fixed-width column it needs no sort before the shuffle.
        aggregates = [F.expr(f"struct(min({quoted(ranked[0])}) AS v0) AS _best")]
    else:
        aggregates = [F.expr(f"min({ordered_struct(ranked)}) AS _best")] if ranked else []
    if slot or not ranked:
        aggregates.append(F.expr(f"min(0L) AS {SLOT}"))
    best = lookup.where(f"NOT {any_null(keys)}").groupBy(*keys).agg(*aggregates)
    return best.selectExpr(
        *map(quoted, keys),
        *(f"_best.v{ranked.index(v)} AS {quoted(v)}" for v in outputs),
        *([SLOT] if slot else []),
    )


def join_winners(
    df: DataFrame, winners: DataFrame, on: Mapping[str, str], how: str, spread_by: Sequence[str]
) -> DataFrame:
    """Join a grouped one-row-per-key table (with its ``_slot``) so that AQE can split hot keys of ``df``.

    The columns of ``winners`` must have names that ``df`` does not have. ``_slot`` of a left row is 0 when its key is
    complete, else a number derived from ``spread_by``.
    """
    spread = f"pmod(xxhash64({', '.join(map(quoted, spread_by))}), {NULL_KEY_SLOTS}L)" if spread_by else "0L"
    left = df.withColumn("_left_slot", F.expr(f"CASE WHEN {any_null(on)} THEN {spread} ELSE 0L END"))
    keys = [f"{quoted(mine)} = {quoted(theirs)}" for mine, theirs in on.items()]
    return left.join(winners, F.expr(" AND ".join([*keys, f"_left_slot = {SLOT}"])), how)


def enrich_left(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    order_by: Sequence[str] = (),
    unmatched: str = "null",
    condition: Column | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """``UPDATE df LEFT JOIN lookup ON ... SET ...`` as a DataFrame.

    ``on`` maps columns of ``df`` to columns of ``lookup``; ``columns`` maps target columns (replaced or added) to lookup
    columns. Several matches: one winner by ``order_by`` (lookup columns), then by value. ``condition`` limits the lookup
    rows that may update. Rows without a match get NULL, or with ``unmatched="keep"`` stay as they are. ``spread_by``
    names columns that tell rows apart (default: all), used only to spread rows with NULL keys.
    """
    if unmatched not in ("null", "keep"):
        raise ValueError(f"unmatched must be 'null' or 'keep', not {unmatched!r}")
    present = df.columns
    candidates = lookup if condition is None else lookup.where(condition)
    keys = [f"_key{i}" for i in range(len(on))]
    values = [f"_new{i}" for i in range(len(columns))]
    order = [f"_order{i}" for i in range(len(order_by))]
    # Every lookup column moves to a name of its own, so lookup and table may share column names.
    sources = [*on.values(), *columns.values(), *order_by]
    renamed = [f"{quoted(source)} AS {name}" for source, name in zip(sources, [*keys, *values, *order])]
    winners = winner_per_key(candidates.selectExpr(*renamed), keys, values, order, slot=True)
    joined = join_winners(df, winners, dict(zip(on, keys)), "left", present if spread_by is None else spread_by)
    filled = {target: value for target, value in zip(columns, values)}
    if unmatched == "keep":
        for target in filled.keys() & set(present):
            filled[target] = f"CASE WHEN {SLOT} IS NOT NULL THEN {filled[target]} ELSE {quoted(target)} END"
    return joined.selectExpr(
        *(f"{filled.pop(c)} AS {quoted(c)}" if c in filled else quoted(c) for c in present),
        *(f"{value} AS {quoted(target)}" for target, value in filled.items()),
    )


def enrich_per_key(
    df: DataFrame,
    keys: Sequence[str],
    fill: Callable[[DataFrame], DataFrame],
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Several lookups that depend on ``keys`` only: made once per distinct key, then joined back in one go.

    ``fill`` takes a table of the distinct keys and returns it with the new columns, one row per key as before. A large table
    thus meets one join instead of one per lookup, and the keys shrink on the map side before anything is shuffled.
    ``key_rows`` is a cheaper table that holds every key of ``df``. NULL is a key value like any other.
    """
    distinct = (df if key_rows is None else key_rows).select(*keys).distinct()
    filled = fill(distinct)
    added = [c for c in filled.columns if c not in keys]
    looked_up = filled.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)})
    condition = " AND ".join(f"{quoted(k)} <=> _key{i}" for i, k in enumerate(keys))
    return df.join(looked_up, F.expr(condition), "left").select(*df.columns, *added)


def join_distinct(
    df: DataFrame, lookup: DataFrame, on: str, how: str = "left", spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Join with the distinct rows of ``lookup`` on a column of the same name; several rows per key fan out."""
    others = [c for c in lookup.columns if c != on]
    rows = (
        lookup.where(F.col(on).isNotNull())
        .groupBy(F.col(on).alias("_key"), *others)
        .agg(F.expr(f"min(0L) AS {SLOT}"))
    )
    joined = join_winners(df, rows, {on: "_key"}, how, df.columns if spread_by is None else spread_by)
    return joined.select(*df.columns, *others)
