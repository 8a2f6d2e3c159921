"""One row per key, smallest row per key, and dense numbering, without a window over an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.operators.enrich import FIXED_WIDTH, any_null, least_per_key, ordered_struct, quoted


def dedupe_on_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one whole row per key: the first by ``order_by``, then by all other columns, NULLs last.

    NULL is a key like any other here. Where the first order column has a fixed width, the least of it per key comes from a hash
    aggregate of narrow rows and the whole rows are fetched by key and that value (``least_per_key``); exact ties, and keys with
    a NULL, are settled last among the few rows left. Otherwise a partial ``min`` of one struct runs before the shuffle, so
    copies of a hot key collapse early.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = [*order_by, *rest]
    if not ranked:
        return df.distinct()
    if isinstance(df.schema[ranked[0]].dataType, FIXED_WIDTH):
        complete = least_per_key(df.where(f"NOT {any_null(keys)}"), keys, ranked)
        with_null = df.where(any_null(keys))
        best = with_null.groupBy(*keys).agg(F.expr(f"min({ordered_struct(ranked)}) AS _best"))
        partial = best.selectExpr(
            *(quoted(c) if c in keys else f"_best.v{ranked.index(c)} AS {quoted(c)}" for c in df.columns)
        )
        return complete.unionByName(partial)
    best = df.groupBy(*keys).agg(F.expr(f"min({ordered_struct(ranked)}) AS _best"))
    return best.selectExpr(
        *(quoted(c) if c in keys else f"_best.v{ranked.index(c)} AS {quoted(c)}" for c in df.columns)
    )


def latest_per_key(df: DataFrame, keys: str | Sequence[str], ts: str) -> DataFrame:
    """The newest row of each key; of equally new rows, the greatest by the remaining columns."""
    key_list = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in key_list and c != ts]
    newest = df.groupBy(*key_list).agg(F.max(F.struct(ts, *rest)).alias("_newest"))
    return newest.select(*(F.col(c) if c in key_list else F.col(f"_newest.{c}").alias(c) for c in df.columns))


def keep_min_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Drop a row when another row of the same key has a smaller ``value``.

    Ties stay, and so do rows with a NULL key or a NULL value, for which no comparison holds. The minimum is aggregated
    with map-side combine and joined back on key *and* value, so the rows of one hot key spread over the cluster by
    their value, and the rows kept for a NULL in the key likewise.
    """
    minima = (
        df.where(f"NOT {any_null([*keys, value])}")
        .groupBy(*(F.col(k).alias(f"_min_{k}") for k in keys))
        .agg(F.min(value).alias("_min"))
        .withColumn("_is_min", F.lit(True))
    )
    condition = F.col(value) == F.col("_min")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_min_{k}"))
    joined = df.join(minima, condition, "left")
    return joined.where(f"_is_min IS NOT NULL OR {any_null([*keys, value])}").select(*df.columns)


#: Copies of one row are numbered in chunks of at most this many, so that a row met a third of the time spreads over many tasks.
COPY_CHUNK = 1 << 20
#: Rows of the boundary sample per bucket.
SAMPLE_PER_BUCKET = 32


def dense_sequence(
    df: DataFrame, order_by: Sequence[str], name: str = "seq_num", start: int = 1, buckets: int | None = None
) -> DataFrame:
    """Number all rows ``start``, ``start+1``, ... in the order given, first column of the result.

    Order: ``order_by``, then the remaining columns, each ascending with NULLs first; exact copies cannot be told apart, so which
    of them takes which number does not matter. Columns must be orderable (no maps).

    Nothing is written and nothing is left behind. Copies collapse first (hash aggregate, partial before the shuffle) into one
    row and a count, cut in chunks of at most ``COPY_CHUNK``. The chunks go to order-preserving buckets by boundaries drawn once
    from a sample weighted by copies (``SAMPLE_PER_BUCKET`` rows a bucket reach the driver) and fixed as literals in the plan, so
    a bucket is a function of the row alone, and a lost executor recomputes the same numbers. A hot or NULL order key spreads
    over several buckets by its remaining columns and its chunks. Each bucket numbers its chunks by a running sum of their
    sizes; the sizes of the buckets before it come from one row per bucket (broadcast, at most ``buckets`` rows).
    """
    spark = df.sparkSession
    cols = df.columns
    if not cols:
        raise ValueError("dense_sequence needs a column")
    n_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = [*order_by, *(c for c in cols if c not in order_by)]
    counted = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    last_chunk = F.floor((F.col("_n") - 1) / F.lit(COPY_CHUNK)).cast("long")
    chunks = counted.select(*cols, "_n", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias("_c"))
    chunks = chunks.select(*cols, "_c", F.least(F.lit(COPY_CHUNK).cast("long"), F.col("_n") - F.col("_c") * COPY_CHUNK).alias("_len"))
    key_cols = [c for c in ranked if _literal_type(df.schema[c].dataType)]
    key = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)), F.col("_c").alias("k_c"))
    bounds = _boundaries(chunks, key_cols, n_buckets, df.count())
    bucketed = chunks.withColumn("_b", _bucket_of(key, bounds, [df.schema[c].dataType for c in key_cols]))
    order = [*(F.col(c).asc_nulls_first() for c in ranked), F.col("_c")]
    running = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = bucketed.withColumn("_end", F.sum("_len").over(running))
    sizes = bucketed.groupBy("_b").agg(F.sum("_len").alias("_size"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    # One row per bucket, at most len(bounds) + 1: bounded by the parameter, whatever the size of the table.
    placed = within.join(F.broadcast(offsets), "_b")
    first = F.col("_before") + F.col("_end") - F.col("_len") + F.lit(start)
    numbers = F.sequence(first.cast("long"), (first + F.col("_len") - 1).cast("long"))
    return placed.select(F.explode(numbers).alias(name), *cols)


def _literal_type(t: T.DataType) -> bool:
    return isinstance(t, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))


def _boundaries(chunks: DataFrame, key_cols: list[str], n_buckets: int, total: int) -> list[tuple]:
    """Up to ``n_buckets - 1`` distinct keys, in order, that cut ``total`` copies into about equal shares."""
    if total == 0 or n_buckets < 2:
        return []
    rate = min(1.0, SAMPLE_PER_BUCKET * n_buckets / total)
    # A chunk of ``_len`` copies is drawn as often as that many rows would be: a hot row yields several boundaries.
    picks = F.least(F.lit(SAMPLE_PER_BUCKET * n_buckets).cast("double"), F.floor(F.col("_len") * rate + F.rand(17)))
    drawn = chunks.select(*key_cols, "_c", picks.cast("long").alias("_w")).where("_w > 0")
    rows = drawn.orderBy(*(F.col(c).asc_nulls_first() for c in key_cols), "_c").collect()
    weights = [r["_w"] for r in rows]
    step = max(1, sum(weights) // n_buckets)
    bounds, seen = [], 0
    for r, w in zip(rows, weights):
        seen += w
        if seen >= step * (len(bounds) + 1) and len(bounds) < n_buckets - 1:
            b = tuple(r[c] for c in key_cols) + (r["_c"],)
            if not bounds or bounds[-1] != b:
                bounds.append(b)
    return bounds


def _bucket_of(key, bounds: list[tuple], types: list[T.DataType]):
    """How many of ``bounds`` are at most ``key``: a binary search in one higher-order function."""
    if not bounds:
        return F.lit(0)
    lits = F.array(
        *(
            F.struct(*(F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(b, types))), F.lit(b[-1]).cast("long").alias("k_c"))
            for b in bounds
        )
    )
    steps = max(1, len(bounds).bit_length())
    init = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        go_up = (acc["lo"] < acc["hi"]) & (key >= F.element_at(lits, mid + 1))
        stay = acc["lo"] >= acc["hi"]
        return F.when(stay, acc).when(go_up, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(
            F.struct(acc["lo"].alias("lo"), mid.alias("hi"))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, halve)["lo"]


def newest_n(df: DataFrame, root: str, ts: str, n: int = 2) -> DataFrame:
    """The ``n`` newest distinct (root, time) pairs of each root, with their rank.

    Works on the distinct pairs, so a snapshot of any size counts as one row.
    """
    newest_first = Window.partitionBy(root).orderBy(F.col(ts).desc())
    return (
        df.select(root, ts)
        .distinct()
        .withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") <= n)
    )
