"""Mixing sources to target weights by proportionate-fair windows, in DataFrame and SQL functions only.

Each source's documents are dealt to blocks of ``block`` documents, in an order by the digest of the id. With the target weight ``w`` of
its source (weights add up to one), block ``i`` (from 0) is released at ``floor(i / w)`` and due at ``ceil((i + 1) / w)``.

A block's slot comes from a tree over the sources, each block on its own. A node deals its slots to its two children by their exact weights:
of the first ``t``, the first child gets ``t`` times its part, rounded, and the second the others; so the slot of a child's ``i``-th block
within the node has a closed form, and from leaf to root this gives the block's slot. Sources of about one weight (within a factor of two)
make a balanced tree, and these trees hang on a chain, heavy ones first. A rounding is off by half a slot at most and counts for a source
by its part of that node, which falls geometrically upwards. So after any number of slots a source stays within a bound of its share (below
three blocks) that depends neither on the number of slots nor of sources. With up to four sources of unlike weight it is below one, and
each slot is in the block's window; with more, a slot can be outside the window by what the bound leaves. Weights are whole multiples of ``1 / WEIGHT_UNIT``, so the slots are unique and without gaps.

All documents are placed: a source that has no more blocks leaves its slots empty, and from there on the others keep their
proportions among themselves.

Defined cases: a NULL source is a source of its own and comes first among ties. Rows without an id are ordered as the empty id. Rows that repeat an id
lie next to each other in one order or another. Text is not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.llm.common import literal_rows
from coursemart.session import materialise

BLOCK = 8
SLOTS = 200
#: Weights are whole multiples of one part in so many; after as many slots, a weight's rounding comes to half a block.
WEIGHT_UNIT = 1 << 40
#: Exponent that flattens the sources' sizes to target weights.
TEMPERATURE = 0.7


def tempered(sizes: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, weight): sizes to the power ``temperature``."""
    return sizes.select("source", F.pow(F.col("n").cast("double"), F.lit(temperature)).alias("weight"))


def slot_shares(weights: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(source, share, slots): what the exact weight of each source comes to in ``slots`` slots, not rounded."""
    total = weights.agg(F.sum("weight").alias("_total"))
    return weights.crossJoin(total).select(
        "source", (F.col("weight") / F.col("_total") * slots).alias("share"), F.lit(slots).cast("long").alias("slots")
    )


def _whole(column: Column) -> Column:
    return column.cast("decimal(18,0)")


def kind_nodes(kinds: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(kind, level, total, own, first): the nodes above each kind of sources; ``kinds`` has (kind, units), heavy sources first.

    A chain whose last four kinds are a tree of two levels: there only one rounding below the root's counts, by a part below one.
    """
    units = [u for _, u in kinds]
    last = max(0, len(kinds) - 4)
    rows = []
    for j, (kind, own) in enumerate(kinds):
        path = []
        if j >= last:
            pairs = [sum(units[last + k] for k in pair if last + k < len(kinds)) for pair in ((0, 3), (1, 2))]
            mine = int(j - last in (1, 2))
            path = [(pairs[mine], own, int(j - last < 2)), (sum(pairs), pairs[mine], 1 - mine)]
        else:
            path = [(sum(units[j:]), own, 1)]
        path += [(sum(units[i:]), sum(units[i + 1 :]), 0) for i in range(min(j, last) - 1, -1, -1)]
        rows += [(kind, 100 + level, *node) for level, node in enumerate(path)]
    return rows


def tree_paths(weights: DataFrame) -> DataFrame:
    """(source, unit, units, path): the source's weight in whole units, those of all sources, and the nodes from the source up to the root
    as (total, own, first): the units of the node and of its child on the path, and 1 where that is the first child, else 0.

    A row per source and level of the tree; no array is longer than the tree is high.
    """
    total = weights.agg(F.sum("weight").alias("_total"))
    unit = F.greatest(F.lit(1).cast("long"), F.round(F.col("weight") / F.col("_total") * WEIGHT_UNIT).cast("long"))
    sources = (
        weights.crossJoin(total)
        .select("source", unit.alias("unit"))
        .withColumn("kind", F.floor(F.log2(F.lit(float(WEIGHT_UNIT)) / F.col("unit"))))
        .withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy(F.asc_nulls_first("source"))) - 1)
    )
    sources = materialise(sources, "sources")
    kinds = sources.groupBy("kind").agg(F.sum("unit").alias("units"), F.count("*").alias("m"))
    # At most 41 rows, a kind per power of two of the unit.
    chain = literal_rows(
        weights.sparkSession,
        kind_nodes([(r["kind"], r["units"]) for r in kinds.orderBy("kind").collect()]),
        ["kind", "level", "total", "own", "first"],
        ["long", "long", "long", "long", "int"],
    )
    chain = chain.groupBy("kind").agg(F.collect_list(F.struct("level", "total", "own", "first")).alias("chain"))
    everything = kinds.agg(F.sum("units").alias("units"))
    node = Window.partitionBy("kind", "level", F.expr("shiftright(k, level)"))
    above = Window.partitionBy("kind", "level", F.expr("shiftright(k, level + 1)"))
    leaves = (
        sources.join(kinds.select("kind", "m"), "kind")
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.ceil(F.log2(F.col("m").cast("double"))).cast("int"))))
        .withColumn("own", F.sum("unit").over(node))
        .withColumn("total", F.sum("unit").over(above))
        .withColumn("first", 1 - F.expr("shiftright(k, level)") % 2)
        .groupBy("source", "kind", "unit")
        .agg(F.collect_list(F.struct(F.col("level").cast("long").alias("level"), "total", "own", "first")).alias("inner"))
    )
    nodes = F.filter(F.array_sort(F.concat("inner", "chain")), lambda x: x["total"] > x["own"])
    return leaves.join(chain, "kind").crossJoin(everything).select("source", "unit", "units", nodes.alias("path"))


def _slot(block: Column, path: Column) -> Column:
    """The slot of a source's ``block``-th block, from leaf to root."""

    def up(i: Column, node: Column) -> Column:
        odd = (2 * i + 1).cast("decimal(19,0)") * _whole(node["total"]) - node["first"]
        return F.call_function("div", odd, _whole(2 * node["own"])).cast("long")

    return F.aggregate(path, block.cast("long"), up)


def _in_source_order(docs: DataFrame, key: str, source: str) -> tuple[DataFrame, DataFrame]:
    """(docs with source, order and rank within the source from 0, sizes of the sources).

    A source is cut by the first digits of the digest into about as many buckets as it has documents per bucket, so neither a
    bucket nor the buckets of a source are many rows for one task, however large the source. A document's rank is its rank in
    its bucket after the documents of the buckets before it.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        *(c for c in docs.columns if c != source), F.col(source).alias("source"), digest.alias("_digest")
    ).withColumn("_place", F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long"))
    sizes = materialise(rows.groupBy("source").agg(F.count("*").alias("n")), "sizes")
    bucket = F.floor(F.col("_place") * F.ceil(F.sqrt("n")) / F.lit(1 << 32))
    same = F.col("source").eqNullSafe(F.col("s"))
    dealt = rows.join(sizes.withColumnRenamed("source", "s"), same).withColumn("_bucket", bucket).drop("s", "n")
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = materialise(
        rows.select("source", "_place")
        .join(sizes.withColumnRenamed("source", "s"), same)
        .groupBy("source", bucket.alias("_bucket"))
        .agg(F.count("*").alias("m"))
        .select(F.col("source").alias("s"), F.col("_bucket").alias("b"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("_first")),
        "buckets",
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("_digest", F.asc_nulls_first(key))
    ranked = dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(
        buckets, same & (F.col("_bucket") == F.col("b"))
    )
    return ranked.withColumn("_rank", F.col("_first") + F.col("_inside")).drop("_place", "_bucket", "s", "b", "_first", "_inside"), sizes


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    block: int = BLOCK,
    slots: int = SLOTS,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """``docs`` (with ``source`` as text) and, for each row, its block's number within the source, release, deadline and slot, and its
    place within the block. Ordered by slot and place, the corpus is mixed; slots are unique to a block.

    ``weights`` maps sources to positive target weights; one that it does not name, or all without it, gets its tempered size (relative to all).
    ``slots`` is taken for the sake of callers; as weights are not rounded to a round of slots, it changes nothing.
    """
    spark = docs.sparkSession
    ranked, sizes = _in_source_order(docs, key, source)
    target = tempered(sizes, temperature)
    if weights is not None:
        if any(w <= 0 for w in weights.values()):
            raise ValueError("weights are positive")
        given = literal_rows(spark, list(weights.items()), ["s", "given"], ["string", "double"])
        total = target.agg(F.sum("weight")).first()[0] or 1.0
        target = target.join(given, F.col("source").cast("string").eqNullSafe(F.col("s")), "left").select(
            "source", F.coalesce("given", F.col("weight") / F.lit(total)).alias("weight")
        )
    paths = materialise(tree_paths(target), "paths").withColumnRenamed("source", "_s")
    blocked = ranked.withColumn("block", F.floor(F.col("_rank") / F.lit(block)))
    far = F.col("block").cast("decimal(19,0)"), (F.col("block") + 1).cast("decimal(19,0)")
    unit, units = _whole(F.col("unit")), _whole(F.col("units"))
    return blocked.join(paths, F.col("source").eqNullSafe(F.col("_s"))).select(
        *(F.col("source").alias(c) if c == source else F.col(c) for c in docs.columns),
        "block",
        F.call_function("div", far[0] * units, unit).alias("release"),
        F.call_function("div", far[1] * units + unit - 1, unit).alias("deadline"),
        _slot(F.col("block"), F.col("path")).alias("slot"),
        F.pmod(F.col("_rank"), F.lit(block)).alias("place"),
    )


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", order: tuple[str, str] | None = None, **how) -> DataFrame:
    """All rows of ``docs`` in mixed order: partition after partition, and within each, by slot and place.

    ``order`` names two columns that keep slot and place, so that the order lasts where rows are read or dealt out anew.
    """
    by_slot = (
        mix(docs, key, source, **how)
        .withColumnsRenamed({"slot": "_slot", "place": "_in_block"})
        .orderBy("_slot", "_in_block")
    )
    kept = [F.col(c).alias(name) for c, name in zip(("_slot", "_in_block"), order or (), strict=False)]
    return by_slot.select(*docs.columns, *kept)


def running_start(rows: DataFrame, amount: str, out: str, order: tuple[str, str] = ("slot", "place")) -> DataFrame:
    """``rows`` and ``out``: the sum of ``amount`` over all rows that come before in mixed order.

    ``rows`` are read three times, so they are written ones. Slots are cut into about as many ranges as a range has slots, so neither a
    range nor the list of ranges is many rows for one task.
    """
    last = rows.agg(F.max(order[0])).first()[0] or 0
    cut = rows.withColumn("_range", F.floor(F.col(order[0]) / F.lit(math.isqrt(last) + 1)))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut.groupBy(F.col("_range").alias("_r")).agg(F.sum(amount).alias("_sum"))
    ranges = ranges.select("_r", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(ranges, F.col("_range") == F.col("_r"))
        .select(*rows.columns, (F.col("_first") + F.col("_inside")).cast("long").alias(out))
    )
