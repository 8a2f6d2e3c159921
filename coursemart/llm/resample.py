"""Importance resampling towards a target corpus, with features counted once per distinct line.

Features are runs of 1 to ``max_n`` words; a feature counts in bucket ``crc32(utf8) % buckets``. The gain of a bucket is the
log ratio of its smoothed shares in the target and in the corpus; a document's weight is the sum of the gains of its features, and
its score adds a Gumbel draw from a digest of its id. The documents with the highest scores are drawn, a fixed share of those with
enough words.

Segment deduplication: line feeds cut texts into lines (no word runs across one). Every distinct line is counted once, with the
number of its occurrences; its feature counts and its weight are computed once and multiplied by those occurrences, for the corpus
totals as for each document. Runs of more than one word that cross a line feed are added apart: each line gives its first and last
``max_n - 1`` words (all of them if it has few), and only runs across a line feed are formed from those.

Everything runs in DataFrame functions; with runs of one word no copy of the texts is written. A line is known by its SHA-256 in shuffles and
joins; lines go back to their documents by a join on it, of which lines met in at least ``HOT_SHARE`` of all places are broadcast
(at most 1 / HOT_SHARE of them, 32 bytes and three numbers each), the rest shuffled.
The gains are an array of ``buckets`` numbers, a size fixed by the parameter. Ranks come from a range partitioning by score and
the counts of the partitions before, never from one task.

Defined cases: NULL texts have no words (weight 0, never drawn). A NULL id has no draw: score NULL, never drawn. Ties of score go to
the smaller id, then to the earlier row. Repeated rows are scored and drawn each on its own. Empty and very long texts and lines
are whole; the other columns of the table are not read, whatever their names. An empty table gives an empty result; an empty
target table gives every bucket the same gain.
"""

from __future__ import annotations

import string

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemart.session import materialise

#: Fixed values of the contract: what a word is, the seed of the draw and the smoothing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DRAW_SEED = "2024"
SMOOTHING = 10_000

HOT_SHARE = 1 / 4096


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def runs(words: Column, k: int) -> Column:
    """All runs of ``k`` consecutive words, joined by one space (none if there are fewer words)."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1)))
    made = F.transform(starts, lambda i: F.array_join(F.slice(words, i, k), " "))
    return F.when(F.size(words) >= k, made).otherwise(F.array().cast("array<string>"))


def features(words: Column, max_n: int) -> Column:
    return F.flatten(F.array(*(runs(words, k) for k in range(1, max_n + 1))))


def bucket_of(feature: Column, buckets: int) -> Column:
    return F.crc32(F.encode(feature, "UTF-8")) % buckets


def lines_of(texts: DataFrame, text: str) -> DataFrame:
    """(row, line_no, line) for every line of every text; ``row`` numbers the rows of ``texts``."""
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), lower_ascii(F.col(f"`{text}`")).alias("_t"))
    return numbered.select("row", F.posexplode(F.split("_t", "\n", -1)).alias("line_no", "line"))


def line_key(line: Column) -> Column:
    """32 bytes that stand for a line in shuffles and joins: its SHA-256."""
    return F.unhex(F.sha2(line, 256))


def distinct_lines(lines: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(lk, occ, n_words, buckets) once for every distinct line: the segment table, written once.

    Lines are grouped by their digest; the text of a line crosses the shuffle once per task that holds it (partial aggregate).
    """
    counted = lines.groupBy(line_key(F.col("line")).alias("lk")).agg(F.count("*").alias("occ"), F.first("line").alias("line"))
    # The words are a column of their own: inside a lambda an expression would be worked out again for every element.
    split = counted.select("lk", "occ", F.regexp_extract_all("line", F.lit(WORD), 0).alias("words"))
    words = F.col("words")
    found = split.select(
        "lk", "occ", F.size(words).alias("n_words"),
        F.transform(features(words, max_n), lambda f: bucket_of(f, buckets)).alias("buckets"),
    )
    return materialise(found, "lines")


def crossing(lines: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(row, bucket) for every run of 2 to ``max_n`` words that crosses a line feed."""
    if max_n < 2:
        return lines.sparkSession.createDataFrame([], "row long, bucket long")
    edge = max_n - 1
    with_words = lines.select("row", "line_no", F.regexp_extract_all("line", F.lit(WORD), 0).alias("words"))
    words = F.col("words")
    n = F.size(words)
    gap = F.array(F.lit(None).cast("string"))
    # A line gives its first and last ``edge`` words; a gap between them keeps runs from passing through a long line.
    ends = F.when(n <= 2 * edge, words).otherwise(F.concat(F.slice(words, 1, edge), gap, F.slice(words, -edge, edge)))
    marked = with_words.select("row", F.struct("line_no", F.transform(ends, lambda w: F.struct(F.col("line_no").alias("l"), w.alias("w"))).alias("ws")).alias("part"))
    per_row = marked.groupBy("row").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    seq = F.flatten(F.transform("parts", lambda p: p["ws"]))
    made = [crossing_runs(F.col("seq"), k) for k in range(2, max_n + 1)]
    crossed = per_row.select("row", seq.alias("seq")).select("row", F.explode(F.flatten(F.array(*made))).alias("f"))
    return crossed.select("row", bucket_of(F.col("f"), buckets).alias("bucket"))


def crossing_runs(seq: Column, k: int) -> Column:
    """Runs of ``k`` entries of ``seq`` (structs of line ``l`` and word ``w``) without a gap, whose ends lie on other lines."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(seq) - k + 1, F.lit(1)))
    windows = F.transform(starts, lambda i: F.slice(seq, i, k))
    whole = F.filter(
        windows,
        lambda w: (F.size(w) == k) & (F.size(F.filter(w, lambda x: x["w"].isNull())) == 0)
        & (F.get(w, 0)["l"] != F.get(w, k - 1)["l"]),
    )
    return F.transform(whole, lambda w: F.array_join(F.transform(w, lambda x: x["w"]), " "))


def bucket_counts(table: DataFrame, cross: DataFrame) -> DataFrame:
    """(bucket, c): features per bucket, each distinct line's counts times its occurrences, crossing runs added."""
    within = table.select("occ", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.sum("occ").alias("c"))
    crossed = cross.groupBy("bucket").agg(F.count("*").alias("c"))
    return within.unionByName(crossed).groupBy("bucket").agg(F.sum("c").alias("c"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> list[float]:
    """The gain of every bucket, in bucket order: ``buckets`` numbers, whatever the size of the tables."""
    spark = corpus.sparkSession
    s_all = corpus.agg(F.sum("c")).first()[0] or 0
    t_all = target.agg(F.sum("c")).first()[0] or 0
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(corpus.withColumnRenamed("c", "s"), "bucket", "left").join(target.withColumnRenamed("c", "t"), "bucket", "left")
    s, t = F.coalesce("s", F.lit(0)).cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    ratio = (t + 1) * float(s_all + SMOOTHING) / ((s + 1) * float(t_all + SMOOTHING))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("double").alias("g")).orderBy("bucket").collect()
    return [r["g"] for r in rows]


def gain_array(gain: list[float]) -> Column:
    """The gains as one array literal (``buckets`` doubles), not an expression per element."""
    return F.lit(np.asarray(gain, dtype="float64"))


def line_weights(table: DataFrame, gain: list[float]) -> DataFrame:
    """(lk, occ, n_words, n_features, weight) per distinct line, the gains looked up in one array."""
    g = gain_array(gain)
    weight = F.aggregate("buckets", F.lit(0.0), lambda acc, b: acc + F.element_at(g, (b + 1).cast("int")))
    return table.select("lk", "occ", "n_words", F.size("buckets").cast("long").alias("n_features"), weight.alias("weight"))


def per_document(lines: DataFrame, weighted: DataFrame, cross: DataFrame, gain: list[float]) -> DataFrame:
    """(row, key, n_words, n_features, weight) per row, by a join of its lines to the segment table."""
    total = weighted.agg(F.sum("occ")).first()[0] or 0
    is_hot = F.col("occ") >= F.lit(max(2.0, total * HOT_SHARE))
    cols = ["n_words", "n_features", "weight"]
    hot = weighted.where(is_hot).select("lk", *(F.col(c).alias(f"h_{c}") for c in cols))
    cold = weighted.where(~is_hot).select("lk", *cols)
    looked = lines.select("row", "key", line_key(F.col("line")).alias("lk")).join(F.broadcast(hot), "lk", "left")
    known = looked.where(F.col("h_weight").isNotNull()).select("row", "key", *(F.col(f"h_{c}").alias(c) for c in cols))
    rest = looked.where(F.col("h_weight").isNull()).join(cold, "lk").select("row", "key", *cols)
    g = gain_array(gain)
    crossed = cross.select(
        "row", F.lit(None).cast("long").alias("key"), F.lit(0).cast("long").alias("n_words"), F.lit(1).cast("long").alias("n_features"),
        F.element_at(g, (F.col("bucket") + 1).cast("int")).alias("weight"),
    )
    parts = known.unionByName(rest).unionByName(crossed)
    # Every row has a line (an empty text one empty line), so the key rides with its lines: no join back by row number.
    return parts.groupBy("row").agg(F.first("key", ignorenulls=True).alias("key"), *(F.sum(c).alias(c) for c in cols))


def draw(key: Column) -> Column:
    """A Gumbel draw from the first 8 hex digits of SHA-256 of ``<seed>:<key>``: floor(-1000 ln(-ln((h + 0.5) / 2^32)))."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(DRAW_SEED + ":"), key.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def rank_top(scored: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """``scored`` with ``rank`` 1..k for its first ``k`` rows in ``order``, NULL for the others; no task holds all rows."""
    parted = scored.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    local = parted.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = local.groupBy("_part").agg(F.max("_local").alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    placed = local.join(F.broadcast(before), "_part").withColumn("_pos", F.coalesce("_before", F.lit(0)) + F.col("_local"))
    return placed.withColumn("rank", F.when(F.col("_pos") <= k, F.col("_pos"))).drop("_part", "_local", "_before", "_pos")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    max_n: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20,
) -> DataFrame:
    """Every row of ``docs``: key, n_features, weight, score, rank (all long; rank NULL where not drawn)."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")
    )
    if max_n >= 2:
        # Runs across line feeds are found in a pass of their own, which must meet the same row numbers: fixed once in a copy.
        numbered = materialise(numbered, "numbered")
    # Otherwise nothing is written: the key rides with every line, and row numbers are only compared within one pass.
    lines = numbered.select("row", "key", F.posexplode(F.split(lower_ascii(F.col("text")), "\n", -1)).alias("line_no", "line"))
    table, cross = distinct_lines(lines, max_n, buckets), crossing(lines, max_n, buckets)
    t_lines = lines_of(target.select(F.col(f"`{target_text}`").alias("t")), "t")
    t_table, t_cross = distinct_lines(t_lines, max_n, buckets), crossing(t_lines, max_n, buckets)
    gain = gains(bucket_counts(table, cross), bucket_counts(t_table, t_cross), buckets)
    found = per_document(lines, line_weights(table, gain), cross, gain)
    whole = found
    weight = F.coalesce("weight", F.lit(0.0))
    scored = whole.select(
        "row", "key", F.coalesce("n_words", F.lit(0)).alias("n_words"), F.coalesce("n_features", F.lit(0)).cast("long").alias("n_features"),
        weight.cast("long").alias("weight"), (weight + draw(F.col("key"))).cast("long").alias("score"),
    )
    scored = materialise(scored, "scored")
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    n = scored.where(eligible).count()
    drawn = rank_top(scored.where(eligible), n * percent // 100, [F.col("score").desc(), F.col("key").asc(), F.col("row").asc()])
    ranks = drawn.where(F.col("rank").isNotNull()).select("row", "rank")
    out = scored.join(ranks, "row", "left")
    return out.select(F.col("key").alias(key), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
