"""Approximate nearest neighbours: inverted lists scanned by adaptive dimensions.

Vectors are rotated at random, so that the first dimensions of a difference tell its length up to a known error, and kept
in blocks of columns. A list is scanned block by block: after each, a hypothesis test on the partial distance (is
``partial * D / d`` beyond the tenth distance so far by more than the error at ``d`` dimensions?) abandons candidates; those left at the end
are measured on the original vectors in double precision. Each query scans its nearest list first; the tenth distance found
there is where its other lists start from.

Lists are the cells of centroids fitted to a bounded sample; every vector is in one. A list is searched in parts of about
``PART`` vectors, dealt by a hash of the id, so that a list with any share of the vectors spreads over the cluster; queries are dealt
to blocks of about ``QUERY_PART`` in the same way, and each part meets each block in a task of its own.

Defined cases: vectors that are NULL, all zero, of another length than most, or hold a NULL or non-finite component take no part, and
neither do rows without an id. Rows that repeat a query's id count as one query (its least vector) and never as its
neighbours. Ties go to the smaller id. Fewer candidates than ``k``: all of them. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursemart.llm.common import ship
from coursemart.session import materialise

BLOCK = 16
PART = 2048
#: Queries that meet a part of a list in one task, about.
QUERY_PART = 32_768
#: Vectors that the centroids are fitted to, at most.
SAMPLE = 16_384
#: Share of lists that a query scans, and the fewest.
PROBE_SHARE, PROBE_LEAST = 0.65, 32
#: Standard errors by which a partial distance has to exceed the bound.
ERRORS = 2.1
SEED = 11


def valid_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(id, v) of the rows that take part, and the number of components."""
    numbers = f"transform({vector}, x -> cast(x AS double))"
    sound = df.where(f"{key} IS NOT NULL AND {vector} IS NOT NULL AND size({vector}) > 0").where(
        f"forall({numbers}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists({vector}, x -> x <> 0)"
    )
    common = sound.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = common["d"] if common else 0
    return sound.where(F.size(vector) == d).select(F.col(key).cast("long").alias("id"), F.expr(numbers).alias("v")), d


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def fit_centroids(sample: np.ndarray, n_lists: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from distinct rows of the sample."""
    rng = np.random.default_rng(SEED)
    centroids = sample[rng.choice(len(sample), min(n_lists, len(sample)), replace=False)].astype(np.float32)
    sample = sample.astype(np.float32)
    for _ in range(rounds):
        nearest = nearest_lists(sample, centroids, 1)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        n = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def nearest_lists(rows: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centroids of each row, nearest first."""
    norms = (centroids**2).sum(axis=1)
    out = np.empty((len(rows), n), dtype=np.int32)
    for i in range(0, len(rows), 1024):
        far = norms[None, :] - 2 * rows[i : i + 1024].astype(np.float32) @ centroids.T
        out[i : i + 1024] = np.argsort(far, axis=1, kind="stable")[:, :n]
    return out


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _to_lists(centroids: np.ndarray, d: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = nearest_lists(_matrix(batch.column("v"), d), centroids, n)
            flat = pa.ListArray.from_arrays(pa.array(range(0, lists.size + 1, n), pa.int32()), pa.array(lists.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), flat], names=["id", "v", "lists"])

    return run


def scan(
    query: np.ndarray,
    turned_query: np.ndarray,
    own: int,
    ids: np.ndarray,
    vectors: np.ndarray,
    blocks: list[np.ndarray],
    k: int,
    bound: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the ``k`` nearest candidates found whose square is at most ``bound``.

    ``blocks`` are the rotated vectors by blocks of columns, one column after the other.
    """
    d = vectors.shape[1]
    best_ids, best = np.array([], dtype=np.int64), np.array([])
    for begin in range(0, len(ids), 512):
        alive = np.arange(begin, min(begin + 512, len(ids)))
        alive = alive[ids[alive] != own]
        partial = np.zeros(len(alive))
        seen = 0
        for block in blocks:
            columns = block[:, alive]
            partial += ((columns - turned_query[seen : seen + len(block), None]) ** 2).sum(axis=0)
            seen += len(block)
            if np.isfinite(bound):
                # At the last block the partial distance is the distance, up to rounding.
                slack = (1 + ERRORS / np.sqrt(seen)) ** 2 if seen < d else 1 + 1e-6
                keep = partial * (d / seen) <= bound * slack + 1e-12
                alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
        if len(alive):
            exact = ((vectors[alive] - query) ** 2).sum(axis=1)
            best_ids, best = np.concatenate([best_ids, ids[alive]]), np.concatenate([best, exact])
            order = np.lexsort((best_ids, best))[:k]
            best_ids, best = best_ids[order], best[order]
            if len(best) == k:
                bound = min(bound, best[-1])
    return best_ids, best


def _search(d: int, k: int):
    turn = rotation(d)

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out_q, out_i, out_s = [], [], []
        if queries.num_rows and vectors.num_rows:
            ids, rows = vectors.column("id").to_numpy(), _matrix(vectors.column("v"), d)
            turned = np.ascontiguousarray((rows @ turn).T)
            blocks = [turned[i : i + BLOCK] for i in range(0, d, BLOCK)]
            wanted = _matrix(queries.column("v"), d)
            around = wanted @ turn
            own, bounds = queries.column("id").to_numpy(), queries.column("bound").to_numpy()
            for j in range(len(own)):
                found, squares = scan(wanted[j], around[j], own[j], ids, rows, blocks, k, bounds[j])
                out_q.append(np.full(len(found), own[j]))
                out_i.append(found)
                out_s.append(squares)
        join = lambda xs, t: pa.array(np.concatenate([*xs, np.array([])]).astype(t))
        return pa.table({"query_id": join(out_q, np.int64), "id": join(out_i, np.int64), "square": join(out_s, np.float64)})

    return run


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query; Spark keeps ``k`` rows per query and task before it deals them."""
    order = Window.partitionBy("query_id").orderBy("square", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    base: DataFrame,
    is_query: str,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    lists: int | None = None,
    probes: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found for each row that ``is_query`` (SQL over ``id``) names.

    ``lists`` defaults to the square root of the number of vectors, ``probes`` to ``PROBE_SHARE`` of the lists.
    """
    spark = base.sparkSession
    ship(spark)
    schema = f"query_id long, rank int, {key} long, score double"
    sound, d = valid_vectors(base, key, vector)
    if not d:
        return spark.createDataFrame([], schema)
    sound = materialise(sound, "vectors")
    n = sound.count()
    lists = lists or max(1, round(n**0.5))
    # A sample by the hash of the id, the same in every run: TakeOrdered keeps SAMPLE rows per task at most.
    sample = sound.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).select("v").toArrow()
    centroids = fit_centroids(_matrix(sample.column("v"), d), lists)
    lists = len(centroids)
    probes = min(lists, probes or max(PROBE_LEAST, round(lists * PROBE_SHARE)))

    shared = "id long, v array<double>, lists array<int>"
    placed = materialise(
        sound.mapInArrow(_to_lists(centroids, d, 1), shared).select("id", "v", F.element_at("lists", 1).alias("list")), "lists"
    )
    parts = materialise(
        placed.groupBy("list").count().select("list", F.expr(f"cast(ceil(count / {PART}) AS int) AS parts")), "parts"
    )
    vectors = placed.join(parts, "list").withColumn("part", F.expr("cast(pmod(xxhash64(id), parts) AS int)"))
    asked = sound.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    asked = materialise(asked.mapInArrow(_to_lists(centroids, d, probes), shared), "queries")
    blocks = max(1, -(-asked.count() // QUERY_PART))
    vectors = vectors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def over(queries: DataFrame) -> DataFrame:
        spread = queries.join(parts, "list").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        return (
            spread.withColumn("block", F.expr(f"cast(pmod(xxhash64(id), {blocks}) AS int)"))
            .select("id", "v", "bound", "list", "part", "block")
            .groupBy("list", "part", "block")
            .cogroup(vectors.select("id", "v", "list", "part", "block").groupBy("list", "part", "block"))
            .applyInArrow(_search(d, k), "query_id long, id long, square double")
        )

    unbounded = F.lit(float("inf")).alias("bound")
    near = materialise(_nearest(over(asked.select("id", "v", F.element_at("lists", 1).alias("list"), unbounded)), k), "near")
    bounds = materialise(near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("square").alias("bound")), "bounds")
    others = (
        asked.join(bounds, "id", "left")
        .withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        .select("id", "v", "bound", F.explode(F.expr(f"slice(lists, 2, {max(1, probes)})")).alias("list"))
    )
    found = near.drop("rank").union(over(others).select("query_id", "id", "square"))
    return _nearest(found, k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), F.sqrt("square").alias("score")
    )
