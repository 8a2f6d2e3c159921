"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. Of two fingerprints that differ in two bits at most, some segment
is equal in both, and the next one differs in two bits at most. The binary Golay code is perfect: every
23-bit word lies within three bits of exactly one codeword. A segment's keys are the codewords of itself and of all words one bit away
(one codeword or six), so two segments two bits apart share the codeword of the word between them. Joined on (equal segment,
codeword of the next one), fingerprints meet that may be near, and are compared bit by bit.

Fingerprints that meet under a key are not paired with each other one by one: what leaves a key is a star per set of
fingerprints that hang together, as many links as fingerprints at most. A key with many fingerprints looks up the neighbours of
each instead of comparing all. Equal fingerprints count once throughout.

Defined cases: NULL text and text without words have fingerprint zero and are linked like any other. Rows without an id take no part
in linking and get no component. Rows that repeat an id share its component if their texts do. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.llm.common import map_texts, ship
from coursemart.llm.components import connected_components
from coursemart.session import materialise

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the (23, 12) Golay code; a fixed value.
GENERATOR = 0b101011100011
#: Fingerprints under one key from which neighbours are looked up.
MANY = 2048


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of the XXH64 of the word shingles, unsigned."""
    import xxhash

    words = text.encode().lower().split()  # bytes: lower() maps A-Z only, split() takes ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 14):
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(key, fp) of every row; fp as a signed 64-bit number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(x or "", shingle) for x in batch.column("text").to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made.view(np.int64))], names=["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return map_texts(rows, "text", "key long, fp long", run)


# --- keys -----------------------------------------------------------------------------------------------------------


def _remainder(word: int) -> int:
    for i in range(22, 10, -1):
        if word >> i & 1:
            word ^= GENERATOR << i - 11
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the lower 12 and upper 11 bits, and the error that each remainder stands for."""
    low = np.array([_remainder(x) for x in range(1 << 12)], dtype=np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], dtype=np.int64)
    errors = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            errors[_remainder(word)] = word
    return low, high, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The number (12 bits) of the codeword nearest to each 23-bit word."""
    low, high, errors = _tables()
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def segment_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index), each distinct: the codewords of each word and of the words one bit away."""
    flips = np.array([0, *(1 << i for i in range(width))], dtype=np.int64)
    near = np.sort(codeword_index(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(near.shape, dtype=bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    row, at = np.nonzero(new)
    return row, near[row, at]


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that two fingerprints (unsigned) at two bits or fewer share a key."""
    parts = [(fps >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        follow = (i + 1) % 3
        row, index = segment_keys(parts[follow], SEGMENTS[follow][1])
        rows.append(row)
        keys.append(i << 34 | parts[i][row] << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, reps = batch.column("fp").to_numpy(), batch.column("rep").to_numpy()
        for i in range(0, len(fps), 4096):
            row, key = fuzzy_keys(fps[i : i + 4096].view(np.uint64))
            row += i
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(fps[row]), pa.array(reps[row])], names=["key", "fp", "rep"]
            )


# --- links ----------------------------------------------------------------------------------------------------------


def near_pairs(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of distinct fingerprints (unsigned, ascending) that link, enough to connect all that do."""
    n = len(fps)
    left, right = [], []
    if n <= MANY:
        for i in range(0, n, 256):
            a, b = np.nonzero(np.bitwise_count(fps[i : i + 256, None] ^ fps[None, :]) <= max_bits)
            keep = a + i < b
            left.append(a[keep] + i)
            right.append(b[keep])
    else:
        for weight in range(1, max_bits + 1):
            for bits in combinations(range(64), weight):
                other = fps ^ np.uint64(sum(1 << b for b in bits))
                at = np.minimum(np.searchsorted(fps, other), n - 1)
                hit = np.nonzero((fps[at] == other) & (other > fps))[0]
                left.append(hit)
                right.append(at[hit])
    none = [np.array([], dtype=np.int64)]
    return np.concatenate([*left, *none]).astype(np.int64), np.concatenate([*right, *none]).astype(np.int64)


def stars(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least node that the pairs connect it with."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _links_of(keys: np.ndarray, fps: np.ndarray, reps: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links among rows sorted by (key, fp), runs of equal keys complete."""
    cuts = np.nonzero(np.diff(keys))[0] + 1
    begin, end = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    size = (end - begin)[np.searchsorted(cuts, np.arange(len(keys)), side="right")]
    left, right = [], []
    # Short runs all at once, by distance within the run; long ones one by one.
    short = np.nonzero((size > 1) & (size <= 32))[0]
    for step in range(1, 32):
        short = short[short + step < len(keys)]
        short = short[keys[short + step] == keys[short]]
        if not len(short):
            break
        near = short[np.bitwise_count(fps[short] ^ fps[short + step]) <= max_bits]
        left.append(near)
        right.append(near + step)
    for i in np.nonzero(end - begin > 32)[0]:
        a, b = near_pairs(fps[begin[i] : end[i]], max_bits)
        left.append(a + begin[i])
        right.append(b + begin[i])
    a = np.concatenate([*left, np.array([], dtype=np.int64)]).astype(np.int64)
    b = np.concatenate([*right, np.array([], dtype=np.int64)]).astype(np.int64)
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = nodes[stars(len(nodes), at[: len(a)], at[len(a) :])] if len(nodes) else nodes
    off = label != nodes
    return pa.RecordBatch.from_arrays([pa.array(reps[nodes[off]]), pa.array(reps[label[off]])], names=["a", "b"])


def _verify(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("key", "fp", "rep")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            # The last run may go on in the next batch.
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if cut:
                yield _links_of(now[0][:cut], now[1][:cut].view(np.uint64), now[2][:cut], max_bits)
            rest = [x[cut:] for x in now]
        if rest is not None and len(rest[0]):
            yield _links_of(rest[0], rest[1].view(np.uint64), rest[2], max_bits)

    return run


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(key, fp, component_id) of every row: the smallest key that can be reached over links of ``max_bits`` or fewer."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys find fingerprints at {MAX_BITS} bits or fewer")
    spark = docs.sparkSession
    ship(spark)
    marked = materialise(fingerprints(docs, key, text, shingle), "fingerprints")
    classes = components_of(marked, max_bits)
    component = F.when(F.col("key").isNotNull(), F.col("component_id"))
    return marked.join(classes, "fp", "left").select(
        F.col("key").alias(key), "fp", component.alias("component_id")
    )


def components_of(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) for every fingerprint of a row with a key in ``marked`` (key, fp).

    Fingerprints are the nodes: two texts of one key are one node only if their fingerprints are. A component's id is the least key
    of its rows.
    """
    spark = marked.sparkSession
    distinct = materialise(marked.where("key IS NOT NULL").groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows are dealt by key and sorted in the order of unsigned fingerprints.
    met = (
        distinct.select("fp", F.col("fp").alias("rep"))
        .mapInArrow(_explode, "key long, fp long, rep long")
        .repartition(n, "key")
        .sortWithinPartitions("key", F.expr("fp >= 0").desc(), "fp")
    )
    links = met.mapInArrow(_verify(max_bits), "a long, b long")
    roots = connected_components(links).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # One row per component, from a partial aggregate: a component of any size sends one row per task.
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialise(placed.join(least, "root").select("fp", "component_id"), "classes")


def as_hex(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: a row whose key is the group's least.

    Decided per row, by its key and fingerprint: a text of a kept key that resembles nothing else stays. Rows without a key stay.
    Of several rows with the group's least key (repeated rows), the one with the least fingerprint stays, then the least SHA-256
    of the row as JSON (any column type; only such rows are digested). The other columns are carried whatever their names.
    """
    fp = _fresh("_fp", docs.columns)
    marked = materialise(with_fingerprint(docs, key, text, fp, shingle), "marked")
    classes = components_of(marked.select(F.col(key).cast("long").alias("key"), F.col(fp).alias("fp")))
    comp = _fresh("_component", docs.columns)
    rows = marked.join(classes.withColumnsRenamed({"fp": fp, "component_id": comp}), fp, "left")
    no_key = rows.where(F.col(key).isNull()).select(*(F.col(f"`{c}`") for c in docs.columns))
    cand = rows.where(F.col(key).cast("long") == F.col(comp))
    many = cand.groupBy(comp).count().where("count > 1").select(comp)
    single = cand.join(many, comp, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    digest = _fresh("_digest", docs.columns)
    tied = cand.join(many, comp, "left_semi").withColumn(
        digest, F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))), 256)
    )
    best = tied.groupBy(comp).agg(F.min(F.struct(fp, digest)).alias("_best")).select(
        comp, F.col("_best").getField(fp).alias(fp), F.col("_best").getField(digest).alias(digest)
    )
    # Rows equal in fingerprint and digest are equal rows: any one of them is the one.
    won = tied.join(best, [comp, fp, digest], "left_semi").dropDuplicates([comp])
    return single.unionByName(won.select(*(F.col(f"`{c}`") for c in docs.columns))).unionByName(no_key)


def _fresh(name: str, taken: list[str]) -> str:
    while name in taken:
        name = "_" + name
    return name


def with_fingerprint(docs: DataFrame, key: str, text: str, fp: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Every column of ``docs`` and the fingerprint of ``text`` as ``fp`` (signed 64-bit)."""
    tmp = _fresh("_text", docs.columns)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(tmp).to_pylist()
        made = np.array([fingerprint(x or "", shingle) for x in texts], dtype=np.uint64)
        cols = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != tmp]
        names = [n for n in batch.schema.names if n != tmp]
        return pa.RecordBatch.from_arrays([*cols, pa.array(made.view(np.int64))], names=[*names, fp])

    rows = docs.select(*(F.col(f"`{c}`") for c in docs.columns), F.col(f"`{text}`").cast("string").alias(tmp))
    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])
    return map_texts(rows, tmp, schema, run)
