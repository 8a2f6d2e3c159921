"""Token ids in binary shards, and a minimal perfect hash index from document key to place in a shard.

Files below ``path``:

* ``payload/shard-*.ids``: raw little-endian ids (16 bit where the vocabulary allows it, else 32), documents in ascending
  key order, nothing between them. A task writes its shard under a name of its own attempt; only names that the committed
  ``records`` hold are part of the store, so a lost or repeated task leaves a file that nobody reads.
* ``records``: one row per document (key, shard, file, offset and length in ids), as Spark committed it.
* ``manifest``: one row per shard with the ids of all shards before it.
* ``index``: one row per bucket of about ``BUCKET_KEYS`` keys. A key's slot is the rank of its bit in a cascade of bit
  arrays (keys that collide at one level go on to the next one), which is minimal and perfect on the keys of the bucket. Per slot:
  a 32-bit fingerprint of the key, which tells keys that were never stored, and shard, offset and length.

A lookup costs a bucket number, some bit tests, a rank and one read, whatever the size of the store.

Defined cases: NULL text is an empty document (only the end id). A NULL key is stored first and cannot be looked up. Rows
that repeat a key are stored side by side and all found by it. An empty table gives an empty store.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursemart.llm.common import Memo, encode_by_unit, file_system, ship, slices

BUCKET_KEYS = 1024
LEVELS = 24
FINGERPRINT_SEED = 101

#: Units that a worker's encoder remembers; at about 200 bytes each, some 200 MB.
STORE_UNITS = 1_000_000

RECORDS = "key long, shard int, file string, at long, n_ids long"
INDEX = (
    "bucket long, sizes array<int>, bits binary, leftover binary, fingerprints binary, first binary, copies binary, "
    "shard binary, at binary, n_ids binary, files array<string>"
)


# --- encoding -------------------------------------------------------------------------------------------------------


def text_encoder(tokenizer_json: str, width: str) -> Callable[[str], bytes]:
    """Text to packed ids with the tokenizers library, unit by unit with a bounded memo."""
    # A task is one core's work; the library would start a pool of threads in each worker.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    # A byte-level vocabulary writes each byte as one character, so the length of an entry is its length in bytes; so it is for an
    # added token in plain ASCII, which the library finds in a text by default.
    n_bytes = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for token, i in tokenizer.get_vocab().items():
        n_bytes[i] = len(token)
    step = np.dtype(width).itemsize

    def encoded(text: str) -> np.ndarray:
        # The same ids as from encode(), without the offsets that nobody reads.
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=width)

    def whole(text: str) -> bytes:
        return encoded(text).tobytes()

    def joined(parts: list[str]) -> list[bytes]:
        text = "".join(parts)
        ids = encoded(text)
        sizes = map(len, parts) if text.isascii() else (len(p.encode()) for p in parts)
        ends = np.cumsum(np.fromiter(sizes, dtype=np.int64, count=len(parts)))
        cuts = ((np.searchsorted(np.cumsum(n_bytes[ids]), ends) + 1) * step).tolist()
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    memo = Memo(STORE_UNITS)
    return lambda text: encode_by_unit(text, memo, joined, whole)


def id_width(tokenizer_json: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


_encoders: dict[tuple[int, str], Callable[[str], bytes]] = {}


def _encoder(tokenizer_json: str, width: str) -> Callable[[str], bytes]:
    """One encoder for all tasks of a Python worker."""
    key = (hash(tokenizer_json), width)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = text_encoder(tokenizer_json, width)
    return _encoders[key]


# --- writing --------------------------------------------------------------------------------------------------------


def write_store(docs: DataFrame, path: str, key: str, text: str, tokenizer_json: str, end_id: int) -> None:
    """Encode every text, append ``end_id`` and write the store to ``path`` (a folder that all executors share)."""
    spark = docs.sparkSession
    ship(spark)
    width = id_width(tokenizer_json, end_id)
    end = np.array([end_id], dtype=width).tobytes()
    step = len(end)
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(f"{path}/payload")
        out, at, name = None, 0, ""
        encode = _encoder(shared.value, width)
        try:
            for batch in slices(batches, "text"):
                if out is None:
                    shard = batch.column("shard")[0].as_py()
                    fs.create_dir(folder, recursive=True)
                    name = f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                starts, counts = [], []
                for value in batch.column("text").to_pylist():
                    packed = encode(value or "") + end
                    out.write(packed)
                    starts.append(at)
                    counts.append(len(packed) // step)
                    at += counts[-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        batch.column("shard"),
                        pa.array([name] * batch.num_rows),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["key", "shard", "file", "at", "n_ids"],
                )
        finally:
            if out is not None:
                out.close()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
        .repartitionByRange(n, F.col("key").asc_nulls_first())
        .withColumn("shard", F.spark_partition_id())
        .sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    )
    ordered.mapInArrow(write, RECORDS).write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    # One row per shard from here on.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (
        records.groupBy("shard", "file")
        .agg(F.sum("n_ids").alias("n_ids"), F.count("*").alias("n_documents"))
        .withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .withColumn("width", F.lit(width))
        .write.parquet(f"{path}/manifest")
    )
    write_index(records, f"{path}/index")


# --- the index ------------------------------------------------------------------------------------------------------


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over ``keys`` (unsigned), another function for each seed."""
    x = keys + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def perfect_levels(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays that give each of the distinct ``keys`` one bit of its own, and keys still without one."""
    levels, rest = [], keys
    while len(rest) and len(levels) < LEVELS:
        size = -(-2 * len(rest) // 64) * 64
        place = (_mix(rest, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size)[place] == 1
        bits = np.zeros(size, dtype=bool)
        bits[place[alone]] = True
        levels.append(bits)
        rest = rest[~alone]
    return levels, np.sort(rest)


def perfect_slots(levels: list[np.ndarray], leftover: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The slot of each key; for a key that is not stored, any slot, or -1."""
    slots = np.full(len(keys), -1, dtype=np.int64)
    open_, before = np.arange(len(keys)), 0
    for i, bits in enumerate(levels):
        place = (_mix(keys[open_], i) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[place]
        rank = np.cumsum(bits)
        slots[open_[hit]] = before + rank[place[hit]] - 1
        before += int(rank[-1])
        open_ = open_[~hit]
    if len(leftover) and len(open_):
        at = np.minimum(np.searchsorted(leftover, keys[open_]), len(leftover) - 1)
        found = leftover[at] == keys[open_]
        slots[open_[found]] = before + at[found]
    return slots


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


def _build_bucket(records: pa.Table) -> pa.Table:
    records = records.sort_by([("key", "ascending"), ("shard", "ascending"), ("at", "ascending")])
    raw = records.column("key").to_numpy()
    _, first, copies = np.unique(raw, return_index=True, return_counts=True)
    keys = raw[first].view(np.uint64)
    levels, leftover = perfect_levels(keys)
    slots = perfect_slots(levels, leftover, keys)
    by_slot = np.argsort(slots)
    files = sorted(set(records.column("file").to_pylist()))
    at_file = {name: i for i, name in enumerate(files)}
    file_no = np.array([at_file[x] for x in records.column("file").to_pylist()], dtype="<u4")
    row = {
        "bucket": records.column("bucket")[0].as_py(),
        "sizes": [len(x) for x in levels],
        "bits": np.packbits(np.concatenate(levels)).tobytes(),
        "leftover": leftover.tobytes(),
        "fingerprints": fingerprint(keys)[by_slot].tobytes(),
        "first": first[by_slot].astype("<u4").tobytes(),
        "copies": copies[by_slot].astype("<u4").tobytes(),
        "shard": file_no.tobytes(),
        "at": records.column("at").to_numpy().astype("<i8").tobytes(),
        "n_ids": records.column("n_ids").to_numpy().astype("<i8").tobytes(),
        "files": files,
    }
    types = [pa.int64(), pa.list_(pa.int32()), *[pa.binary()] * 8, pa.list_(pa.string())]
    return pa.table({k: pa.array([v], t) for (k, v), t in zip(row.items(), types, strict=True)})


def write_index(records: DataFrame, path: str) -> None:
    """Index the records that have a key; buckets hold about ``BUCKET_KEYS`` keys at any size of the store."""
    keyed = records.where("key IS NOT NULL")
    buckets = max(1, -(-keyed.count() // BUCKET_KEYS))
    (
        keyed.withColumn("bucket", F.expr(f"pmod(xxhash64(key), {buckets}L)"))
        .groupBy("bucket")
        .applyInArrow(_build_bucket, INDEX)
        .withColumn("buckets", F.lit(buckets).cast("long"))
        .write.parquet(path)
    )


def _search_bucket(keys: pa.Table, index: pa.Table) -> pa.Table:
    wanted = np.unique(keys.column("key").to_numpy()) if keys.num_rows else np.array([], dtype=np.int64)
    found = {"key": [], "file": [], "at": [], "n_ids": []}
    if len(wanted) and index.num_rows:
        row = index.slice(0, 1).to_pylist()[0]
        sizes = row["sizes"]
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), count=sum(sizes)).astype(bool)
        levels = np.split(bits, np.cumsum(sizes)[:-1])
        as_key = wanted.view(np.uint64)
        slots = perfect_slots(levels, np.frombuffer(row["leftover"], dtype=np.uint64), as_key)
        stored = np.frombuffer(row["fingerprints"], dtype=np.uint32)
        good = (slots >= 0) & (stored[np.maximum(slots, 0)] == fingerprint(as_key))
        first, copies = (np.frombuffer(row[c], dtype="<u4").astype(np.int64)[slots[good]] for c in ("first", "copies"))
        take = np.repeat(first, copies) + (np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies))
        found = {
            "key": np.repeat(wanted[good], copies),
            "file": [row["files"][i] for i in np.frombuffer(row["shard"], dtype="<u4")[take]],
            "at": np.frombuffer(row["at"], dtype="<i8")[take],
            "n_ids": np.frombuffer(row["n_ids"], dtype="<i8")[take],
        }
    types = {"key": pa.int64(), "file": pa.string(), "at": pa.int64(), "n_ids": pa.int64()}
    return pa.table({k: pa.array(v, types[k]) for k, v in found.items()})


def locate(keys: DataFrame, path: str, key: str) -> DataFrame:
    """Places (key, file, at, n_ids) of the records of each distinct key of ``keys`` that is stored."""
    ship(keys.sparkSession)
    index = keys.sparkSession.read.parquet(f"{path}/index")
    row = index.select("buckets").first()
    buckets = row["buckets"] if row else 1
    wanted = (
        keys.select(F.col(key).cast("long").alias("key"))
        .where("key IS NOT NULL")
        .distinct()
        .withColumn("bucket", F.expr(f"pmod(xxhash64(key), {buckets}L)"))
    )
    return (
        wanted.groupBy("bucket")
        .cogroup(index.drop("buckets").groupBy("bucket"))
        .applyInArrow(_search_bucket, "key long, file string, at long, n_ids long")
    )


def unkeyed(spark: SparkSession, path: str) -> DataFrame:
    """Places of the records without a key, which no lookup finds."""
    return spark.read.parquet(f"{path}/records").where("key IS NULL").select("key", "file", "at", "n_ids")


# --- reading --------------------------------------------------------------------------------------------------------


def read_payloads(places: DataFrame, path: str, schema: str, derive: Callable[[np.ndarray], tuple]) -> DataFrame:
    """Read the ids at ``places`` (key, file, at, n_ids); ``derive`` turns the ids of a document (32 bit) into the columns
    of ``schema``, which follow the columns of ``places`` and ``start``, the ids of all documents before it."""
    spark = places.sparkSession
    ship(spark)
    manifest = spark.read.parquet(f"{path}/manifest").select("file", F.col("start").alias("base"), "width")
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    out = f"key long, start long, n_ids long, {schema}"
    arrow = pa.schema([(n, t) for n, t in zip(names, _arrow_types(spark, schema), strict=True)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(f"{path}/payload")
        name, source = None, None
        try:
            for batch in batches:
                made = []
                for row in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_ids", "width")), strict=True):
                    file, at, n, width = row
                    if file != name:
                        if source is not None:
                            source.close()
                        name, source = file, fs.open_input_file(f"{folder}/{file}")
                    step = np.dtype(width).itemsize
                    made.append(derive(np.frombuffer(source.read_at(n * step, at * step), dtype=width).astype("<u4")))
                columns = list(zip(*made, strict=True)) if made else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        batch.column("start"),
                        batch.column("n_ids"),
                        *(pa.array(v, f.type) for v, f in zip(columns, arrow, strict=True)),
                    ],
                    names=["key", "start", "n_ids", *names],
                )
        finally:
            if source is not None:
                source.close()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        places.join(manifest, "file")
        .withColumn("start", F.col("base") + F.col("at"))
        .repartition(n, "file")
        .sortWithinPartitions("file", "at")
        .mapInArrow(read, out)
    )


def _arrow_types(spark: SparkSession, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in spark.createDataFrame([], schema).schema]
