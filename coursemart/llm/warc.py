"""WARC archives: a sharded writer whose files depend on the records alone, and a reader.

Records are dealt by ranges of the page id and sorted in each; a task writes its range into files that it rolls by compressed size. Headers
and digests are made anew for every record, record ids and gzip members from the record's content and fixed times only, so
a task that runs twice writes the same bytes. A file gets a temporary name while it is written and is then moved to its own; the
manifest, committed by Spark, names the files of the archive with records, size and digest, and a reader opens no other.

Of equal payloads of ``least_bytes`` or more, the record with the smallest page id is the response and the others are revisits
that refer to it and carry no payload. Which page a revisit refers to travels with the payloads through the one shuffle by range:
a small row for each revisit sorts just before the payload of its page.

Defined cases: NULL html is an empty payload and a NULL url an empty target. A page without an id is a response unless a page with one has the
same payload. Rows that repeat the smallest id are all responses. An empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from io import BytesIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.llm.common import file_system, ship, slices
from coursemart.session import materialise

ROLL_BYTES = 32 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
NAMES = uuid.UUID("8d0f4a52-63f1-4d0e-9f0a-6c1f3e1b7a11")
MANIFEST = "file string, records long, bytes long, sha1 string, first_id long, last_id long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    "record_id string, payload binary"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record(page_id: int | None, copy: int, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, uncompressed."""
    digest = digest_of(payload)
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = status if revisit else status + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{copy}/{digest}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(NAMES, f'{refers_to}/0/{digest}')}>"),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    fields += [
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without time or name."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """A file under a temporary name until it is finished."""

    def __init__(self, fs, folder: str, name: str):
        self.fs, self.folder, self.name = fs, folder, name
        self.temporary = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
        self.out = fs.open_output_stream(self.temporary, compression=None)
        self.bytes, self.records, self.sha1, self.first, self.last = 0, 0, hashlib.sha1(), None, None

    def add(self, page_id: int | None, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.bytes += len(data)
        self.first = page_id if not self.records else self.first
        self.records, self.last = self.records + 1, page_id

    def finish(self) -> tuple:
        self.out.close()
        self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        return self.name, self.records, self.bytes, self.sha1.hexdigest(), self.first, self.last


def _write(path: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(f"{path}/archive")
        fs.create_dir(folder, recursive=True)
        done, file, rolled = [], None, 0
        refers: dict[str, int] = {}
        copies: dict[str, int] = {}
        page = object()
        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                if row["page_id"] != page:
                    # Copies are numbered per page and payload, so that copy 0 of (page, payload) is the record a revisit names.
                    page, copies, refers = row["page_id"], {}, {}
                if row["refers_to"] is not None or row["kind"] == 0:
                    refers[row["digest"]] = row["refers_to"]
                    continue
                target = refers.get(row["digest"])
                if file is None:
                    file = _File(fs, folder, f"part-{row['shard']:06d}-{rolled:04d}.warc.gz")
                    rolled += 1
                copy = copies.get(row["digest"], 0)
                copies[row["digest"]] = copy + 1
                data = record(page, copy, row["url"] or "", row["html"], target, target is not None)
                file.add(page, _member(data))
                if file.bytes >= roll:
                    done.append(file.finish())
                    file = None
        if file is not None:
            done.append(file.finish())
        columns = list(zip(*done, strict=True)) if done else [[]] * 6
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["file", "records", "bytes", "sha1", "first_id", "last_id"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def write_archive(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write ``pages`` to ``path`` (in a folder that all executors share) and return the manifest."""
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("html"),
    ).withColumn("digest", F.sha1("html"))
    # Digests and ids only: a payload that a third of the pages share is one row per task here.
    narrow = materialise(rows.select("page_id", "digest", F.octet_length("html").alias("n")), "payloads")
    shared = materialise(
        narrow.where(f"n >= {least_bytes}").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("m")).where("m > 1"),
        "shared",
    )
    revisits = narrow.join(shared, "digest").where("first IS NOT NULL AND NOT page_id <=> first").select(
        "page_id", F.lit(0).alias("kind"), "digest", F.col("first").alias("refers_to"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"),
    ).distinct()
    payloads = rows.select("page_id", F.lit(1).alias("kind"), "digest", F.lit(None).cast("long").alias("refers_to"), "url", "html")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        payloads.union(revisits)
        .repartitionByRange(n, F.col("page_id").asc_nulls_first())
        .withColumn("shard", F.spark_partition_id())
        .sortWithinPartitions(F.col("page_id").asc_nulls_first(), "kind", "digest", "url")
    )
    ordered.mapInArrow(_write(path, roll_bytes), MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzipped WARC stream, one gzip member at a time."""
    unpacker, data = zlib.decompressobj(31), BytesIO()
    rest = stream.read(1 << 20)
    while rest:
        data.write(unpacker.decompress(rest))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield _parse(data.getvalue())
            unpacker, data = zlib.decompressobj(31), BytesIO()
        if not rest:
            rest = stream.read(1 << 20)
    if data.tell():
        raise ValueError("the archive ends within a record")


def _parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{digest_of(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block


def _read(path: str, with_payload: bool):
    def made(fields: dict[str, str], block: bytes) -> tuple:
        payload = block.partition(b"\r\n\r\n")[2]
        revisit = fields["WARC-Type"] == "revisit"
        number = lambda k: int(fields[k]) if fields.get(k) else None
        return (
            number("X-Page-Id"),
            fields["WARC-Target-URI"],
            fields["WARC-Type"],
            int(fields["X-Payload-Length"]) if revisit else len(payload),
            fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else digest_of(payload),
            number("X-Refers-To-Page"),
            fields["WARC-Record-ID"],
            payload if with_payload and not revisit else None,
        )

    types = [pa.int64(), *[pa.string()] * 2, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id", "payload"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(f"{path}/archive")
        for files in batches:
            for name in files.column("file").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for fields, block in records_of(stream):
                        rows.append(made(fields, block))
                        held += 500 + with_payload * len(block)
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the archive's files, checked against their digests; a revisit has no payload of its own."""
    ship(spark)
    files = spark.read.parquet(f"{path}/manifest").select("file")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, "file").mapInArrow(_read(path, with_payload), RECORD)
