"""What several corpus operators share: bounded Arrow batches, text units, bounded memos, files in the shared folder."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A task works on so many bytes of text at a time, however long the texts and however many rows a batch brings.
SLICE_BYTES = 4 << 20

#: Units a worker remembers before it starts anew; at about 150 bytes each this bounds a worker to some tens of MB.
MEMO_UNITS = 500_000


_shipped: set[str] = set()


def ship(spark) -> None:
    """Send this package's modules to the Python workers of a session that may not have the library installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="coursemart-ship-")) / "coursemart.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def literal_rows(spark, rows: list[tuple], names: list[str], kinds: list[str]) -> DataFrame:
    """A few rows given in the code, as one SQL expression."""
    values = F.array(
        *(F.struct(*(F.lit(v).cast(k).alias(n) for v, n, k in zip(row, names, kinds, strict=True))) for row in rows)
    )
    kind = ", ".join(f"{n}: {k}" for n, k in zip(names, kinds, strict=True))
    empty = F.expr(f"cast(array() AS array<struct<{kind}>>)")
    return spark.range(1, numPartitions=1).select(F.inline(values if rows else empty))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; one row is never cut."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def map_texts(
    df: DataFrame, text: str, schema: str, function: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> DataFrame:
    """``function`` over slices of ``df``; ``text`` is the column that bounds a slice."""

    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(function, slices(batches, text))

    return df.mapInArrow(run, schema)


#: Every blank of Python's \s (a superset of the blanks that tokenizer patterns know) but the space and the line feed.
_OTHER_BLANKS = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")


def units(text: str) -> list[str] | None:
    """Cuts a text before every single space and line feed between two visible characters; None if it has other blanks.

    No match of a byte-level pattern runs across such a cut, so the units can be encoded on their own. A unit of the
    result stands for itself where it begins with a line feed, and for a space and itself elsewhere, but the first one.
    """
    if (
        not text
        or "  " in text
        or "\n\n" in text
        or " \n" in text
        or "\n " in text
        or text[0] in " \n"
        or text[-1] in " \n"
        or any(c in text for c in _OTHER_BLANKS)
    ):
        return None
    return text.replace("\n", " \n").split(" ")


class Memo:
    """What units were encoded to, in two generations: when the young one holds half of ``limit``, it becomes the old one, from which
    units that are met again come back; the others are forgotten with the next change."""

    def __init__(self, limit: int = MEMO_UNITS):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.half = limit // 2

    def missing(self, units_: set[str]) -> list[str]:
        """Those of ``units_``, which the young generation lacks, that the old one lacks too; the others are in the young one afterwards."""
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        known = [u for u in units_ if u in self.old]
        self.young.update((u, self.old[u]) for u in known)
        return list(units_.difference(known))


def look_up(parts: list[str], memo: Memo, encode_units: Callable[[list[str]], list[bytes]]) -> list[bytes]:
    """What each of ``parts`` is encoded to; those that ``memo`` does not know are encoded together."""
    packed = list(map(memo.young.get, parts))
    if None in packed:
        new = memo.missing({u for u, p in zip(parts, packed, strict=True) if p is None})
        if new:
            memo.young.update(zip(new, encode_units(new), strict=True))
        packed = [memo.young[u] if p is None else p for u, p in zip(parts, packed, strict=True)]
    return packed


def encode_by_unit(
    text: str,
    memo: Memo,
    encode_units: Callable[[list[str]], list[bytes]],
    encode_text: Callable[[str], bytes],
) -> bytes:
    """The encoding of a whole text, of which each unit is encoded when first met and looked up later.

    ``memo`` belongs to one encoder. Texts with other blanks go to ``encode_text``.
    """
    parts = units(text)
    if parts is None:
        return encode_text(text)
    first = encode_text(parts[0])
    del parts[0]
    return first + b"".join(look_up(parts, memo, lambda new: encode_units([u if u[0] == "\n" else " " + u for u in new])))


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    if not urlparse(uri).scheme:
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def key_order(column: str):
    """Ascending, NULL first: the order in which Spark sorts by default, spelled out."""
    return F.col(column).asc_nulls_first()
