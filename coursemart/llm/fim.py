"""Fill-in-the-middle by in-place block rotation, and its exact inverse.

A text is cut into tokens (runs of ASCII letters, or any other single code point). Two cut points, drawn from a digest of the
row's key, split it into prefix, middle and suffix. The UTF-8 bytes go into one bytearray; the segments are exchanged there by
rotations made of three reversals, and the three sentinels are inserted at their places. Restoring finds the sentinels, takes
them out and applies the inverse rotation, so the text comes back byte for byte.

    psm:   <P> prefix <S> suffix <M> middle      (prefix | middle suffix  ->  prefix | suffix middle)
    spm:   <S> suffix <P> prefix <M> middle      (prefix middle | suffix  ->  suffix | prefix middle)

Defined cases: a NULL text is empty. An empty text, a text that already holds a sentinel, and a row whose draw says so stay
plain (output = text, chars NULL); so does a row with a NULL key, which has nothing to draw from. Very long texts are handled whole,
in time and memory linear in their bytes; Arrow batches are cut by bytes of text. Repeated rows get equal results, rows of one key
with other texts their own. The other columns of the table, whatever their names or types, are passed through unchanged; the
result goes into one struct column (``out``), which replaces a column of that name. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.llm.common import ship, slices

#: Fixed values of the format: the three sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)

RESULT_TYPE = T.StructType(
    [T.StructField(name, T.LongType() if kind == "long" else T.StringType()) for name, kind in (
        ("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string"),
    )]
)


def reverse(buf: bytearray, begin: int, end: int) -> None:
    """Reverses ``buf[begin:end]`` in place."""
    buf[begin:end] = buf[begin:end][::-1]


def rotate(buf: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchanges the blocks ``buf[begin:cut]`` and ``buf[cut:end]`` by three reversals: AB -> (A'B')' = BA."""
    reverse(buf, begin, cut)
    reverse(buf, cut, end)
    reverse(buf, begin, end)


def token_starts(text: str) -> np.ndarray:
    """Code point offsets where the tokens ``[A-Za-z]+|[^A-Za-z]`` begin."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    letter = ((points >= 65) & (points <= 90)) | ((points >= 97) & (points <= 122))
    joined = np.zeros(len(points), dtype=bool)
    joined[1:] = letter[1:] & letter[:-1]
    return np.flatnonzero(~joined)


def utf8_offsets(text: str) -> np.ndarray:
    """Byte offset of every code point of ``text`` in its UTF-8 form, and the length at the end."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))


def draws(key: int, salt: str = "1") -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the hex SHA-256 of ``<salt>:<key>``, as unsigned integers."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))  # type: ignore[return-value]


def transform(
    text: str | None, key: int | None, salt: str = "1", plain_pct: int = 10, spm_pct: int = 20
) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    starts = token_starts(text)
    n = len(starts)
    if key is None or not text or any(s in text for s in SENTINELS):
        return n, "plain", None, None, text
    h1, h2, h3, h4 = draws(key, salt)
    if h3 % 100 >= 100 - plain_pct:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    points = np.append(starts, len(text))
    offsets = utf8_offsets(text)
    cut_a, cut_b = int(offsets[points[a]]), int(offsets[points[b]])
    buf = bytearray(text.encode("utf-8"))
    end = len(buf)
    if h4 % 100 < spm_pct:
        form = "spm"
        rotate(buf, 0, cut_b, end)  # prefix middle | suffix -> suffix | prefix middle
        s = end - cut_b
        buf[s + cut_a : s + cut_a] = MIDDLE.encode()
        buf[s:s] = PREFIX.encode()
        buf[0:0] = SUFFIX.encode()
    else:
        form = "psm"
        rotate(buf, cut_a, cut_b, end)  # middle | suffix -> suffix | middle
        buf[cut_a + end - cut_b : cut_a + end - cut_b] = MIDDLE.encode()
        buf[cut_a:cut_a] = SUFFIX.encode()
        buf[0:0] = PREFIX.encode()
    return n, form, int(points[a]), int(points[b] - points[a]), buf.decode("utf-8")


def restore(output: str | None, form: str | None) -> str:
    """The text that ``transform`` turned into ``output``: sentinels out, rotation undone."""
    output = output or ""
    if form not in ("psm", "spm"):
        return output
    buf = bytearray(output.encode("utf-8"))
    width = len(PREFIX)
    if form == "psm":
        s_at = buf.find(SUFFIX.encode(), width)
        m_at = buf.find(MIDDLE.encode(), s_at + width)
        del buf[m_at : m_at + width]
        del buf[s_at : s_at + width]
        del buf[0:width]
        # prefix | suffix | middle: bring middle before suffix.
        prefix, suffix = s_at - width, m_at - s_at - width
        rotate(buf, prefix, prefix + suffix, len(buf))
    else:
        p_at = buf.find(PREFIX.encode(), width)
        m_at = buf.find(MIDDLE.encode(), p_at + width)
        del buf[m_at : m_at + width]
        del buf[p_at : p_at + width]
        del buf[0:width]
        # suffix | prefix middle: bring prefix and middle before suffix.
        rotate(buf, 0, p_at - width, len(buf))
    return buf.decode("utf-8")


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "fim", salt: str = "1",
    plain_pct: int = 10, spm_pct: int = 20,
) -> DataFrame:
    """Every row of ``df`` with struct ``out`` (n, form, prefix_chars, middle_chars, output) added; see the module text."""
    ship(df.sparkSession)
    names = [c for c in df.columns if c != out]
    packed = df.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.col(f"`{key}`").cast("long").alias("key"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    schema = T.StructType([packed.schema["row"], T.StructField("result", RESULT_TYPE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
            results = [transform(t, k, salt, plain_pct, spm_pct) for k, t in zip(keys, texts, strict=True)]
            columns = list(zip(*results, strict=True)) if results else [[]] * 5
            fields = pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                names=["n", "form", "prefix_chars", "middle_chars", "output"],
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), fields], names=["row", "result"])

    done = packed.mapInArrow(run, schema)
    return done.select(*(F.col("row").getField(c).alias(c) for c in names), F.col("result").alias(out))


def restore_column(df: DataFrame, output: str, form: str, name: str = "restored") -> DataFrame:
    """``df`` with the text restored from columns ``output`` and ``form`` as ``name`` (replacing a column of that name)."""
    ship(df.sparkSession)
    names = [c for c in df.columns if c != name]
    packed = df.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.col(f"`{output}`").cast("string").alias("output"),
        F.col(f"`{form}`").cast("string").alias("form"),
    )
    schema = T.StructType([packed.schema["row"], T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            pairs = zip(batch.column("output").to_pylist(), batch.column("form").to_pylist(), strict=True)
            restored = pa.array([restore(o, f) for o, f in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), restored], names=["row", "restored"])

    done = packed.mapInArrow(run, schema)
    return done.select(*(F.col("row").getField(c).alias(c) for c in names), F.col("restored").alias(name))
