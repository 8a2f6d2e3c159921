"""SentencePiece encoding through a table of distinct marked words, and decoding of whole id lists.

A SentencePiece model that splits by whitespace never lets a piece run across the start of a marked word: a run of whitespace
markers (``▁``; a space becomes one) and the characters up to the next marker. With the identity normaliser and a dummy prefix,
the ids of a text are the ids of its marked words, in order, each word encoded alone. Spark counts all words of the corpus; those met in at least ``HOT_SHARE`` of all places (short ones only, so the
table has a proven size) are encoded once and broadcast as a table of words and ids. The task that holds a text joins its words with
that table; of the other words, each is encoded by the library where it is met and remembered, within a bound, by the worker. So
neither texts nor ids nor places are shuffled, only the counts.

Where a model does not meet these conditions (another normaliser, no dummy prefix, no split by whitespace, whitespace as suffix),
each whole text is one word and is encoded by itself: slower, never wrong.

Defined cases: a NULL text is empty and gets only the begin and end ids. The ids of one document are in one row, as large as the
document. Repeated rows (also repeated ids with other texts) are encoded each on its own. Other columns of the table, whatever their
names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.llm.common import Memo, look_up, ship, slices
from coursemart.session import materialise

#: The whitespace marker of SentencePiece; a space of the input becomes one.
MARKER = "▁"

#: A word met in at least this share of all places is broadcast, if it is short; at most 1 / HOT_SHARE words are.
HOT_SHARE = 1 / (1 << 18)
#: Longest word (code points) that may be broadcast, so that the broadcast table has a bound of its own.
HOT_CHARS = 256

#: Bytes of text whose words are looked up together; the unknown ones go to the library in one call, which has a price of its own.
LOOK_UP_BYTES = 1 << 18

_SPACED = re.compile(r" +[^ ]+| +\Z")

_processors: dict[bytes, object] = {}
_memos: dict[bytes, Memo] = {}


def processor(model: bytes):
    """One SentencePiece processor per model and worker."""
    digest = hashlib.sha256(model).digest()
    if digest not in _processors:
        import sentencepiece

        _processors[digest] = sentencepiece.SentencePieceProcessor(model_proto=model)
    return _processors[digest]


def splits_by_words(model: bytes) -> bool:
    """Whether no piece of ``model`` can run across the start of a marked word (see the module text)."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    normaliser, trainer = proto.normalizer_spec, proto.trainer_spec
    user_symbols = [p.piece for p in proto.pieces if p.type == p.USER_DEFINED]
    return (
        normaliser.name == "identity"
        and not normaliser.remove_extra_whitespaces
        and normaliser.add_dummy_prefix
        and trainer.split_by_whitespace
        and not trainer.treat_whitespace_as_suffix
        and not any(MARKER in s or " " in s for s in user_symbols)
    )


def encode_word(sp, word: str, lone: list[int]) -> list[int]:
    """Ids of a marked word: the dummy prefix stands for its first marker."""
    return lone if word == MARKER else sp.encode(word[1:], out_type=int)


def lone_marker(sp) -> list[int]:
    """Ids of a word that is one marker and nothing else (a single space at the end of a text), as the model gives them."""
    return sp.encode("x ", out_type=int)[len(sp.encode("x", out_type=int)) :]


def chunks(text: str) -> list[str]:
    """The marked words of a text in order, each without its first marker; further markers are spaces, as which they encode alike."""
    if not text:
        return []
    spaced = text.replace(MARKER, " ")
    if "  " not in spaced and spaced[0] != " " and spaced[-1] != " ":
        return spaced.split(" ")
    return [word[1:] for word in _SPACED.findall(" " + spaced)]


def marked_words(text: str) -> list[str]:
    """The marked words of a text in order (for tests and plain use)."""
    return [MARKER + c for c in chunks(text)]


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, n) for every distinct marked word, without its first marker; a word behind several blanks counts as if behind one."""
    body = F.translate(F.col(f"`{text}`").cast("string"), MARKER, " ")
    words = docs.select(F.explode(F.split(body, " ")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _chunk_encoder(sp) -> Callable[[list[str]], list[bytes]]:
    """Packed ids of marked words that come without their first marker, for which the dummy prefix stands."""
    lone = lone_marker(sp)

    def run(words: list[str]) -> list[bytes]:
        ids = [i if w else lone for w, i in zip(words, sp.encode(words, out_type=int, num_threads=1), strict=True)]
        whole = array("i", chain.from_iterable(ids)).tobytes()
        return [whole[4 * a : 4 * b] for a, b in pairwise(accumulate(map(len, ids), initial=0))]

    return run


def encode_words(words: DataFrame, model: bytes) -> DataFrame:
    """(word, ids) for every row of ``words``; ``ids`` are packed 32-bit integers."""
    ship(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_new = _chunk_encoder(processor(model))
        for batch in slices(batches, "word"):
            packed = encode_new(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(packed, pa.binary())], names=["word", "ids"])

    return words.select("word").mapInArrow(run, "word string, ids binary")


def hot_words(docs: DataFrame, text: str, model: bytes) -> dict[str, bytes]:
    """Packed ids of the words that are met in at least ``HOT_SHARE`` of all places and are short: at most ``1 / HOT_SHARE`` words."""
    counts = materialise(word_counts(docs, text), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where((F.col("n") >= F.lit(max(2.0, total * HOT_SHARE))) & (F.length("word") <= HOT_CHARS))
    return {r["word"]: bytes(r["ids"]) for r in encode_words(hot, model).collect()}


def texts_encoder(sp, hot: dict[str, bytes], memo: Memo) -> Callable[[list[str]], list[bytes]]:
    """Texts to packed ids: a word's ids come from the table of hot words, or else from the worker's memo, for all the texts together."""
    encode_new = _chunk_encoder(sp)

    def run(texts: list[str]) -> list[bytes]:
        parts = list(map(chunks, texts))
        words = list(chain.from_iterable(parts))
        packed = list(map(hot.get, words))
        if None in packed:
            rest = iter(look_up([w for w, p in zip(words, packed, strict=True) if p is None], memo, encode_new))
            packed = [next(rest) if p is None else p for p in packed]
        ids = iter(packed)
        return [b"".join(islice(ids, len(part))) for part in parts]

    return run


def text_encoder(sp, hot: dict[str, bytes], memo: Memo) -> Callable[[str], bytes]:
    """``texts_encoder`` for one text at a time."""
    encode_texts = texts_encoder(sp, hot, memo)
    return lambda text: encode_texts([text])[0]


def encode(docs: DataFrame, text: str, model: bytes, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``ids`` (array of int, begin and end ids included) for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    by_words = splits_by_words(model)
    shared = spark.sparkContext.broadcast(hot_words(docs, text, model) if by_words else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        if by_words:
            memo = _memos.setdefault(hashlib.sha256(model).digest(), Memo())
            encode_texts = texts_encoder(sp, shared.value, memo)
        else:
            encode_texts = lambda texts: [array("i", sp.encode(t, out_type=int)).tobytes() for t in texts]
        begin, end = array("i", [sp.bos_id()]).tobytes(), array("i", [sp.eos_id()]).tobytes()
        for batch in slices(batches, "_text", LOOK_UP_BYTES):
            packed = [begin + ids + end for ids in encode_texts([t or "" for t in batch.column("_text").to_pylist()])]
            at = np.cumsum([0, *map(len, packed)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids], names=[*(f"_k{i}" for i in range(len(keep))), "ids"])

    # Only names of its own inside, whatever the table's columns are called; ``keep`` gets its names back at the end.
    rows = docs.select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = T.StructType([*rows.schema.fields[: len(keep)], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    done = rows.mapInArrow(run, schema)
    return done.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "ids")


def id_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` ids of list column ``column``; one row is never cut."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.list_value_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def id_arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each row as a view of the column's buffer (none for NULL); a NULL among the ids is an error."""
    values = column.values.to_numpy()
    for (a, b), known in zip(pairwise(column.offsets.to_pylist()), column.is_valid().to_pylist(), strict=True):
        yield values[a : b if known else a]


def digests(df: DataFrame, ids: str, model: bytes, keep: list[str]) -> DataFrame:
    """``keep``, n_tokens, ids_sha256 (ids as little-endian uint32) and decoded_sha256 (of the library's decode of all ids)."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for batch in id_slices(batches, "_ids"):
            n, ids_hex, text_hex = [], [], []
            for values in id_arrays(batch.column("_ids")):
                n.append(len(values))
                ids_hex.append(hashlib.sha256(values.astype("<u4", copy=False)).hexdigest())
                text_hex.append(hashlib.sha256(sp.decode(values).encode("utf-8")).hexdigest())
            columns = [batch.column(c) for c in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex)],
                names=[*(f"_k{i}" for i in range(len(keep))), "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    packed = df.select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)), F.col(f"`{ids}`").alias("_ids"))
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    done = packed.mapInArrow(run, T.StructType([*packed.schema.fields[: len(keep)], *added]))
    return done.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "n_tokens", "ids_sha256", "decoded_sha256")
