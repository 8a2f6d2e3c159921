"""Registered queries of the operators and, where SQL can say it, the DuckDB text for the same rows.

Each query applies its operator, with the parameters that production would use, to its whole table and derives the digest columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.llm import ann, bpe, fim, host_rules, licenses, mixing, pieces, quality, resample, secrets, simhash, token_store, warc
from coursemart.llm.common import table
from coursemart.llm.oracles import SQL
from coursemart.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Id that ends a document in the token store.
END_ID = 2


def query(name: str):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if name in SQL:
            ORACLES[name] = SQL[name]
        return function

    return register


def vocabulary(name: str) -> str:
    """Where the file of a public tokenizer is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_host_rules")
def op1_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_host_rules(table(spark, sf_dir, "documents")).drop("n_lines")


@query("op2_token_store")
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and write, then look every document's key up in the index and read its ids."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "tokens")
    tokenizer = Path(vocabulary("byte_bpe_50k.json")).read_text(encoding="utf-8")
    token_store.write_store(docs, path, "doc_id", "text", tokenizer, END_ID)
    places = token_store.locate(docs, path, "doc_id").union(token_store.unkeyed(spark, path))
    read = token_store.read_payloads(places, path, "ids_crc32 long", lambda ids: (zlib.crc32(ids.tobytes()),))
    return read.select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


@query("op3_pfair_mix")
def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query("op4_warc")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op5_simhash_golay")
def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query("op6_license_digests")
def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op7_secret_trigrams")
def op7_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *secrets.digest_columns("_spans"))


@query("op8_bpe_transducer")
def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame, keep: Sequence[str] = (), **bounds: int) -> DataFrame:
    """Encode every text, decode its ids, and digest both; columns ``keep`` come first after the id, ``bounds`` go to ``bpe.encode``."""
    import public_tokenizers

    ranks = Path(vocabulary("byte_bpe_50k.tiktoken")).read_bytes()
    encoded = bpe.encode(
        docs, "text", ranks, public_tokenizers.PATTERN, ["doc_id", *keep], decoded_name="decoded", **bounds
    )
    return encoded.select(
        "doc_id",
        *keep,
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_adaptive_scan")
def op9_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "id % 100 = 0")


@query("op10_attention_quality")
def op10_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model)


@query("op11_fim_rotation")
def op11_fim_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rotate every text into its fill-in-the-middle form, then restore it from output and form alone."""
    done = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), out="fim")
    restored = fim.restore_column(done.select("doc_id", "fim.*"), "output", "form")
    return restored.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


@query("op13_sentencepiece_chunks")
def op13_sentencepiece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text through its marked words and the table of frequent ones, then decode each document's ids with the library."""
    model = Path(vocabulary("piece_bpe_32k.model")).read_bytes()
    encoded = pieces.encode(table(spark, sf_dir, "documents"), "text", model, ["doc_id"])
    return pieces.digests(encoded, "ids", model, ["doc_id"])


@query("op12_importance_resample")
def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document against the benchmark texts and draw a tenth of those with 20 words or more."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
