"""From raw documents to token ids: quality, near-duplicates, secrets, mixing, encoding.

Each stage reads what the one before wrote and works on all of it. Documents that the classifier rejects go; of each group of near-duplicates
the document with the smallest id stays; secrets are replaced in the text; the documents are put in the order of the mixing schedule, all of
them, with slot and place as columns; the last stage encodes and decodes every text and returns its digests, and where its ids start when
the ids of all documents are laid one after the other in the mixed order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursemart.llm import mixing, quality, secrets, simhash
from coursemart.llm.common import table
from coursemart.llm.queries import token_digests
from coursemart.session import materialise

#: Columns that carry the mixed order from the mixing stage on.
ORDER = ("slot", "place")


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels that are not held out and keeps what scores at the threshold or above."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, order=ORDER)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers also hold what the stages before left in them, so the encoder keeps less than on its own.
    digests = token_digests(docs, [*ORDER], max_states=60_000, memo_units=400_000)
    return mixing.running_start(materialise(digests, "digests"), "n_tokens", "start", ORDER)


STAGES = [
    ("quality_classifier", keep_good_documents),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", replace_secrets),
    ("source_mixing", mix_sources),
    ("bpe_encode_decode", encode_texts),
]

#: A trained model, XXH64 and BPE are beyond SQL; tests/llm holds run() against a plain version of each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
