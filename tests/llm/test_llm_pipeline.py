"""Stages of the pipeline, on rows built here."""

import pytest

import corpus_pipeline
from coursemart.llm import mixing
from coursemart.session import materialise

pytest.importorskip("public_tokenizers")


def documents(spark, sources):
    rows = [(i % 90 if i % 30 else None, f"text {'word ' * (i % 7)}{i}", sources[i % len(sources)]) for i in range(120)]
    rows += [(1000, None, "a"), (1000, "twice", "a"), (1000, "twice", None)]
    return materialise(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), "docs")


@pytest.mark.parametrize("sources", [["a", "b", "b", None], ["only"]])
def test_mixed_order_rules_where_ids_start(spark, sources):
    docs = documents(spark, sources)
    mixed = materialise(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
    # The order lies in the rows, so dealing them out anew does not lose it.
    done = corpus_pipeline.encode_texts(spark, mixed.repartition(5), "").collect()
    assert len(done) == docs.count()
    at = 0
    for row in sorted(done, key=lambda r: (r["slot"], r["place"])):
        assert row["start"] == at
        at += row["n_tokens"]
    assert len({(r["slot"], r["place"]) for r in done}) == len(done)


def test_another_mix_gives_other_starts(spark):
    docs = documents(spark, ["a", "b"])
    starts = []
    for weights in ({"a": 9.0, "b": 1.0}, {"a": 1.0, "b": 9.0}):
        mixed = materialise(mixing.mixed(docs, order=corpus_pipeline.ORDER, weights=weights), "mixed")
        done = corpus_pipeline.encode_texts(spark, mixed, "").collect()
        starts.append(sorted((r["doc_id"] or -1, r["decoded_sha256"], r["start"]) for r in done))
    assert starts[0] != starts[1]


def test_running_start_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "slot long, place long, n_tokens long")
    assert mixing.running_start(empty, "n_tokens", "start").count() == 0
