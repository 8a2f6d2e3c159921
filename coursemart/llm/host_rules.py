"""Quality rules by host: rates of rule failures per host, shrunk towards what all hosts show, decide over its documents.

A document's own counts are computed where its row lies. Failures are summed per host and rule. The hosts' rates have a
beta distribution fitted by moments (each host counts once; binomial noise is taken off the variance), and a host's rate is
the mean of its posterior: a host with few documents is judged by what is usual, one with many by its own. A host
whose shrunk rate exceeds a rule's limit is rejected with all its documents.

Defined cases: NULL text has no words. Documents without a host (NULL or blank) are judged on their own only. Repeated
rows count as often as they occur. With no variance between hosts, or one host only, every host has the overall rate. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import map_texts
from coursemart.session import materialise

SYMBOLS = "#*$%&|<>"

#: Rule -> SQL for a document that fails it, over the counts below.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "2 * n_dup_lines > n_lines",
}
#: The rules that reject a document on its own.
BASE = ("short", "repeats")
#: A host's shrunk failure rate above which all its documents go.
LIMITS = {"short": 0.8, "repeats": 0.5, "symbols": 0.5, "lines": 0.5}


def counts(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a word)."""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII blanks only
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        often = {w for w, n in Counter(windows).items() if n > 1}
        end = 0
        for i, w in enumerate(windows):
            if w in often:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def document_counts(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """key, host and the counts of each document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [counts(x or "") for x in batch.column("_text").to_pylist()]
        columns = zip(*made, strict=True) if made else [[]] * len(COUNTS)
        return pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("_host"), *(pa.array(c, pa.int64()) for c in columns)],
            names=["_key", "_host", *COUNTS],
        )

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(host).cast("string").alias("_host"), F.col(text).alias("_text"))
    schema = f"_key {kind}, _host string, " + ", ".join(f"{c} long" for c in COUNTS)
    return map_texts(rows, "_text", schema, run)


def beta_prior(hosts: DataFrame, rule: str) -> tuple[float, float]:
    """Alpha and beta of the rates of ``rule`` over hosts (n, failed_<rule>), by moments; one row reaches the driver."""
    rate = F.col(f"failed_{rule}") / F.col("n")
    row = hosts.agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"), F.avg(1 / F.col("n")).alias("inv"), F.count("*").alias("k")
    ).first()
    if not row["k"]:
        return 1.0, 1.0
    mean = min(max(row["mean"], 1e-6), 1 - 1e-6)
    spread = mean * (1 - mean)
    between = max(row["var"] - spread * row["inv"], spread * 1e-3)
    strength = max(spread / between - 1, 1.0)
    return mean * strength, (1 - mean) * strength


def host_verdicts(counted: DataFrame, rules: dict[str, str], limits: dict[str, float]) -> DataFrame:
    """One row per host: n, failures, shrunk rates and whether it is rejected."""
    hosts = materialise(
        counted.where("trim(_host) <> ''")
        .groupBy("_host")
        .agg(F.count("*").alias("n"), *(F.count_if(F.expr(sql)).alias(f"failed_{r}") for r, sql in rules.items())),
        "hosts",
    )
    for rule in rules:
        alpha, beta = beta_prior(hosts, rule)
        shrunk = (F.col(f"failed_{rule}") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
        hosts = hosts.withColumn(f"rate_{rule}", shrunk)
    over = " OR ".join(f"rate_{r} > {limits[r]}D" for r in rules)
    return hosts.withColumn("host_rejected", F.expr(over))


def apply_host_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: dict[str, str] = RULES,
    base: tuple[str, ...] = BASE,
    limits: dict[str, float] = LIMITS,
) -> DataFrame:
    """key, the counts, base_failed, host_rejected and kept for each document.

    The counts are written once, as both the host sums and the join read them; the verdicts too, so that both
    inputs of the join are plain scans, of which Spark can split a hot host.
    """
    counted = materialise(document_counts(docs, key, text, host), "counts")
    verdicts = materialise(host_verdicts(counted, rules, limits).select("_host", "host_rejected"), "verdicts")
    failed = F.expr(" OR ".join(f"({rules[r]})" for r in base))
    rejected = F.coalesce(F.col("host_rejected"), F.lit(False))
    return (
        counted.join(verdicts, "_host", "left")
        .withColumns({"base_failed": failed, "host_rejected": rejected})
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .select(F.col("_key").alias(key), *COUNTS, "base_failed", "host_rejected", "kept")
    )
