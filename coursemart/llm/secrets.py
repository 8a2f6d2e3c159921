"""Secret scans over a trigram inverted index, in DataFrame and SQL functions only.

Each rule's regular expression gives a Boolean query over trigrams: alternatives of trigrams that must all occur (in lower case). The
index has one posting (trigram, document) for the trigrams that some rule asks for; postings are intersected per document
and alternative, and a rule is verified on the documents left. Rules without a mandatory trigram are matched on every text.

All positions are code points, ends exclusive.

Defined cases: NULL and empty texts have no spans. Rows without an id are not in the index, so every rule is matched on them. Rows that repeat
an id share its postings, which can only add candidates. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import literal_rows
from coursemart.llm.trigrams import trigram_query
from coursemart.session import materialise


@dataclass(frozen=True)
class Rule:
    """``kind`` of secret, ``pattern`` (Java and Python syntax alike), and how long which group has to be to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The first three are given; their patterns and lengths are fixed values. The others have a form of their own.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
)
RULES = BASE_RULES + MORE_RULES
MARK = "[SECRET]"


def _queries(rules: tuple[Rule, ...]) -> list[tuple[int, list[list[str]]]]:
    return [(i, trigram_query(rule.pattern)) for i, rule in enumerate(rules)]


def postings(docs: DataFrame, key: str, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(gram, key): the documents in which each trigram of the rules' queries occurs."""
    grams = sorted({g for _, query in _queries(rules) for clause in query for g in clause})
    asked = F.array(*(F.lit(g) for g in grams)) if grams else F.expr("cast(array() AS array<string>)")
    lower = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.lower(text).alias("low"))
    return lower.select("key", F.explode(F.filter(asked, lambda g: F.contains("low", g))).alias("gram")).select("gram", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules): numbers of the rules whose query each document's postings satisfy.

    A posting is joined to the alternatives that ask for its trigram (a table as long as the rules are, hence the broadcast), and an alternative holds
    in a document that has as many of its trigrams as it asks for. Grouping is by document, so a trigram that
    occurs everywhere makes no large group.
    """
    spark = index.sparkSession
    asked = [
        (gram, i, j, len(clause)) for i, query in _queries(rules) for j, clause in enumerate(query) for gram in clause
    ]
    if not asked:
        return index.select("key", F.lit(None).cast("array<int>").alias("rules")).where("false")
    clauses = literal_rows(spark, asked, ["gram", "rule", "clause", "needed"], ["string", "int", "int", "int"])
    return (
        index.distinct()
        .join(F.broadcast(clauses), "gram")
        .groupBy("key", "rule", "clause", "needed")
        .count()
        .where("count = needed")
        .groupBy("key")
        .agg(F.collect_set("rule").alias("rules"))
    )


def _matches(text: Column, rule: Rule, number: int) -> Column:
    """Spans (start, number, kind, finish) of one rule: the pieces between the matches tell where each match lies."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    # Groups are only looked at where there is a match.
    parts = F.when(F.size(whole) > 0, F.split(text, rule.pattern, -1))
    counted = whole if not rule.group else F.when(F.size(whole) > 0, F.regexp_extract_all(text, pattern, F.lit(rule.group)))
    step = F.transform(
        F.arrays_zip(whole.alias("w"), F.slice(parts, 1, F.size(whole)).alias("p"), counted.alias("g")),
        lambda x: F.struct(F.length(x["p"]).alias("p"), F.length(x["w"]).alias("w"), F.length(x["g"]).alias("g")),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<struct<start:int,number:int,kind:string,finish:int>>)").alias("spans"))

    def add(state: Column, x: Column) -> Column:
        begin = state["at"] + x["p"]
        end = begin + x["w"]
        span = F.struct(
            begin.alias("start"), F.lit(number).alias("number"), F.lit(rule.kind).alias("kind"), end.alias("finish")
        )
        spans = F.when(x["g"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    none = F.expr("cast(array() AS array<struct<start:int,number:int,kind:string,finish:int>>)")
    return F.when(F.size(whole) > 0, F.aggregate(step, start, add, lambda s: s["spans"])).otherwise(none)


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, name: str = "_spans"
) -> DataFrame:
    """``docs`` and the spans found in each text, by start and then in the order of the rules.

    Candidates are joined to the documents; an id with a large share of the rows is split by adaptive execution.
    """
    empty = F.expr("cast(array() AS array<struct<start:int,number:int,kind:string,finish:int>>)")
    # Written, so that the join below reads two scans and can split the rows of an id that occurs very often.
    found = materialise(candidates(postings(docs, key, text, rules), rules), "candidates")
    joined = docs.join(
        found.select(F.col("key").alias("_key"), F.col("rules").alias("_rules")), docs[key] == F.col("_key"), "left"
    )
    full = {i for i, query in _queries(rules) if not query}
    body = F.coalesce(F.col(text), F.lit(""))
    spans = []
    for i, rule in enumerate(rules):
        made = _matches(body, rule, i)
        if i not in full:
            made = F.when(F.col(key).isNull() | F.array_contains("_rules", i), made).otherwise(empty)
        spans.append(made)
    ordered = F.array_sort(F.concat(*spans))
    return joined.withColumn(name, ordered).select(*docs.columns, name)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["finish"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mark: str = MARK) -> Column:
    """``text`` with ``mark`` in place of each span; spans that overlap or touch are replaced together."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(s: Column, x: Column) -> Column:
        fresh = x["start"] > s["at"]
        gap = F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))
        first = F.when((s["at"] == 0) & (x["start"] == 0), F.lit(mark)).otherwise(s["out"])
        return F.struct(F.greatest(s["at"], x["finish"]).alias("at"), F.when(fresh, gap).otherwise(first).alias("out"))

    rest = F.aggregate(spans, state, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redact_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with all secrets replaced, and ``size`` (if there is such a column) set to the new length of changed texts."""
    found = find_secrets(docs, key, text)
    hit = F.size("_spans") > 0
    changed = {text: redacted(F.col(text), F.col("_spans"))}
    out = found.withColumns(changed)
    if size and size in docs.columns:
        kind = dict(docs.dtypes)[size]
        out = out.withColumn(size, F.when(hit, F.length(text).cast(kind)).otherwise(F.col(size)))
    return out.select(*docs.columns)


def digest_columns(spans: str, base: tuple[Rule, ...] = BASE_RULES) -> list[Column]:
    """Counts per base kind, the digest of the base spans and the text of all spans."""
    of = lambda kind: F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    is_base = lambda s: reduce(lambda a, b: a | b, (s["kind"] == r.kind for r in base))
    return [
        *(of(r.kind) for r in base),
        F.sha2(span_text(F.filter(F.col(spans), is_base)).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col(spans)).alias("spans"),
    ]
