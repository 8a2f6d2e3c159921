"""Importance resampling with line deduplication, against a plain count over whole texts."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from coursemart.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, target, max_n=1, buckets=10_000, percent=10, least=20):
    """The contract over whole texts: every run of words, no lines."""

    def feats(text):
        words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        out = [" ".join(words[i : i + k]) for k in range(1, max_n + 1) for i in range(len(words) - k + 1)]
        return words, [zlib.crc32(f.encode()) % buckets for f in out]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(feats(text)[1])
    for text in target:
        t.update(feats(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * float(S + 10000) / ((s[b] + 1) * float(T + 10000)))) for b in range(buckets)]
    rows = []
    for i, (key, text) in enumerate(docs):
        words, bs = feats(text)
        weight = sum(gain[b] for b in bs)
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, key, len(bs), weight, score, len(words), None])
    eligible = sorted((r for r in rows if r[5] >= least and r[4] is not None), key=lambda r: (-r[4], r[1], r[0]))
    for rank, r in enumerate(eligible[: len(eligible) * percent // 100], 1):
        r[6] = rank
    return sorted((r[1], r[2], r[3], r[4], r[6]) for r in rows if r[1] is not None)


def texts(i):
    shared = "Shared line of many words here and there, again and again über alles"
    return "\n".join([shared, f"line {i} " * (i % 7), "Zeile " + "wort " * (i % 30), shared, "" if i % 3 else "x\ny z"])


@pytest.fixture(scope="module")
def data(spark):
    docs = [(i, texts(i)) for i in range(60)] + [(5, texts(5)), (61, None), (62, ""), (63, "tie"), (64, "tie"), (None, "no key")]
    target = ["shared line of many words", "wort wort wort", None, "line 3\nline 4"]
    return docs, target


@pytest.mark.parametrize("max_n", [1, 3])
def test_against_whole_texts(spark, data, max_n):
    docs, target = data
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = resample.resample(d, t, max_n=max_n, percent=25)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = got.collect()
    assert len(rows) == len(docs)
    mine = sorted(tuple(r) for r in rows if r["doc_id"] is not None)
    want = plain(docs, target, max_n=max_n, percent=25)
    assert [r[:4] for r in mine] == [r[:4] for r in want]
    # Repeated rows of id 5 are ranked each on its own, in either order.
    assert sorted(r[4] or 0 for r in mine) == sorted(r[4] or 0 for r in want)
    assert {r[0]: r[4] for r in mine if r[0] != 5} == {r[0]: r[4] for r in want if r[0] != 5}


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string, `a.b` string")
    t = spark.createDataFrame([], "text string")
    assert resample.resample(d, t).count() == 0
