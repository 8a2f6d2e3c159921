"""Fill-in-the-middle: the rotation against a plain slicing of tokens, exact restore, and the odd rows."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coursemart.llm import fim


def plain_fim(text, key):
    """The contract, by slicing a token list."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ALPHABET = st.sampled_from(list("abcXYZ <>PSM\n\t.é漢🙂") + ["<P", "S>", "<", ">"])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join), st.integers(0, 10_000))
def test_transform_matches_slicing_and_restores(text, key):
    got = fim.transform(text, key)
    assert got == plain_fim(text, key)
    assert fim.restore(got[4], got[1]) == text


def test_forms_all_occur_and_long_text():
    rng = random.Random(5)
    forms = {fim.transform("ab cd ef", k)[1] for k in range(200)}
    assert forms == {"plain", "psm", "spm"}
    long = " ".join(rng.choice(["word", "ünï", "漢字", "x\ty", "🙂"]) for _ in range(300_000))
    for key in range(5):
        n, form, _, _, out = fim.transform(long, key)
        assert (n, form, out) == plain_fim(long, key)[::1][0:2] + (plain_fim(long, key)[4],)
        assert fim.restore(out, form) == long


def test_defined_cases():
    assert fim.transform(None, 3) == (0, "plain", None, None, "")
    assert fim.transform("", 3) == (0, "plain", None, None, "")
    assert fim.transform("has <M> already", 3)[1] == "plain"
    assert fim.transform("some text", None) == (len(re.findall(r"[A-Za-z]+|[^A-Za-z]", "some text")), "plain", None, None, "some text")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, "alpha beta", {"k": 1}, "x", "y"), (1, "alpha beta", {"k": 1}, "x", "y"), (1, "other text", None, "x", "y"),
        (None, "no key", None, None, None), (2, None, None, "", ""), (3, "", None, "", ""), (4, "a <S> b", None, "", ""),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, `a.b` map<string,int>, `a b` string, fim string")


def test_operator_keeps_rows_and_columns(spark, odd):
    done = fim.fill_in_middle(odd, out="fim")
    assert done.columns == ["doc_id", "text", "a.b", "a b", "fim"]
    got = sorted(((r["doc_id"], r["text"], tuple(r["fim"])) for r in done.collect()), key=repr)
    want = sorted(((r["doc_id"], r["text"], fim.transform(r["text"], r["doc_id"])) for r in odd.collect()), key=repr)
    assert got == want
    back = fim.restore_column(done.select("doc_id", "text", "fim.*"), "output", "form")
    assert all((r["text"] or "") == r["restored"] for r in back.collect())


def test_empty_table(spark, odd):
    assert fim.fill_in_middle(odd.limit(0)).count() == 0
