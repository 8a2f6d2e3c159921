"""What op13's encoder moves and remembers, on rows built here."""

import hashlib
from pathlib import Path

import pyarrow as pa
import pytest

from coursemart.llm import common, pieces
from coursemart.session import materialise

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


def test_places_and_ids_are_not_shuffled(spark):
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    sp = pieces.processor(model)
    texts = [None, "", " a  b ", *(f"the word{i} the\n{i}  end" for i in range(300))]
    docs = materialise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4), "docs")
    encoded = pieces.encode(docs, "text", model, ["doc_id"])
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()
    want = {i: sp.encode(t or "", add_bos=True, add_eos=True) for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == want
    assert pieces.hot_words(docs, "text", model).keys() >= {"the", "end"}


def test_small_memo_forgets_and_encodes_again():
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    sp = pieces.processor(model)
    encode = pieces.text_encoder(sp, {"the": b"".join(pieces._chunk_encoder(sp)(["the"]))}, common.Memo(6))
    for i in range(40):
        text = f"the w{i % 7} w{i % 5} the x{i}  y w{i % 7}"
        assert list(memoryview(encode(text)).cast("i")) == sp.encode(text)


class Calls:
    """The library's processor, which notes how many texts each call to encode brought."""

    def __init__(self, sp):
        self.sp, self.encoded = sp, []

    def encode(self, texts, **options):
        self.encoded.append(len(texts) if isinstance(texts, list) else 1)
        return self.sp.encode(texts, **options)


def test_words_of_many_texts_reach_the_library_in_one_call():
    sp = Calls(pieces.processor(Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()))
    encode = pieces.texts_encoder(sp, {"the": b"".join(pieces._chunk_encoder(sp)(["the"]))}, common.Memo())
    sp.encoded.clear()
    texts = ["", " ", *(f"the w{i % 30} the  x{i}\nthe▁y " for i in range(100)), "the the", "a" * 3000, ""]
    assert [list(memoryview(ids).cast("i")) for ids in encode(texts)] == [sp.sp.encode(t) for t in texts]
    assert len(sp.encoded) == 1
    encode(texts)
    assert len(sp.encoded) == 1


def test_ids_are_read_from_the_column_without_lists_of_python_ints(spark):
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    sp = pieces.processor(model)
    rows = [(1, [1, 500, 31, 2]), (2, None), (3, []), (None, [1, 2]), (1, [400])]
    for kind in ("int", "long"):
        lists = pa.array([ids for _, ids in rows], pa.list_(pa.int32() if kind == "int" else pa.int64()))
        assert [ids.tolist() for ids in pieces.id_arrays(lists)] == [ids or [] for _, ids in rows]
        assert [ids.tolist() for ids in pieces.id_arrays(lists.slice(1, 3))] == [[], [], [1, 2]]
        frame = spark.createDataFrame(rows, f"doc_id long, ids array<{kind}>")
        found = pieces.digests(frame, "ids", model, ["doc_id"]).collect()
        want = []
        for key, ids in rows:
            packed = b"".join(i.to_bytes(4, "little") for i in ids or [])
            text = sp.decode(ids or [])
            want.append((key, len(ids or []), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
