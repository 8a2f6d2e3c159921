"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

A token sequence is the BPE encoding of its bytes exactly when each two neighbours are what BPE makes of their joint bytes. So the
encodings of all prefixes of a piece are paths over the trie of the vocabulary, on which a token may follow another only
if the pair is stable under the merges; for each prefix there is one such path. The transducer keeps the paths that may still be
extended: where each stands in the trie, its last token, and the tokens it has that are not yet common to all. Reading a byte moves
them on; tokens that all have in common are emitted. No path reaches back further than the longest token, which bounds
the lookahead. States and moves are made when first met and stored up to a bound; beyond it the same steps are taken without storing, and
when that has been done often, the stored states are dropped together.

Decoding joins the bytes of ids and feeds them to an incremental UTF-8 decoder, which carries an unfinished character from
one chunk to the next; bytes that are no UTF-8 become U+FFFD.

Defined cases: NULL or empty text gives no ids; NULL ids decode to the empty text; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import codecs
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import Memo, encode_by_unit, map_texts

#: The transducer stores no more than so many states; what leads beyond them is worked out each time.
MAX_STATES = 200_000
#: After so many steps per stored state that were worked out, the states are dropped and those of the texts at hand are stored.
RENEW = 8
#: And a worker's memo of units beyond so many. States, pairs and memo take some 350 MB together.
MEMO_UNITS = 500_000
#: Ids decoded at a time.
CHUNK = 1 << 16


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


#: Of each path: its node in the trie, its last token, and its tokens that are not yet common to all.
Paths = tuple[tuple[int, int, tuple[int, ...]], ...]


class Transducer:
    """Bytes of one piece to token ids."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        #: The trie: (node, byte) packed into one number -> node; root is 0.
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.inner = [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                edge = node << 8 | byte
                if edge not in self.child:
                    self.child[edge] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = self.child[edge]
            self.token[node] = rank
        self.stable: dict[int, bool] = {}
        self.edges: tuple[dict[int, list[int]], ...] = ({}, {})
        self._reset()

    def _reset(self) -> None:
        start: Paths = ((0, -1, ()),)
        self.number = {start: 0}
        self.states = [start]
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.rest: list[tuple[int, ...]] = [()]
        self.unstored = 0

    def parts_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``: BPE by its definition on its bytes, up to the last merge."""
        data = self.bytes_of[token]
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 62))
            if self.ranks.get(parts[best] + parts[best + 1], token) >= token:
                raise ValueError(f"token {token} is not made by merges")
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def edge(self, token: int, side: int) -> list[int]:
        """The tokens that lie at one end (0 left, 1 right) of ``token`` while it is merged, first to last."""
        known = self.edges[side].get(token)
        if known is None:
            parts = self.parts_of(token)
            known = self.edges[side][token] = [*(self.edge(parts[side], side) if parts else ()), token]
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens as they are, side by side.

        The merges of each run in order of rank. A merge across the border comes first if its rank is below the next one on the
        left (of equal ranks, the merge further left goes first) and not above the next one on the right.
        """
        if left < 0:
            return True
        pair = left << 32 | right
        known = self.stable.get(pair)
        if known is None:
            if len(self.stable) > 2 * self.max_states:
                self.stable.clear()
            known = self.stable[pair] = self._undisturbed(self.edge(left, 1), self.edge(right, 0))
        return known

    def _undisturbed(self, lefts: list[int], rights: list[int]) -> bool:
        never, i, j = 1 << 62, 0, 0
        while True:
            across = self.ranks.get(self.bytes_of[lefts[i]] + self.bytes_of[rights[j]], never)
            next_left = lefts[i + 1] if i + 1 < len(lefts) else never
            next_right = rights[j + 1] if j + 1 < len(rights) else never
            if across < never and across < next_left and across <= next_right:
                return False
            if next_left == next_right == never:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def _step(self, state: Paths, byte: int) -> tuple[Paths, tuple[int, ...]]:
        """The paths after one more byte, and the tokens that all of them now share."""
        paths = []
        complete = None
        for node, last, pending in state:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if token >= 0 and complete is None and self.may_follow(last, token):
                complete = (0, token, (*pending, token))
            if self.inner[node]:
                paths.append((node, last, pending))
        if complete is None:
            raise ValueError(f"byte {byte} is not in the vocabulary")
        paths.append(complete)
        # The first path has the longest token under way and seldom any pending ones; then nothing is common to all.
        first, common = paths[0][2], 0
        if first:
            shortest = min(len(p[2]) for p in paths)
            while common < shortest and all(p[2][common] == first[common] for p in paths):
                common += 1
        if common:
            return tuple((n, last, pending[common:]) for n, last, pending in paths), first[:common]
        return tuple(paths), ()

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]] | None:
        """A move that is not stored yet, stored from now on; None if it leads to a new state and no more are kept."""
        key, out = self._step(self.states[state], byte)
        number = self.number.get(key)
        if number is None:
            if len(self.states) >= self.max_states:
                return None
            number = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.rest.append(key[-1][2])
        self.moves[state][byte] = move = (number, out)
        return move

    def encode(self, piece: bytes) -> list[int]:
        if self.unstored > RENEW * self.max_states:
            self._reset()
        moves, state, ids = self.moves, 0, []
        for at, byte in enumerate(piece):
            move = moves[state].get(byte) or self._move(state, byte)
            if move is None:
                return self._without_storing(piece, at, state, ids)
            state, out = move
            if out:
                ids.extend(out)
        ids.extend(self.rest[state])
        return ids

    def _without_storing(self, piece: bytes, at: int, state: int, ids: list[int]) -> list[int]:
        """The rest of a piece from ``at``, by the same steps."""
        self.unstored += len(piece) - at
        paths = self.states[state]
        for byte in piece[at:]:
            paths, out = self._step(paths, byte)
            ids.extend(out)
        ids.extend(paths[-1][2])
        return ids


class Encoder:
    """Whole texts to packed 32-bit ids: the pattern's matches go through the transducer one by one."""

    def __init__(
        self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, memo_units: int = MEMO_UNITS
    ):
        import regex

        self.pieces = regex.compile(pattern).findall
        self.transducer = Transducer(ranks, max_states)
        self.memo = Memo(memo_units)

    def text(self, text: str) -> bytes:
        encode = self.transducer.encode
        ids = [i for piece in self.pieces(text) for i in encode(piece.encode())]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        return encode_by_unit(text, self.memo, lambda new: [self.text(u) for u in new], self.text)


def decoded(ids: np.ndarray, table: list[bytes]) -> Iterator[str]:
    """The text of ``ids`` as it becomes certain, chunk by chunk."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in range(0, len(ids), CHUNK):
        yield decoder.decode(b"".join([table[x] for x in ids[i : i + CHUNK].tolist()]))
    yield decoder.decode(b"", final=True)


_encoders: dict[tuple, Encoder] = {}


def _encoder(lines: bytes, pattern: str, *bounds: int) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    key = (hash(lines), pattern, bounds)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(lines), pattern, *bounds)
    return _encoders[key]


_tables: dict[int, list[bytes]] = {}


def _table(lines: bytes) -> list[bytes]:
    """The bytes of each id, kept once per Python worker."""
    key = hash(lines)
    if key not in _tables:
        _tables.clear()
        by_id = {i: t for t, i in read_ranks(lines).items()}
        _tables[key] = [by_id[i] for i in range(len(by_id))]
    return _tables[key]


def _text_of(packed: bytes | None, table: list[bytes]) -> str:
    return "".join(decoded(np.frombuffer(packed or b"", dtype="<u4"), table))


def _with_schema(df: DataFrame, keep: Iterable[str], **added: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"`{name}` {kind}" for name, kind in added.items())])


def encode(
    df: DataFrame, text: str, ranks: bytes, pattern: str, keep: list[str], name: str = "ids",
    max_states: int = MAX_STATES, memo_units: int = MEMO_UNITS, decoded_name: str | None = None,
) -> DataFrame:
    """Columns ``keep`` and the ids of ``text``, packed as little-endian unsigned 32-bit integers.

    ``ranks`` holds the lines of a rank file, ``pattern`` splits texts before the merges. ``max_states`` and
    ``memo_units`` bound a worker's memory (about 1 kB and 0.2 kB each). With ``decoded_name``, a column of that name holds what the
    packed ids decode to, made by the same worker: a second step would need a second worker beside each.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(shared.value, pattern, max_states, memo_units)
        packed = [encoder(x or "") for x in batch.column("_text").to_pylist()]
        columns, names = [*(batch.column(c) for c in keep), pa.array(packed, pa.binary())], [*keep, name]
        if decoded_name:
            table = _table(shared.value)
            columns.append(pa.array([_text_of(x, table) for x in packed], pa.string()))
            names.append(decoded_name)
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = df.select(*keep, F.col(text).alias("_text"))
    added = {name: "binary", **({decoded_name: "string"} if decoded_name else {})}
    return map_texts(rows, "_text", _with_schema(df, keep, **added), run)


def decode(df: DataFrame, ids: str, ranks: bytes, keep: list[str], name: str = "text") -> DataFrame:
    """Columns ``keep`` and the text that the packed ``ids`` stand for."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = _table(shared.value)
        texts = [_text_of(x, table) for x in batch.column("_ids").to_pylist()]
        columns = [batch.column(c) for c in keep]
        return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*keep, name])

    rows = df.select(*keep, F.col(ids).alias("_ids"))
    return map_texts(rows, "_ids", _with_schema(df, keep, **{name: "string"}), run)
