"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label. Every passage is encoded (how often each byte occurs, how
words repeat); a small network turns that into a vector and a gated attention weight, tanh(Vh) * sigmoid(Uh) through a softmax over the
document's passages; the weighted sum of the vectors is scored. So a document can be judged by the passages that give it away,
and the weights tell which.

Trained on a sample of at most ``SAMPLE`` labelled documents; training and scoring read every passage of every text. The sample is chosen by
a hash of the id, so all runs train on the same rows.

Defined cases: NULL or empty text is one empty passage and gets a score. Labels that are NULL or neither 0 nor 1 are left out; a document
with several labels has the one given more often (1 in a tie). With no labels, or one class only, every score is the share of label
1, smoothed. Rows without an id are scored and count as not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemart.llm.common import map_texts

PASSAGE_WORDS = 128
SAMPLE = 4000
N_FEATURES = 256 + 5
HIDDEN, GATE = 48, 24
#: Passes over the sample, or as many more as give this number of steps.
EPOCHS, STEPS = 14, 600
BATCH, RATE, DECAY = 64, 3e-3, 1e-4
SEED = 5
THRESHOLD = 0.7


def passages(text: str) -> np.ndarray:
    """One row of features per passage of ``PASSAGE_WORDS`` words."""
    words = text.encode().split()
    n = max(1, -(-len(words) // PASSAGE_WORDS))
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    for i in range(n):
        part = words[i * PASSAGE_WORDS : (i + 1) * PASSAGE_WORDS]
        if not part:
            continue
        raw = np.frombuffer(b" ".join(part), dtype=np.uint8)
        out[i, :256] = np.sqrt(np.bincount(raw, minlength=256) / len(raw))
        out[i, 256:] = (
            len(set(part)) / len(part),
            sum(map(bytes.__eq__, part, part[1:])) / len(part),
            len(raw) / len(part) / 10,
            sum(map(bytes.isupper, part)) / len(part),
            np.log1p(len(part)) / 5,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Bags:
    """Passages of several documents, one after the other; ``begin`` is where each document starts."""

    rows: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, bags: list[np.ndarray]) -> Bags:
        sizes = np.array([len(b) for b in bags])
        return cls(np.concatenate(bags).astype(np.float32, copy=False), np.cumsum(sizes) - sizes)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begin)), np.diff([*self.begin, len(self.rows)]))


class Attention:
    """The network, as plain arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        init = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.mean, self.scale, self.prior = mean, scale, None
        self.p = {
            "W": init(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE),
            "w": init(GATE, 1)[:, 0], "c": init(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32),
        }

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        p, owner = self.p, bags.owner
        x = (bags.rows - self.mean) * self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, bags.begin)[owner])
        a = e / np.add.reduceat(e, bags.begin)[owner]
        z = np.add.reduceat(a[:, None] * h, bags.begin, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "s": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, bags: Bags, labels: np.ndarray) -> dict[str, np.ndarray]:
        p, owner, f = self.p, bags.owner, self.forward(bags)
        x, h, t, g, a, z = (f[k] for k in "xhtgaz")
        error = (f["s"] - labels) / len(labels)
        dz = error[:, None] * p["c"]
        da = (h * dz[owner]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, bags.begin)[owner])
        dt, dg = de[:, None] * p["w"] * g * (1 - t**2), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz[owner] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h**2)
        return {
            "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
            "c": z.T @ error, "d": np.array([error.sum()]),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> Attention:
        """Adam over shuffled batches of documents."""
        rng = np.random.default_rng(SEED)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(bags)))):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                take = order[i : i + BATCH]
                grads = self.gradients(Bags.of([bags[j] for j in take]), labels[take])
                step += 1
                for k, grad in grads.items():
                    grad = grad.astype(np.float32) + DECAY * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad**2
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = self.p[k] - np.float32(RATE) * move.astype(np.float32)
        return self

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return self.forward(Bags.of([passages(x) for x in texts]))["s"].astype(np.float64) if texts else np.array([])

    def weights(self, text: str) -> np.ndarray:
        """The attention each passage of ``text`` gets; they add up to 1."""
        return self.forward(Bags.of([passages(text)]))["a"]


def _moments(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the features over all passages, a document at a time."""
    n = sum(map(len, bags))
    mean = sum(b.sum(axis=0, dtype=np.float64) for b in bags) / n
    square = sum(((b - mean) ** 2).sum(axis=0) for b in bags) / n
    return mean.astype(np.float32), np.sqrt(square).astype(np.float32)


def held_out(key: str):
    """Documents whose labels may never be learned from."""
    return F.coalesce(F.expr(f"crc32(cast({key} AS string)) % 4 = 2"), F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Attention:
    """Fit the network to the sample; the features of the sample are what reaches the driver."""
    chosen = (
        labels.where(f"{key} IS NOT NULL AND {label} IN (0, 1)")
        .where(~held_out(key))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.expr(f"cast(avg({label}) >= 0.5 AS int) AS _label"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(SAMPLE)
    )
    # SAMPLE rows of two numbers: small enough to broadcast whatever the size of the tables.
    rows = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(chosen), "_key")
        .groupBy("_key", "_label")
        .agg(F.min("_text").alias("_text"))
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [passages(x or "").astype(np.float16).tobytes() for x in batch.column("_text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("_label"), pa.array(packed, pa.binary())], names=["_key", "_label", "bag"]
        )

    kind = dict(rows.dtypes)["_key"]
    got = map_texts(rows, "_text", f"_key {kind}, _label int, bag binary", run).toArrow().sort_by("_key").to_pydict()
    y = np.array(got["_label"], dtype=np.float32)
    # Kept at half width; a batch of documents is widened when its turn comes.
    bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, N_FEATURES) for b in got["bag"]]
    if len(np.unique(y)) < 2:
        model = Attention(np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32))
        model.prior = float((y.sum() + 1) / (len(y) + 2))
        return model
    mean, std = _moments(bags)
    return Attention(mean, 1 / (std + np.float32(0.02))).fit(bags, y)


def score(docs: DataFrame, model: Attention, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """key, held_out, score and predicted of every row; only the text goes into the score."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = model.scores([x or "" for x in batch.column("_text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(made, pa.float64())], names=["_key", "score"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    scored = map_texts(rows, "_text", f"_key {kind}, score double", run)
    return scored.select(
        F.col("_key").alias(key),
        held_out("_key").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Attention, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns as they were."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.scores([x or "" for x in batch.column(text).to_pylist()]) >= threshold))

    return map_texts(docs, text, docs.schema.simpleString()[len("struct<") : -1].replace(":", " "), run)
