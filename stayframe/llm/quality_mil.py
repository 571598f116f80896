"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Each passage
is encoded, a gated attention (tanh times sigmoid) learned from the labels
weighs the passages, and the weighted passage representation is scored.
Training uses at most SAMPLE labelled documents, those whose ids have the
least hashes; scoring reads every whole text in one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import passages
from .common import frugal, text_of

#: The bound on labelled documents that the model is fitted on.
SAMPLE = 4000
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 16, 14, 64, 3e-3, 1e-4, 5
THRESHOLD = 0.3


class AttentionMIL:
    """Weights of the encoder, the gated attention and the scorer."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"W": make(passages.SIZE, HIDDEN), "Wb": np.zeros(HIDDEN, np.float32), "V": make(HIDDEN, GATE), "U": make(HIDDEN, GATE),
                  "w": make(GATE), "c": make(HIDDEN), "b": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(passages.SIZE, np.float32), np.ones(passages.SIZE, np.float32)
        self.base = None  # a constant score, where the labels allow no fit

    def forward(self, x: np.ndarray, counts: np.ndarray):
        p, first = self.p, np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(((x - self.mean) / self.scale) @ p["W"] + p["Wb"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        score = 1 / (1 + np.exp(-(z @ p["c"] + p["b"][0])))
        return score, (bag, h, t, s, a, z)

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(counts), self.base)
        return self.forward(x, counts)[0].astype(float)

    def gradients(self, x, counts, y):
        p = self.p
        score, (bag, h, t, s, a, z) = self.forward(x, counts)
        d = (score - y) / len(y)
        dz = d[:, None] * p["c"]
        of = dz[bag]
        da = (of * h).sum(1)
        first = np.cumsum(counts) - counts
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh = (of * a[:, None] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": ((x - self.mean) / self.scale).T @ dh, "Wb": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
                "c": z.T @ d, "b": np.array([d.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS) -> "AttentionMIL":
        """bags: passage vectors of each document; y: its label, 0 or 1."""
        if not len(bags) or y.min() == y.max():
            self.base = float(y.mean()) if len(y) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), np.maximum(every.std(0), 1e-3)
        rng = np.random.default_rng(SEED)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                part = order[at:at + BATCH]
                g = self.gradients(np.concatenate([bags[k] for k in part]), np.array([len(bags[k]) for k in part]), y[part])
                step += 1
                for k, w in self.p.items():
                    grad = g[k].astype(np.float32) + DECAY * w
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    w -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> AttentionMIL:
    """Fit on at most ``sample`` of the labelled documents whose fold is not
    0. Rows without an id, text or label take no part; of several labels of
    a document the least counts."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .filter(F.col("y").isNotNull() & (fold(F.col("doc_id"), 5) != 0)).groupBy("doc_id").agg(F.min("y").alias("y"))
              .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(sample))

    def encode(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            vectors = [v for x, counts in passages.encode(texts) for v in np.split(x.astype(np.float16), np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([v.tobytes() for v in vectors], pa.binary())],
                                             names=["doc_id", "y", "bag"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    rows = (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")  # at most ``sample`` ids
            .mapInArrow(frugal(encode), "doc_id long, y int, bag binary").dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r["doc_id"])
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, passages.SIZE).astype(np.float32) for r in rows]
    return AttentionMIL().fit(bags, np.array([float(r["y"] > 0) for r in rows], np.float32))


def score(docs: DataFrame, model: AttentionMIL, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text): doc_id, held_out, score,
    predicted.

    A null or empty text is one passage of zeros; a row without an id is
    scored and not held out; repeated rows are scored alike; an empty table
    gives no rows; no column but the text is an input of a score.
    """
    def run(batches):
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            scores = np.concatenate([model.score(x, counts) for x, counts in passages.encode(texts)] or [np.zeros(0)])
            scores = np.round(scores, 6)  # equal texts may differ in the last bits of single precision
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    key = F.col("doc_id").cast("long")
    return docs.select(key.alias("doc_id"), F.coalesce(fold(key, 5) == 0, F.lit(False)).alias("held_out"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
