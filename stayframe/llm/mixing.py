"""Mixing documents to target weights by soft membership in domains.

A classifier fitted on the labelled table gives every document a posterior
over domains. A document's rate is the expected number of its copies in the
mix; projected-gradient least squares moves the rates, from 1 each and kept
nonnegative (and below ``max_rate``, where one is given), until the expected
token totals of the domains match the targets. Documents with one posterior share one rate, so the gradient steps
run on the tokens of rounded posteriors (at most a few ten thousand cells),
and a document replays the steps to its rate.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import passages
from .common import frugal, quoted, stage, text_of, trim
from .quality_mil import SAMPLE

DOMAINS = ("clean", "low", "toxic")
#: Target shares of the mix's tokens; the mix is as large as the first domain allows at rate 1.
WEIGHTS = (0.96, 0.03, 0.01)
#: The bound of rates where documents may be left out but not repeated.
ONCE = 1.0
#: Hashed words, training passes, steps of a posterior, and of the gradient.
BINS, EPOCHS, RATE, SEED = 1 << 15, 8, 0.2, 9
LEVELS, MAX_STEPS, TOLERANCE, PATIENCE = 256, 200, 1e-4, 10


class DomainClassifier:
    """Softmax over presence of hashed words and mean passage vectors."""

    def __init__(self):
        self.words = np.zeros((BINS, len(DOMAINS)), np.float32)
        self.dense = np.zeros((passages.SIZE + 1, len(DOMAINS)), np.float32)
        self.mean, self.scale = np.zeros(passages.SIZE, np.float32), np.ones(passages.SIZE, np.float32)

    def logits(self, x, doc, bins, n):
        norm = np.sqrt(np.maximum(np.bincount(doc, minlength=n), 1)).astype(np.float32)
        z = np.stack([np.bincount(doc, weights=self.words[bins, k], minlength=n) for k in range(len(DOMAINS))], axis=1)
        return z / norm[:, None] + ((x - self.mean) / self.scale) @ self.dense[:-1] + self.dense[-1], norm

    def posterior(self, x, doc, bins):
        z, _ = self.logits(x, doc, bins, len(x))
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def fit(self, x, docs: list[np.ndarray], y: np.ndarray) -> "DomainClassifier":
        """x: mean passage vectors; docs: word bins of each; y: domain numbers."""
        if not len(y):
            self.dense[-1, 1:] = -20  # no labels: everything is of the first domain
            return self
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-2)
        share = np.bincount(y, minlength=len(DOMAINS)) / len(y)
        self.dense[-1] = np.log(np.maximum(share, 1e-6))
        rng = np.random.default_rng(SEED)
        sums = [np.full((BINS, 1), 1e-3, np.float32), np.full(self.dense.shape, 1e-3, np.float32)]
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(order), 64):
                part = order[at:at + 64]
                doc, bins = np.repeat(np.arange(len(part)), [len(docs[k]) for k in part]), np.concatenate([docs[k] for k in part])
                z, norm = self.logits(x[part], doc, bins, len(part))
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(part)), y[part]] -= 1
                p = (p / len(part)).astype(np.float32)
                seen, where = np.unique(bins, return_inverse=True)
                grad = np.zeros((len(seen), len(DOMAINS)), np.float32)
                np.add.at(grad, where, (p / norm[:, None])[doc])
                dense = np.concatenate([((x[part] - self.mean) / self.scale).T @ p, p.sum(0, keepdims=True)]) + 1e-4 * self.dense
                sums[0][seen] += (grad * grad).sum(1, keepdims=True)
                sums[1] += dense * dense
                self.words[seen] -= RATE * grad / np.sqrt(sums[0][seen])
                self.dense -= RATE / 10 * dense / np.sqrt(sums[1])
        return self


def features(texts: list[bytes]):
    """Yield (mean passage vectors, text number and bin of each distinct
    word, words of each text) step by step."""
    at = 0
    for x, counts in passages.encode(texts):
        first = np.cumsum(counts) - counts
        part = texts[at:at + len(counts)]
        at += len(counts)
        doc, bins, n_words = passages.word_bins(part, BINS)
        yield np.add.reduceat(x, first) / counts[:, None].astype(np.float32), doc, bins, n_words


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DomainClassifier:
    """Fit on at most ``sample`` labelled documents, those whose ids have the
    least hashes. toxic = 1 is the toxic domain, else quality = 0 the low."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
              .groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(sample))

    def encode(batches):
        for batch in batches:
            xs, bags = [], []
            for x, doc, bins, _ in features(batch.column(2).cast(pa.binary()).to_pylist()):
                xs += [v.tobytes() for v in x.astype("<f4")]
                bags += [b.astype("<u2").tobytes() for b in np.split(bins, np.searchsorted(doc, np.arange(1, len(x))))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(xs, pa.binary()), pa.array(bags, pa.binary())],
                                             names=["doc_id", "y", "x", "bins"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    rows = (texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")  # at most ``sample`` ids
            .mapInArrow(frugal(encode), "doc_id long, y int, x binary, bins binary").dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], "<f4") for r in rows]).reshape(-1, passages.SIZE)
    return DomainClassifier().fit(x, [np.frombuffer(r["bins"], "<u2").astype(np.int64) for r in rows], np.array([r["y"] for r in rows], np.int64))


def posteriors(docs: DataFrame, model: DomainClassifier) -> DataFrame:
    """The columns of ``docs`` in a struct row, tokens (words) and the rounded
    posterior p (an array over DOMAINS) of every row."""
    @F.pandas_udf("struct<tokens: bigint, p: array<double>>")
    def of(texts):
        import pandas as pd

        tokens, ps = [], []
        for x, doc, bins, n_words in features([t.encode("utf-8") for t in texts]):
            p = np.round(model.posterior(x, doc, bins) * LEVELS) / LEVELS
            ps += list(p / p.sum(1, keepdims=True))
            tokens += n_words.tolist()
        trim()
        return pd.DataFrame({"tokens": tokens, "p": ps})

    row = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")
    return docs.select(row, of(text_of()).alias("m")).select("row", "m.tokens", "m.p")


def replay(p: Column, steps: list[tuple], size: float, max_rate: float | None) -> Column:
    """The rate and the look-ahead rate of a posterior after the gradient
    steps; a step is (residual of each domain..., momentum)."""
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    if not steps:
        return start

    def move(s, step):
        slope = reduce(lambda a, b: a + b, [F.get(p, F.lit(k)) * F.get(step, F.lit(k)) for k in range(len(DOMAINS))])
        rate = F.least(F.greatest(s["ahead"] - F.lit(size) * slope, F.lit(0.0)), F.lit(_bound(max_rate)))
        return F.transform(F.array(rate), lambda r: F.struct(
            r.alias("rate"), (r + F.get(step, F.lit(len(DOMAINS))) * (r - s["rate"])).alias("ahead")))[0]

    return F.aggregate(F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps]), start, move)


def _bound(max_rate: float | None) -> float:
    return float("inf") if max_rate is None else float(max_rate)


def _totals(cells: DataFrame, steps: list[tuple], size: float, max_rate: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected tokens of the domains at the rates and at the look-ahead, and
    the Gram matrix of the cells whose rate lies at no bound."""
    d = len(DOMAINS)
    names = [f"s{k}" for k in range(2 * d + d * d)]

    def run(batches):
        for batch in batches:
            p = np.array(batch.column(0).to_pylist(), float).reshape(-1, d)
            tokens = batch.column(1).to_numpy()
            rate = ahead = np.ones(len(p))
            for *off, momentum in steps:
                new = np.clip(ahead - size * (p @ np.array(off)), 0, _bound(max_rate))
                rate, ahead = new, new + momentum * (new - rate)
            free = (rate > 0) & (rate < _bound(max_rate))
            sums = np.concatenate([*[(p * (tokens * x)[:, None]).sum(0) for x in (rate, ahead)], ((p * (tokens * free)[:, None]).T @ p).reshape(-1)])
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums.tolist()], names=names)

    found = cells.select("p", "tokens").mapInArrow(frugal(run), ", ".join(f"{n} double" for n in names)).agg(*[F.sum(n) for n in names]).first()
    return np.array(found[:d]), np.array(found[d:2 * d]), np.array(found[2 * d:]).reshape(d, d)


def fit_rates(cells: DataFrame, weights=WEIGHTS, max_rate: float | None = None):
    """cells (p, tokens): the gradient steps and their size. Only sums over
    domains reach the driver.

    Without ``max_rate`` the residual goes through the inverse Gram matrix of
    the posteriors of the cells that are free to move (rate above 0), so
    scarce domains move as fast as common ones, until every total is within
    ``TOLERANCE`` of its target (as a share of all tokens). With a bound the
    steps are plain ones with momentum, restarted when the residual grows.
    Where the targets are out of reach either ends at the least-squares
    totals, when ``PATIENCE`` steps brought no nearer ones."""
    d = range(len(DOMAINS))
    p = lambda k: F.get(F.col("p"), F.lit(k))
    total = cells.agg(F.sum("tokens").alias("n"), *[F.sum(F.col("tokens") * p(k)).alias(f"m{k}") for k in d],
                      *[F.sum(F.col("tokens") * p(a) * p(b)).alias(f"g{a}{b}") for a in d for b in d]).first()
    if not total["n"]:
        return [], 1.0
    mass = np.array([total[f"m{k}"] for k in d]) / total["n"]
    gram = np.array([[total[f"g{a}{b}"] for b in d] for a in d]) / total["n"]
    goal = np.array(weights) / weights[0] * mass[0]
    plain = np.eye(len(DOMAINS)) / np.linalg.eigvalsh(gram)[-1]
    steps, t, last, nearest, since = [], 1.0, np.inf, np.inf, 0
    while len(steps) < MAX_STEPS and since < PATIENCE:
        at_rate, at_ahead, free = (x / total["n"] for x in _totals(cells, steps, 1.0, max_rate))
        off = at_rate - goal
        loss = float(off @ off)
        if np.abs(off).max() < TOLERANCE:
            break
        nearest, since = (loss, 0) if loss < nearest * (1 - 1e-3) else (nearest, since + 1)
        if max_rate is None:
            steps.append((*(np.linalg.pinv(gram if not steps else free, rcond=1e-6) @ off), 0.0))
            continue
        t = 1.0 if loss > last else t
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        steps.append((*(plain @ (at_ahead - goal)), (t - 1) / t_next))
        t, last = t_next, loss
    return steps, 1.0


def mix(docs: DataFrame, labels: DataFrame, weights=WEIGHTS, max_rate: float | None = None) -> DataFrame:
    """Rates that bring ``docs`` (doc_id, text, any other columns) to the
    target weights.

    Returns row (a struct of all columns), tokens, p_<domain>, rate and
    copies: the rate rounded up or down by a hash of the doc_id (of the text
    where it is null), so that the expected copies are the rate. Null and
    empty texts have no tokens and the posterior of an empty text; repeated
    rows are treated alike; an empty table gives no rows; without labels
    every document is of the first domain.
    """
    placed = stage(posteriors(docs, fit(docs, labels)), "posteriors")
    cells = stage(placed.groupBy("p").agg(F.sum("tokens").cast("double").alias("tokens")).coalesce(8), "cells")
    steps, size = fit_rates(cells, weights, max_rate)
    rated = placed.select("row", "tokens", "p", replay(F.col("p"), steps, size, max_rate)["rate"].alias("rate"))
    name = F.coalesce(F.col("row.doc_id").cast("string"), F.col("row.text").cast("string"), F.lit(""))
    chance = F.crc32(F.md5(name.cast("binary")).cast("binary")) / F.lit(float(1 << 32))
    copies = (F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    return rated.select("row", "tokens", *[F.get(F.col("p"), F.lit(k)).alias(f"p_{x}") for k, x in enumerate(DOMAINS)], "rate", copies.alias("copies"))


def draw(mixed: DataFrame) -> DataFrame:
    """The mix itself: the columns of the documents, a row for each copy."""
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
