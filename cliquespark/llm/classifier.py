"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network by the non-negative unbiased
risk: the negative part of the risk is estimated from unlabelled text less the prior's share
of positives, and may not fall below zero. The class prior is estimated first, from a
classifier of positives against unlabelled text: over thresholds on a half that it was not
fitted to, the smallest ratio of unlabelled to positive mass above the threshold (with its
confidence margin) bounds the share of positives. Negative labels are never used.

The bounded training sample: the ``POSITIVES`` rows labelled 1 and the ``UNLABELLED`` rows of any
kind with the smallest hashes of their id, held-out rows excepted. Features are those of the
whole text: shares of character classes, of repeats and of hashed byte pairs.

Defined results: null and empty texts get the score of a text without features; very long texts are read
in whole; of ids with equal hashes the sample takes the smaller one, and of rows with one id that of the smallest
features, so that the order of rows does not matter; without positives or unlabelled rows every score is 0.5; a null ``doc_id`` is scored and never learned from;
repeated rows are scored like any other; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.llm.language import held_out
from cliquespark.llm.shared import ship_package

POSITIVES = 3_000
UNLABELLED = 6_000
PAIRS = 256
HIDDEN = 24
EPOCHS = 60
BATCH = 300
RATE = 3e-3
DECAY = 1e-4
POSITIVE_FROM = 0.7

_KIND = np.full(256, 7, np.uint8)
_KIND[[*range(0x61, 0x7B)]] = 0
_KIND[[*range(0x41, 0x5B)]] = 1
_KIND[[*range(0x30, 0x3A)]] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 3
_KIND[[*b".,;:?'\"()-"]] = 4
_KIND[ord("!")] = 5
_KIND[[*b"#*$%&|<>"]] = 6
N_KINDS = 9
N_DENSE = N_KINDS + 6
N_FEATURES = N_DENSE + PAIRS


def text_features(text: str) -> np.ndarray:
    """A fixed-length vector of shares, each between 0 and about 1."""
    out = np.zeros(N_FEATURES, np.float32)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return out
    kinds = _KIND[data]
    kinds[data >= 0x80] = 8
    out[:N_KINDS] = np.bincount(kinds, minlength=N_KINDS) / len(data)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    if words:
        n = len(words)
        out[N_KINDS : N_DENSE] = (
            np.log1p(n) / 10,
            len(data) / n / 10,
            len(set(words)) / n,
            sum(map(operator.eq, words, words[1:])) / n,
            1 - len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n - 2),
            1 - len(set(lines)) / max(1, len(lines)),
        )
    if len(data) > 1:
        pairs = (data[:-1].astype(np.uint32) * 257 + data[1:]) * np.uint32(2_654_435_761) >> np.uint32(24)
        out[N_DENSE:] = np.sqrt(np.bincount(pairs & (PAIRS - 1), minlength=PAIRS) / (len(data) - 1))
    return out


@dataclass
class Network:
    """One hidden layer; numpy only."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def margins(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _fit(p: np.ndarray, u: np.ndarray, gradient, seed: int, epochs: int) -> Network:
    """Adam on mini-batches; ``gradient`` gives the risk's derivative for the margins of positives and unlabelled."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    mean, scale = both.mean(0), both.std(0) + 1e-2
    p, u = (p - mean) / scale, (u - mean) / scale
    k = p.shape[1]
    w = [rng.normal(0, 1 / np.sqrt(k), (k, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    steps = max(1, len(u) // BATCH)
    for _ in range(epochs):
        up, pp = rng.permutation(len(u)), rng.permutation(len(p))
        for us, ps in zip(np.array_split(up, steps), np.array_split(pp, steps), strict=True):
            if not len(ps):
                ps = rng.integers(0, len(p), 8)
            x = np.concatenate([p[ps], u[us]])
            h = np.tanh(x @ w[0] + w[1])
            z = h @ w[2] + w[3][0]
            g = np.concatenate(gradient(z[: len(ps)], z[len(ps) :]))
            back = np.outer(g, w[2]) * (1 - h * h)
            grads = [x.T @ back + DECAY * w[0], back.sum(0), h.T @ g + DECAY * w[2], np.array([g.sum()])]
            t += 1
            for j, grad in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * grad
                v[j] = 0.999 * v[j] + 0.001 * grad * grad
                w[j] = w[j] - RATE * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    return Network(mean, scale, w)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 3) -> float:
    """Share of positives among the unlabelled, by the best threshold of a positive-against-unlabelled classifier."""
    half_p, half_u = len(p) // 2, len(u) // 2
    if min(half_p, half_u) < 5:
        return 0.5
    apart = lambda zp, zu: (-(1 - _sigmoid(zp)) / len(zp), _sigmoid(zu) / len(zu))
    made = _fit(p[:half_p], u[:half_u], apart, seed, EPOCHS // 3)
    zp, zu = np.sort(made.margins(p[half_p:])), np.sort(made.margins(u[half_u:]))
    above_p = 1 - np.arange(len(zp)) / len(zp)
    above_u = 1 - np.searchsorted(zu, zp, "left") / len(zu)
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(zp)) + 1 / np.sqrt(len(zu)))
    bound = (above_u + margin) / above_p
    best = bound.argmin()
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The positive and the negative part of the unbiased risk for margins of positives and unlabelled rows, with the logistic loss."""
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def risk_gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The derivative to go down by: that of both parts, or, where the negative part is below zero, of its opposite alone."""
    on_u, on_p = _sigmoid(zu) / len(zu), -prior * _sigmoid(zp) / len(zp)
    if risk(zp, zu, prior)[1] < 0:
        return -on_p, -on_u
    return -prior * (1 - _sigmoid(zp)) / len(zp) + on_p, on_u


def train(p: np.ndarray, u: np.ndarray, prior: float | None = None, seed: int = 11) -> Network:
    """Non-negative unbiased risk with the logistic loss."""
    rng = np.random.default_rng(seed)
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    pi = estimate_prior(p, u) if prior is None else prior
    return _fit(p, u, lambda zp, zu: risk_gradient(zp, zu, pi), seed, EPOCHS)


def _features(rows: DataFrame) -> DataFrame:
    """``part`` and the packed features of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [text_features(t.as_py() or "").tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["part"], batch["h"], pa.array(packed, pa.binary())], names=["part", "h", "x"])

    return rows.select("part", "h", "text").mapInArrow(run, "part int, h long, x binary")


def training_rows(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature matrices of the bounded sample, in an order that does not depend on partitions."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    h = F.xxhash64("doc_id")
    # two limits bound what is broadcast
    chosen_p = marked.select("doc_id", h.alias("h")).distinct().orderBy("h", "doc_id").limit(positives).withColumn("part", F.lit(1))
    chosen_u = rows.select("doc_id", F.xxhash64(F.lit(5), "doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(unlabelled).withColumn("part", F.lit(0))
    ids = chosen_p.unionByName(chosen_u)
    # of rows that share an id one counts, so that what is collected is bounded too
    made = _features(rows.join(F.broadcast(ids), "doc_id")).groupBy("part", "h").agg(F.min("x").alias("x")).collect()
    out = []
    for part in (1, 0):
        own = sorted((r["h"], bytes(r["x"])) for r in made if r["part"] == part)
        out.append(np.array([np.frombuffer(x, np.float32) for _, x in own], np.float64).reshape(-1, N_FEATURES))
    return out[0], out[1]


def score(docs: DataFrame, model: Network | None) -> DataFrame:
    """``doc_id, held_out, score, predicted``; the texts are all that a score sees."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                rows = batch.slice(at, 2_000)
                x = np.array([text_features(t.as_py() or "") for t in rows["text"]], np.float64).reshape(-1, N_FEATURES)
                scores = np.full(len(x), 0.5) if network is None else network.scores(x)
                yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["held_out"], pa.array(scores), pa.array((scores >= POSITIVE_FROM).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id").cast("long")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """The contract's rows: learned from rows that are not held out, scored for all."""
    p, u = training_rows(docs, labels, positives, unlabelled)
    return score(docs, train(p, u) if len(p) >= 10 and len(u) >= 10 else None)
