"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of good quality; unlabelled text is a sample of all documents; the class prior is the
share of good rows among the labels outside the held-out fold. A small network minimises the non-negative unbiased risk
(Kiryo et al. 2017): ``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))``; while the second part is
below zero it has no gradient, so the network cannot fit the unlabelled sample as all negative.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.samples import distinct, labelled, remainder, thinned
from tidemark.llm.shared import slices, texts

FOLDS, HELD_OUT = 5, 0
#: Positives and unlabelled documents that are learnt from: bounds, whatever the corpus.
POSITIVES, UNLABELLED = 8_000, 16_000
#: Prior where no labels tell it, and the range it is kept in.
PRIOR, PRIORS = 0.8, (0.05, 0.95)
THRESHOLD = 0.3

_EDGE = re.compile(r"[^\w\s]{2,}(?=\s|$)")
_MARKS = "#$%&*|~^_=<>{}[]\\/@"


def features(text: str) -> np.ndarray:
    """The shape of a text: characters, words, lines and how much of them repeats (all zero for an empty one)."""
    n = len(text)
    if not text.strip():
        return np.zeros(SIZE)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    w, k = len(words), len(lines)
    upper = sum(1 for x in words if len(x) > 1 and x.isupper())
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], words[2:])))
    ends = sum(1 for line in lines if line.rstrip()[-1] in ".!?:;,\"»”)")
    marked = sum(map(text.count, _MARKS))
    lengths = np.fromiter(map(len, words), np.int64, w)
    sizes = np.fromiter(map(len, lines), np.int64, k)
    digits = sum(map(text.count, "0123456789"))
    return np.array([
        1.0,
        math.log1p(n) / 10, math.log1p(w) / 10, math.log1p(k) / 10,
        min(lengths.mean() / 10, 3), min(lengths.std() / 10, 3), (lengths > 20).mean(), (lengths <= 3).mean(),
        marked / n * 10, text.count("!") / n * 10, text.count("|") / w, digits / n * 10,
        text.count(".") / w, text.count(",") / w, text.count("?") / w,
        upper / w, sum(1 for x in words if x[0].isupper()) / w, len(_EDGE.findall(text)) / w,
        len(counts) / w, max(counts.values()) / w, 1 - pairs / max(w - 2, 1) if w > 2 else 0.0,
        1 - len(set(lines)) / k, ends / k, min(sizes.mean() / 200, 5), min(sizes.std() / 200, 5), min(w / k / 50, 5),
        sum(map(text.count, "()[]{}<>")) / n * 10, text.count("http") / w * 10, 1.0 if w < 5 else 0.0, 1.0 if w < 20 else 0.0,
    ])


SIZE = 30


@dataclass(frozen=True)
class Model:
    mean: tuple
    scale: tuple
    inner: tuple
    inner_bias: tuple
    outer: tuple
    outer_bias: float


class Scorer:
    def __init__(self, model: Model):
        self.mean, self.scale = np.array(model.mean), np.array(model.scale)
        self.inner, self.inner_bias = np.array(model.inner), np.array(model.inner_bias)
        self.outer, self.outer_bias = np.array(model.outer), model.outer_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        hidden = np.tanh(z @ self.inner + self.inner_bias)
        return _sigmoid(hidden @ self.outer + self.outer_bias)


@lru_cache(4)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk under the logistic loss: of positives, and of negatives (may fall below zero)."""
    plus, minus = np.logaddexp(0, -positive).mean(), np.logaddexp(0, positive).mean()
    return prior * plus, np.logaddexp(0, unlabelled).mean() - prior * minus


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 24, rounds: int = 100, seed: int = 11) -> Model:
    """Adam on mini-batches of the non-negative risk."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p_all, u_all = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, 1 / math.sqrt(SIZE), (SIZE, hidden)), np.zeros(hidden), rng.normal(0, 0.2, hidden), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    step, size = 0, 2048

    def run(x):
        h = np.tanh(x @ w[0] + w[1])
        return h, h @ w[2] + w[3][0]

    def back(x, h, g):
        inner = (g[:, None] * w[2]) * (1 - h * h)
        return [x.T @ inner, inner.sum(axis=0), h.T @ g, np.array([g.sum()])]

    for _ in range(rounds):
        order = rng.permutation(len(u_all))
        for at in range(0, len(order), size):
            u = u_all[order[at:at + size]]
            p = p_all[rng.permutation(len(p_all))[:size]]
            (hp, sp), (hu, su) = run(p), run(u)
            gp = -prior * _sigmoid(-sp) / len(sp)
            gu = np.zeros(len(su))
            if risk(sp, su, prior)[1] > 0:
                gp -= prior * _sigmoid(sp) / len(sp)
                gu = _sigmoid(su) / len(su)
            step += 1
            for i, (a, b) in enumerate(zip(back(p, hp, gp), back(u, hu, gu))):
                g = a + b + 1e-4 * w[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= 3e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Model(tuple(mean), tuple(scale), tuple(map(tuple, w[0])), tuple(w[1]), tuple(w[2]), float(w[3][0]))


def _looks(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample, brought to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64()))], ["x"])

    return np.array([r["x"] for r in rows.select("text").mapInArrow(run, "x array<double>").orderBy("x").collect()]).reshape(-1, SIZE)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from about ``POSITIVES`` trusted positives and ``UNLABELLED`` documents.

    Without positives the model is neutral (every score 0.5).
    """
    good = labels.where("quality = 1")
    sample, counts = labelled(docs, good, "quality", FOLDS, HELD_OUT, POSITIVES)
    known = labels.where(F.col("quality").isNotNull() & (remainder(FOLDS) != HELD_OUT)).agg(F.avg((F.col("quality") > 0).cast("double"))).first()[0]
    prior = float(np.clip(PRIOR if known is None else known, *PRIORS))
    unlabelled = _looks(distinct(thinned(texts(docs), docs.count(), UNLABELLED, "unlabelled").select("text")))
    positive = _looks(sample)
    if not len(positive) or not len(unlabelled):
        zero = (0.0,) * SIZE
        return Model(zero, (1.0,) * SIZE, tuple((0.0,) for _ in range(SIZE)), (0.0,), (0.0,), 0.0)
    return train(positive, unlabelled, prior)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    NULL, empty and blank texts get the score of an empty one. Repeated rows each keep their row; a row without ``doc_id``
    has the remainder of the empty text. An empty table gives an empty result.
    """
    model, source = fit(docs, labels), texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for batch in slices(batches):
            x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(-1, SIZE)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.score(x), pa.float64())], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
