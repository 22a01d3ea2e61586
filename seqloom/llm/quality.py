"""Quality from trusted positives and unlabelled text: non-negative positive-unlabelled risk over the shape of a text.

Nothing marked as bad is learned from. A first model that tells positives from unlabelled texts gives the class prior (the smallest
ratio of unlabelled to positive texts above a score, with a bound on its error); the second minimises the non-negative unbiased risk
at that prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._shared import Workspace, bounded_sample, text_of

#: What each byte counts as: one kind for every ASCII sign, and lower case, upper case, digits, spaces, line ends, controls, others.
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
_KIND = np.full(256, 6, np.int64)
_KIND[0:32] = _KIND[127] = 5
_KIND[[10, 13]] = 4
_KIND[[9, 32]] = 3
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 0
_KIND[_SIGNS] = 7 + np.arange(len(_SIGNS))
_KINDS = 7 + len(_SIGNS)
#: Features of a text: the kinds' shares of its bytes, then of its words: equal to the word before, the commonest one, the distinct
#: ones, all upper case, ending in a sign, single signs; the words' mean length and the logarithm of their number.
FEATURES = _KINDS + 8


def features(s: X.Slice) -> np.ndarray:
    """texts x FEATURES. Square roots of shares, so rare signs count; a text without bytes has zeros."""
    n = len(s)
    size = np.diff(s.offsets)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * _KINDS + _KIND[s.data], minlength=n * _KINDS).reshape(n, _KINDS)
    w = X.words(s)
    words = np.bincount(w.doc, minlength=n)
    again = np.zeros(len(w.doc), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    commonest = np.zeros(n, np.int64)
    np.maximum.at(commonest, d[first], times)
    upper = np.concatenate([[0], np.cumsum(_KIND[s.data] == 1)])
    lower = np.concatenate([[0], np.cumsum(_KIND[s.data] == 0)])
    shouted = (upper[w.end] - upper[w.start] > 1) & (lower[w.end] == lower[w.start])
    signed = _KIND[s.data[w.end - 1]] >= 7 if len(w.end) else np.zeros(0, bool)
    alone = signed & (w.end - w.start == 1)
    count = lambda flag: np.bincount(w.doc, flag, n)
    of_words = np.stack([count(again), commonest, np.bincount(d[first], minlength=n), count(shouted), count(signed), count(alone)], 1)
    shares = np.concatenate([kinds / np.maximum(size, 1)[:, None], of_words / np.maximum(words, 1)[:, None]], 1)
    mean = np.bincount(w.doc, (w.end - w.start).astype(float), n) / np.maximum(words, 1)
    return np.concatenate([np.sqrt(shares), np.log1p(mean)[:, None], np.log1p(words)[:, None]], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(theta)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta


def fit_contrast(p: np.ndarray, u: np.ndarray, steps: int = 500, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights (the last is the bias) of a logistic model that tells rows of ``p`` from rows of ``u``, either side weighing half."""

    def gradient(t: np.ndarray) -> np.ndarray:
        return -0.5 * p.T @ _sigmoid(-(p @ t)) / len(p) + 0.5 * u.T @ _sigmoid(u @ t) / len(u) + decay * t

    return _descend(gradient, p.shape[1], steps, rate)


def estimate_prior(p_scores: np.ndarray, u_scores: np.ndarray, delta: float = 0.1) -> float:
    """The share of positives among the unlabelled, from scores of rows that no model saw.

    Above any score, unlabelled rows are at least the prior times the positive rows. The threshold whose ratio has the smallest
    upper confidence bound decides.
    """
    at = np.sort(p_scores)
    above_p = 1 - np.arange(len(at)) / len(at)
    above_u = 1 - np.searchsorted(np.sort(u_scores), at, "left") / len(u_scores)
    slack = np.sqrt(np.log(4 / delta) / (2 * len(p_scores))) + np.sqrt(np.log(4 / delta) / (2 * len(u_scores)))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit_non_negative(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-5) -> np.ndarray:
    """Weights that minimise prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]) for the logistic loss l.

    Where the second part, the risk on negatives, falls below zero, a step goes back up that part alone, so the model can't push
    it there by memorising rows.
    """

    def gradient(t: np.ndarray) -> np.ndarray:
        gp, gu = p @ t, u @ t
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        by_negative = u.T @ _sigmoid(gu) / len(u) - prior * p.T @ _sigmoid(gp) / len(p)
        if negative < 0:
            return -by_negative
        return by_negative - prior * p.T @ _sigmoid(-gp) / len(p) + decay * t

    return _descend(gradient, p.shape[1], steps, rate)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, s: X.Slice) -> np.ndarray:
        x = np.clip((features(s) - self.mean) / self.scale, -20, 20)
        return _sigmoid(np.concatenate([x, np.ones((len(x), 1))], 1) @ self.weights)


def _features_of(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in X.slices(batch.column("text")):
                x = pa.array(features(s).ravel())
                column = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * FEATURES, pa.int32()), x)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(s.first, len(s)), batch.column("positive").slice(s.first, len(s)), column], ["doc_id", "positive", "x"])

    return texts.mapInArrow(run, "doc_id long, positive int, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 12_000, seed: int = 7) -> QualityModel:
    """Learns from texts of ``docs`` whose doc_id ``labels`` (doc_id, quality) marks with 1, and from texts of ``docs`` without a mark.

    Marks of 0 are not used, and neither are null labels and doc_ids; of contradicting marks of one doc_id the smaller counts. The
    two samples are bounded by ``positives`` and ``unlabelled``, chosen by a hash of doc_id over all rows; their texts are read
    whole, a null one as empty; of several texts of one doc_id the longest is read, then the greatest. A quarter of either sample
    is kept from the first model and gives the prior. Without positives or other texts the model scores 1 - nothing tells what is bad.
    """
    ws = Workspace(docs.sparkSession, "quality")
    marked = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("q"))
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    known = ids.join(marked.filter("q = 1").select("doc_id", F.lit(1).alias("positive")), "doc_id")
    free = ids.join(marked.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.lit(0).alias("positive"))
    chosen = ws.save(bounded_sample(known, "positive", "doc_id", positives).unionByName(bounded_sample(free, "positive", "doc_id", unlabelled)), "chosen")
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # of at most positives + unlabelled ids
    texts = texts.groupBy("doc_id", "positive").agg(F.max(F.struct(F.length("text").alias("size"), "text"))["text"].alias("text"))
    rows = ws.save(_features_of(texts), "sample").orderBy("doc_id").toPandas()  # the bounded sample: FEATURES numbers a text
    if rows["positive"].nunique() < 2:
        return QualityModel(np.zeros(FEATURES), np.ones(FEATURES), np.append(np.zeros(FEATURES), 30.0), 1.0)
    x, y = np.stack(rows["x"].to_numpy()), rows["positive"].to_numpy() == 1
    mean, scale = x[~y].mean(0), x[~y].std(0) + 1e-3
    x = np.concatenate([np.clip((x - mean) / scale, -20, 20), np.ones((len(x), 1))], 1)
    kept = np.random.default_rng(seed).random(len(x)) < 0.25
    if not (kept & y).any() or not (kept & ~y).any() or not (~kept & y).any() or not (~kept & ~y).any():
        kept[:] = True  # too few texts to keep some back
        contrast = fit_contrast(x[y], x[~y])
    else:
        contrast = fit_contrast(x[y & ~kept], x[~y & ~kept])
    prior = estimate_prior(x[y & kept] @ contrast, x[~y & kept] @ contrast)
    return QualityModel(mean, scale, fit_non_negative(x[y], x[~y], prior), prior)


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (the probability of quality 1) and predicted (1 from ``threshold`` on, ties too) of each row.

    Null and empty texts are scored as texts without bytes, very long ones whole, and rows that repeat are each scored; an empty
    table gives an empty one, and other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(s) for s in X.slices(batch.column("text"))]
            value = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value), pa.array((value >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
