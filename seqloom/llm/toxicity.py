"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence with known words has the probability sigmoid(sum of its words' weights + bias), one without has none; a document's
probability is the noisy-or of its sentences and a leak. Weights, bias and leak are trained from document labels alone; the
sentences' probabilities then locate what offends.
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

U = np.uint64


def sentence_words(s: X.Slice) -> tuple[X.Words, np.ndarray]:
    """The words (runs of letters) of a slice and the sentence each is in, numbered through the slice."""
    w = X.words(s, X.LETTER)
    ends = np.cumsum(X.ENDS[s.data])
    return w, ends[w.start] + w.doc if len(w.start) else np.zeros(0, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float
    leak: float  # log of 1 - leak

    def sentences(self, s: X.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the sentences with known words: text, probability, and the bytes from the first to the last known word."""
        w, sentence = sentence_words(s)
        at = np.searchsorted(self.vocabulary, w.hash)
        at[at == len(self.vocabulary)] = 0
        known = np.flatnonzero(self.vocabulary[at] == w.hash) if len(self.vocabulary) else np.zeros(0, np.int64)
        if not len(known):
            return (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        # a word counts once in a sentence
        once = np.unique(sentence[known].astype(U) << U(32) | at[known].astype(U))
        ids, back = np.unique((once >> U(32)).astype(np.int64), return_inverse=True)
        z = np.bincount(back, self.weights[(once & U(0xFFFFFFFF)).astype(np.int64)]) + self.bias
        first = np.searchsorted(sentence[known], ids)
        last = np.searchsorted(sentence[known], ids, "right") - 1
        return w.doc[known[first]], _sigmoid(z), w.start[known[first]], w.end[known[last]]

    def score(self, s: X.Slice) -> np.ndarray:
        doc, p, _, _ = self.sentences(s)
        return 1 - np.exp(self.leak + np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(s)))


def fit_noisy_or(bags: list[list[np.ndarray]], labels: np.ndarray, sample_weight: np.ndarray, size: int, steps: int = 300) -> tuple[np.ndarray, float, float]:
    """Weights, bias and log(1 - leak) that maximise the weighted likelihood of ``labels``. bags: per document, per sentence, word numbers."""
    sent_doc = np.array([d for d, bag in enumerate(bags) for _ in bag], np.int64)
    flat = [x for bag in bags for x in bag]
    word = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    word_sent = np.repeat(np.arange(len(flat)), [len(x) for x in flat]) if flat else np.zeros(0, np.int64)
    y, share = labels.astype(float), sample_weight / sample_weight.sum()
    theta = np.concatenate([np.full(size, 1.0), [-1.0, -3.0]])  # weights, bias, logit of the leak
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        p = _sigmoid(np.bincount(word_sent, theta[word], len(flat)) + theta[size])
        leak = _sigmoid(theta[size + 1])
        none = np.exp(np.log1p(-min(leak, 1 - 1e-9)) + np.bincount(sent_doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags)))
        pull = share * np.where(y > 0, none / np.maximum(1 - none, 1e-9), -1.0)  # d likelihood / d z is pull * p
        by_sent = pull[sent_doc] * p
        grad = np.concatenate([np.bincount(word, by_sent[word_sent], size), [by_sent.sum(), (pull * leak).sum()]])
        grad[:size] -= 1e-4 * theta[:size]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:size], float(theta[size]), float(np.log1p(-_sigmoid(theta[size + 1])))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = 6000, words: int = 2000, least: int = 5, lift: float = 2.0) -> ToxicityModel:
    """Learns from the texts of ``docs`` whose doc_id ``labels`` (doc_id, toxic) marks.

    The sample is bounded: whole texts of at most ``per_label`` rows of either label, chosen by a hash of doc_id and weighted
    by the label's share of all. Null labels and doc_ids are left out; of contradicting labels of one doc_id, 1 counts; of several
    texts of one doc_id the longest is read, then the greatest. A null text has no sentences; very long ones are read whole. Of
    words of equal association the smaller hash is known.
    Known words: the ``words`` of strongest association, in ``least`` toxic texts of the sample or more and at least ``lift``
    times as frequent in toxic ones. Without any label nothing is known and every score is the leak's.
    """
    ws = Workspace(docs.sparkSession, "toxicity")
    marked = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = docs.select("doc_id").filter("doc_id is not null").distinct().join(marked, "doc_id")
    chosen = ws.save(bounded_sample(marked, "toxic", "doc_id", per_label), "chosen")
    all_of = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(all_of) < 2:
        only = next(iter(all_of), 0)
        return ToxicityModel(np.zeros(0, U), np.zeros(0), 0.0, float(np.log(0.01 if only else 0.99)))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in X.slices(batch.column("text")):
                w, sentence = sentence_words(s)
                pairs = np.unique(np.stack([sentence.astype(U), w.hash, w.doc.astype(U)]), axis=1) if len(w.doc) else np.zeros((3, 0), U)
                first = np.searchsorted(pairs[2].astype(np.int64), np.arange(len(s) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(s.first, len(s)),
                        batch.column("toxic").slice(s.first, len(s)),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pairs[0].astype(np.int64))),
                        pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pairs[1].view(np.int64))),
                    ],
                    ["doc_id", "toxic", "sentences", "hashes"],
                )

    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # of at most 2 * per_label documents
    texts = texts.groupBy("doc_id", "toxic").agg(F.max(F.struct(F.length("text").alias("size"), "text"))["text"].alias("text"))
    sample = ws.save(texts.mapInArrow(bags, "doc_id long, toxic int, sentences array<long>, hashes array<long>"), "sample")
    held = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    df = sample.select("toxic", F.explode(F.array_distinct("hashes")).alias("h")).groupBy("h").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )
    n_t, n_c = max(1, held.get(1, 0)), max(1, held.get(0, 0))
    rate_t, rate_c = F.col("t") / n_t, F.col("c") / n_c
    pooled = (F.col("t") + F.col("c")) / (n_t + n_c)
    z = (rate_t - rate_c) / F.sqrt(pooled * (1 - pooled) * (1 / n_t + 1 / n_c) + 1e-12)
    known = df.filter((F.col("t") >= least) & (rate_t >= lift * rate_c) & (z >= 4)).orderBy(F.desc(z), "h").limit(words).select("h")
    vocabulary = np.sort(np.array([r["h"] for r in known.collect()], np.int64).view(U))  # at most ``words``

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sentences, hashes in zip(batch.column("sentences"), batch.column("hashes"), strict=True):
                h = hashes.values.to_numpy(zero_copy_only=False).view(U) if len(hashes) else np.zeros(0, U)
                at = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
                ok = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
                inside = sentences.values.to_numpy(zero_copy_only=False) if len(sentences) else np.zeros(0, np.int64)
                rows.append((inside[ok], at[ok]))
            columns = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *columns], ["doc_id", "toxic", "sentences", "known"])

    # the known words of the bounded sample
    data = sample.mapInArrow(narrow, "doc_id long, toxic int, sentences array<long>, known array<long>").orderBy("doc_id").collect()
    bag_list = []
    for row in data:
        by: dict = {}
        for sentence, word in zip(row["sentences"], row["known"], strict=True):
            by.setdefault(sentence, []).append(word)
        bag_list.append([np.array(v, np.int64) for v in by.values()])
    y = np.array([r["toxic"] for r in data])
    weight = np.where(y > 0, all_of[1] / n_t, all_of[0] / n_c)
    weights, bias, leak = fit_noisy_or(bag_list, y, weight, len(vocabulary))
    return ToxicityModel(vocabulary, weights, bias, leak)


def score(docs: DataFrame, model: ToxicityModel, spans: bool = True) -> DataFrame:
    """doc_id, score, predicted and, with ``spans``, the offending sentences: their bytes from the first to the last known word.

    Null and empty texts get the leak's score. predicted is 1 from a score of 0.5, so a tie counts as toxic. A very long text is
    scored whole, rows that repeat are each scored, an empty table gives an empty one, and other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, offending = [], []
            for s in X.slices(batch.column("text")):
                found.append(np.clip(model.score(s), 0, 1))
                if spans:
                    doc, p, a, b = model.sentences(s)
                    own: list = [[] for _ in range(len(s))]
                    for i in np.flatnonzero(p >= 0.5):
                        own[doc[i]].append({"start": int(a[i] - s.offsets[doc[i]]), "end": int(b[i] - s.offsets[doc[i]]), "score": float(p[i])})
                    offending += own
            value = np.concatenate(found) if found else np.zeros(0)
            arrays = [batch.column("doc_id"), pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
            if spans:
                arrays.append(pa.array(offending, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "predicted", "offending"][: len(arrays)])

    schema = "doc_id long, score double, predicted int" + ", offending array<struct<start: long, end: long, score: double>>" * spans
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
