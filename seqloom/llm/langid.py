"""Language identification by language-bitmask n-gram filters.

Per language, the byte 4-grams that many of its texts hold go into a Bloom filter. The filters are bit-sliced: row r of the
table is a mask with one bit a language, so the AND of an n-gram's rows names all languages that may hold it. Per text, each
language's bits are counted, corrected for its filter's false positives, and the largest count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _text as X
from ._shared import bounded_sample, text_of

U = np.uint64
WIDTH = 4
_SEEDS = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)]
#: Bytes that are no letters read as a space, A-Z as a-z.
_FOLD = np.where(X.LETTER, X.LOWER, 32).astype(np.uint8)


def grams(s: X.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, gram) of every 4-byte window with a letter in it; a text reads as if two spaces stood before and after it."""
    n = len(s)
    padded = np.full(len(s.data) + 4 * n, 32, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(s.offsets))
    padded[np.arange(len(s.data)) + 4 * owner + 2] = _FOLD[s.data]
    first = s.offsets + 4 * np.arange(n + 1)
    if len(padded) < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    gram = np.zeros(len(padded) - WIDTH + 1, np.uint32)
    for k in range(WIDTH):
        gram |= padded[k : len(padded) - WIDTH + 1 + k].astype(np.uint32) << np.uint32(8 * k)
    size = np.diff(first)
    made = np.maximum(size - WIDTH + 1, 0)
    inside = np.zeros(len(gram) + 1, np.int64)
    np.add.at(inside, first[:-1][made > 0], 1)
    np.add.at(inside, (first[:-1] + made)[made > 0], -1)
    ok = (np.cumsum(inside)[:-1] > 0) & (gram != np.uint32(0x20202020))
    at = np.flatnonzero(ok)
    return np.searchsorted(first, at, "right") - 1, gram[at]


def _rows(gram: np.ndarray, m: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        x = gram.astype(U)
        for seed in _SEEDS:
            yield (X.mix(x * seed + seed) >> U(32)).astype(np.int64) % m


@dataclass
class LanguageFilter:
    """The bit-sliced table (one word of bits per 64 languages) and each language's rate of false positives."""

    languages: list[str]
    table: np.ndarray  # m x words
    rate: np.ndarray

    @classmethod
    def build(cls, profiles: dict[str, np.ndarray], bits: int) -> LanguageFilter:
        languages = sorted(profiles)
        table = np.zeros((bits, -(-len(languages) // 64) or 1), U)
        rate = np.zeros(len(languages))
        for i, language in enumerate(languages):
            for r in _rows(profiles[language], bits):
                np.bitwise_or.at(table[:, i // 64], r, U(1) << U(i % 64))
            rate[i] = ((table[:, i // 64] >> U(i % 64)) & U(1)).mean() ** len(_SEEDS)
        return cls(languages, table, rate)

    def counts(self, s: X.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Per text: n-grams, and n-grams in each language after the correction."""
        owner, gram = grams(s)
        total = np.bincount(owner, minlength=len(s)).astype(float)
        hits = np.zeros((len(s), len(self.languages)))
        rows = list(_rows(gram, len(self.table)))
        for w in range(self.table.shape[1]):
            mask = self.table[rows[0], w]
            for r in rows[1:]:
                mask = mask & self.table[r, w]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                hits[:, i] = np.bincount(owner, (mask >> U(i % 64)) & U(1), len(s))
        return total, np.maximum(0, (hits - total[:, None] * self.rate) / (1 - np.minimum(self.rate, 0.99)))

    def predict(self, s: X.Slice) -> tuple[list[str], np.ndarray]:
        total, hits = self.counts(s)
        if not self.languages:
            return ["und"] * len(s), np.zeros(len(s))
        best = hits.argmax(1)
        share = hits[np.arange(len(s)), best] / np.maximum(hits.sum(1), 1e-12)
        return [self.languages[b] if t else "und" for b, t in zip(best, total, strict=True)], np.where(total > 0, np.clip(share, 0, 1), 0.0)


def learn(labelled: DataFrame, per_language: int = 2000, keep: int = 8192, least: float = 0.005, bits: int = 1 << 17) -> LanguageFilter:
    """Learns from (doc_id, text, lang): whole texts of at most ``per_language`` rows a language, chosen by a hash of doc_id.

    A language's profile: the ``keep`` n-grams in most of its texts, each in a share of ``least`` of them and in two at least, where
    it has eight texts; a language with one text has a profile too. Rows with a null lang or text are left out, rows that repeat
    a doc_id and lang are all learned from, and very long texts are read whole. Of n-grams in as many texts the smaller is kept.
    An empty table gives a model without languages. The filter's size is bounded by the number of languages, ``keep`` and ``bits``.
    """
    ids = labelled.filter("lang is not null and text is not null").select("doc_id", "lang")
    chosen = bounded_sample(ids, "lang", "doc_id", per_language).distinct()
    sample = labelled.select("doc_id", "lang", text_of().alias("text")).join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import defaultdict

        found: dict = defaultdict(list)
        texts: dict = defaultdict(int)
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for s in X.slices(batch.column("text")):
                owner, gram = grams(s)
                pairs = np.unique((owner.astype(U) << U(32)) | gram)  # each n-gram once a text
                own = langs[s.first : s.first + len(s)][(pairs >> U(32)).astype(np.int64)]
                for language in set(langs[s.first : s.first + len(s)]):
                    texts[language] += int((langs[s.first : s.first + len(s)] == language).sum())
                    g, n = np.unique((pairs & U(0xFFFFFFFF))[own == language], return_counts=True)
                    found[language].append((g, n))
        for language, parts in found.items():
            g, back = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([y for _, y in parts])).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"lang": [language] * (len(g) + 1), "gram": np.append(g.astype(np.int64), -1), "n": np.append(n, texts[language])}
            )

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    texts = Window.partitionBy("lang")
    ranked = (
        counts.withColumn("texts", F.max(F.when(F.col("gram") < 0, F.col("n"))).over(texts))
        .filter("gram >= 0")
        .filter(F.col("n") >= F.greatest(F.least(F.lit(2.0), F.col("texts") / 4), F.col("texts") * least))
        .withColumn("rank", F.row_number().over(texts.orderBy(F.desc("n"), "gram")))
        .filter(F.col("rank") <= keep)
    )
    profiles: dict = {}
    for row in ranked.select("lang", "gram").toPandas().itertuples():  # at most ``keep`` a language
        profiles.setdefault(row.lang, []).append(row.gram)
    return LanguageFilter.build({k: np.array(v, np.uint32) for k, v in profiles.items()}, bits)


def predict(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """doc_id, lang_pred, score for each row. 'und' with score 0 where the text is null or has no letters.

    score: the decided language's share of all languages' corrected counts. Equal counts go to the first language by name.
    A very long text is counted whole; rows that repeat are each predicted, an empty table gives an empty one, and other columns
    are ignored. A model without languages predicts 'und'.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        plain = re.compile("[A-Za-z]")
        for batch in batches:
            text = batch.column("text")
            names, scores = [], []
            for s in X.slices(text):
                name, score = model.predict(s)
                names += name
                scores.append(score)
            score = np.concatenate(scores) if scores else np.zeros(0)
            for i, t in enumerate(text):
                # only a text without ASCII letters can be without letters though it has n-grams
                if names[i] != "und" and not plain.search(t := t.as_py()) and not any(map(str.isalpha, t)):
                    names[i], score[i] = "und", 0.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
