"""Benchmark decontamination: a BM25 inverted index of test items, queried by every training passage with block-max WAND.

An item's BM25 score is divided by the score that the item itself gets, so 1 means that a passage holds all its words. Passages
are windows of words, twice as long as the longest item and overlapping by half, so wherever an item stands one window holds it
whole. What is retrieved is verified on the whole text: the question's and the answer's word shingles must both be found there.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._shared import Workspace, text_of

U = np.uint64
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): an item's last sentence is its answer; an item of one sentence is all question."""
    parts = [p for p in _SENTENCE.split(text.strip()) if p]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def _hashes(text: str) -> np.ndarray:
    s = next(X.slices(pa.array([text])))
    return X.words(s, X.LETTER).hash


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct shingles of ``width`` words."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, U)
    value = np.full(n - width + 1, width, U)
    with np.errstate(over="ignore"):
        for k in range(width):
            value = X.mix(value * U(0x9FB21C651E98DF25) + hashes[k : n - width + 1 + k])
    return X.distinct(value)


@dataclass
class ItemIndex:
    """Postings sorted by item, in blocks of ``block`` postings that know their largest impact."""

    items: list
    parts: list[dict[int, tuple[int, np.ndarray]]]  # of question (0) and answer (1), if any: words a shingle, shingles
    terms: np.ndarray  # sorted word hashes
    first: np.ndarray  # postings of term t: first[t]:first[t+1]
    item: np.ndarray
    impact: np.ndarray
    most: np.ndarray  # per term
    block: int
    window: int
    width: int

    @classmethod
    def build(cls, rows: list[tuple], width: int, block: int = 16, k1: float = 1.2, b: float = 0.75, stats: dict | None = None) -> ItemIndex:
        """rows: (item, question, answer). stats: the whole benchmark's n, mean length, and texts per word, if rows are a part of it."""
        found = []
        for item, question, answer in rows:
            q, a = _hashes(question or ""), _hashes(answer or "")
            if len(q) or len(a):
                parts = {k: (min(width, len(x)), grams(x, min(width, len(x)))) for k, x in enumerate((q, a)) if len(x)}
                found.append((item, np.concatenate([q, a]), parts))
        sizes = np.array([len(h) for _, h, _ in found] or [0])
        stats = stats or cls.statistics([h for _, h, _ in found])
        post = []
        for i, (_, h, _) in enumerate(found):
            t, tf = np.unique(h, return_counts=True)
            df = np.array([stats["df"].get(x, 1) for x in t.tolist()])
            idf = np.log1p((stats["n"] - df + 0.5) / (df + 0.5))
            impact = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(h) / stats["mean"]))
            post.append((t, np.full(len(t), i), impact / impact.sum()))
        t, item, impact = (np.concatenate(x) for x in zip(*post, strict=True)) if post else (np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((item, t))
        t, item, impact = t[order], item[order], impact[order]
        terms, first = np.unique(t, return_index=True)
        most = np.maximum.reduceat(impact, first) if len(first) else np.zeros(0)
        return cls([x for x, _, _ in found], [p for _, _, p in found], terms, np.append(first, len(t)), item, impact, most, block, 2 * max(1, int(sizes.max())), width)

    @staticmethod
    def statistics(hashes: list[np.ndarray]) -> dict:
        t, df = np.unique(np.concatenate([np.unique(h) for h in hashes]), return_counts=True) if hashes else (np.zeros(0, U), np.zeros(0, np.int64))
        return {"n": len(hashes), "mean": float(np.mean([len(h) for h in hashes])) if hashes else 1.0, "df": dict(zip(t.tolist(), df.tolist(), strict=True))}

    def _cursors(self) -> tuple:
        """Postings as plain arrays, and for each posting its block's largest impact and the first item after the block."""
        if not hasattr(self, "_plain"):
            n, end = len(self.item), len(self.items)
            owner = np.repeat(np.arange(len(self.terms)), np.diff(self.first))
            place = np.arange(n) - self.first[owner]
            head = place % self.block == 0
            block = np.cumsum(head) - 1
            starts = np.flatnonzero(head)
            top = np.maximum.reduceat(self.impact, starts) if n else np.zeros(0)
            after = np.append(starts[1:], n)
            same = np.append(owner[starts[1:]] == owner[starts[:-1]], False) if n else np.zeros(0, bool)
            beyond = np.where(same, np.append(self.item, end)[after], end)
            self._plain = array("q", self.item.tolist()), array("d", self.impact.tolist()), array("d", top[block].tolist()), array("q", beyond[block].tolist())
        return self._plain

    def block_max_wand(self, query: np.ndarray, threshold: float, low: int = 0, high: int | None = None) -> list[tuple[int, float]]:
        """(item, score) of all items from ``low`` and before ``high`` whose score for the query's terms reaches the threshold."""
        item, impact, top, beyond = self._cursors()
        end, out = len(self.items) if high is None else high, []
        lists = [[item[a], a, b, m] for a, b, m in zip(self.first[query].tolist(), self.first[query + 1].tolist(), self.most[query].tolist(), strict=True)]
        for x in lists:
            if x[0] < low:
                x[1] = bisect_left(item, low, x[1], x[2])
                x[0] = item[x[1]] if x[1] < x[2] else end
        while True:
            lists = [x for x in lists if x[0] < end]
            lists.sort()
            total, pivot = 0.0, -1
            for k, x in enumerate(lists):
                total += x[3]
                if total >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return out
            at = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == at:
                pivot += 1
            bound, until = 0.0, end
            for x in lists[: pivot + 1]:
                p = x[1] if x[0] == at else bisect_left(item, at, x[1], x[2])
                if p < x[2]:
                    bound += top[p]
                    if beyond[p] < until:
                        until = beyond[p]
            if bound < threshold:  # no item before the nearest block's end can reach it
                to = max(until if pivot + 1 == len(lists) else min(until, lists[pivot + 1][0]), at + 1)
            elif lists[0][0] == at:
                value, to = 0.0, at + 1
                for x in lists[: pivot + 1]:
                    value += impact[x[1]]
                if value >= threshold:
                    out.append((at, value))
            else:
                to = at
            for x in lists[: pivot + 1]:
                if x[0] < to:
                    x[1] = bisect_left(item, to, x[1], x[2])
                    x[0] = item[x[1]] if x[1] < x[2] else end

    def retrieve(self, s: X.Slice, w: X.Words, threshold: float) -> dict[tuple[int, int], float]:
        """(text, item) to the best score of the text's passages, for all that reach the threshold."""
        if not len(self.terms) or not len(w.hash):
            return {}
        at = np.minimum(np.searchsorted(self.terms, w.hash), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == w.hash)
        size = np.bincount(w.doc, minlength=len(s))
        begin = np.concatenate([[0], np.cumsum(size)])
        half = self.window // 2
        slots = size // half + 2
        slot0 = np.concatenate([[0], np.cumsum(slots)])
        place = (known - begin[w.doc[known]]) // half
        late = slot0[w.doc[known]] + place + 1  # the window that begins at its half, and the one before
        n = len(self.terms)
        pairs = X.distinct(np.concatenate([late, late - 1]) * n + np.concatenate([at[known]] * 2))
        passage, term = pairs // n, pairs % n
        best = np.bincount(passage, self.most[term], slot0[-1])  # the sum of upper bounds: no pivot exists below it
        ok = best[passage] >= threshold
        passage, term = passage[ok], term[ok]
        found: dict = {}
        for p, q, low, high in self._by_ranges(passage, term, threshold):
            for item, value in self.block_max_wand(q, threshold, low, high):
                key = (int(np.searchsorted(slot0, p, "right") - 1), item)
                found[key] = max(found.get(key, 0.0), value)
        return found

    def _by_ranges(self, passage: np.ndarray, term: np.ndarray, threshold: float, span: int = 4) -> Iterator[tuple[int, np.ndarray, int, int]]:
        """(passage, its terms, first item, item after the last) of each range of items whose largest impacts reach the threshold together."""
        if not len(passage):
            return
        n = -(-len(self.items) // span)
        if not hasattr(self, "_ranges"):
            owner = np.repeat(np.arange(len(self.terms)), np.diff(self.first))
            cell, where = np.unique(owner * n + self.item // span, return_index=True)
            self._ranges = np.searchsorted(cell // n, np.arange(len(self.terms) + 1)), cell % n, np.maximum.reduceat(self.impact, where)
        first, key, top = self._ranges
        count = first[term + 1] - first[term]
        at = np.repeat(first[term] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        ids, dense = np.unique(passage, return_inverse=True)
        cut = np.append(np.searchsorted(passage, ids), len(passage))
        step = max(1, (1 << 22) // n)  # passages at a time, so that the table of bounds stays small
        own = np.repeat(dense, count)
        edges = np.searchsorted(own, np.arange(0, len(ids) + step, step))
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            low = k * step
            bound = np.bincount((own[a:b] - low) * n + key[at[a:b]], top[at[a:b]], step * n).reshape(step, n)
            for i, r in zip(*np.nonzero(bound >= threshold), strict=True):
                yield int(ids[low + i]), term[cut[low + i] : cut[low + i + 1]], int(r) * span, min(int(r) * span + span, len(self.items))

    def verify(self, hashes: np.ndarray, item: int, made: dict) -> list[float]:
        """The shares of the question's and of the answer's shingles in a text's words. A missing part counts as found.

        made: keeps the text's shingles by width for its next item.
        """
        shares = [1.0, 1.0]
        for k, (width, part) in self.parts[item].items():
            if width not in made:
                made[width] = grams(hashes, width)
            shares[k] = float(np.isin(part, made[width]).mean())
        return shares


def index_blocks(benchmark: DataFrame, width: int, most_bytes: int) -> Iterator[ItemIndex]:
    """The benchmark's index in blocks of items, each of at most about ``most_bytes`` of text; statistics cover all items."""
    columns = benchmark.columns
    split = "question" in columns and "answer" in columns
    picked = benchmark.select("item_id", *((text_of(c).alias(c) for c in ("question", "answer")) if split else (text_of().alias("text"),)))
    total = picked.agg(F.sum(sum((F.octet_length(c) for c in picked.columns[1:]), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-total // most_bytes))
    dealt = picked.withColumn("block_", F.pmod(F.xxhash64(*picked.columns), F.lit(blocks)))

    def rows_of(k: int) -> list[tuple]:
        return [(r[0], r[1], r[2]) if split else (r[0], *split_item(r[1])) for r in dealt.filter(F.col("block_") == k).distinct().sort("item_id").collect()]

    stats = None
    if blocks > 1:
        n, length, df = 0, 0, {}
        for k in range(blocks):
            one = ItemIndex.statistics([h for _, q, a in rows_of(k) if len(h := np.concatenate([_hashes(q or ""), _hashes(a or "")]))])
            n, length = n + one["n"], length + one["n"] * one["mean"]
            for t, c in one["df"].items():
                df[t] = df.get(t, 0) + c
        stats = {"n": n, "mean": length / max(1, n), "df": df}
    for k in range(blocks):
        yield ItemIndex.build(rows_of(k), width, stats=stats)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.8, width: int = 5, most_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every text that holds a test item.

    Words are lower-cased runs of letters. An item is retrieved by a passage from ``threshold`` of its own score, and counts
    from ``overlap`` of the ``width``-word shingles of both its question and its answer (columns of these names, or the text but
    its last sentence and that). Null and blank texts and items match nothing, nor do items without a letter; repeated rows are
    each reported; equal items, and items that tie, are each reported under their item_id. A very long text is searched whole,
    in overlapping passages; an empty table on either side gives an empty result; other columns are ignored. The benchmark is the stated query side: it is broadcast in blocks of ``most_bytes``.
    """
    source = docs.select("doc_id", text_of().alias("text"))
    ids = benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for index in index_blocks(benchmark, width, most_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = []
                doc_ids = batch.column("doc_id").to_pylist()
                for s in X.slices(batch.column("text")):
                    w = X.words(s, X.LETTER)
                    begin = np.searchsorted(w.doc, np.arange(len(s) + 1))
                    last, made = -1, {}
                    for (d, item), value in sorted(index.retrieve(s, w, threshold).items()):
                        if d != last:
                            last, made = d, {}
                        q, a = index.verify(w.hash[begin[d] : begin[d + 1]], item, made)
                        if q >= overlap and a >= overlap:
                            rows.append((doc_ids[s.first + d], index.items[item], value, q, a))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
                    )

        part = source.mapInArrow(run, f"doc_id long, item_id {ids}, score double, question_overlap double, answer_overlap double")
        out = part if out is None else out.unionByName(part)
    return out
