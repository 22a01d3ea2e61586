"""Importance resampling against a plain version, feature by feature."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from seqloom.llm import resample

from .helpers import AWKWARD, frame, lower
from .test_clashes import clashing

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(texts, aims, n, buckets=10_000, least=20, percent=10):
    def runs(text):
        w = WORD.findall(lower(text or ""))
        return len(w), [crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    own, aimed = [runs(t) for t in texts], [runs(t) for t in aims]
    s, t = (Counter(b for _, x in part for b in x) for part in (own, aimed))
    ns, nt = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (ns + buckets)) / ((s[b] + 1) * (nt + buckets))))
    out = []
    for i, (words, found) in enumerate(own):
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(order[: percent * len(order) // 100], 1):
        r[4] = k
    return sorted(map(tuple, out))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_runs_weights_and_draw(spark, n):
    texts = [*AWKWARD, *(" ".join(f"w{(i * j) % 13}" for j in range(15 + i)) for i in range(40)), "same words " * 30, "same words " * 30]
    aims = ["w1 w2 w3 w4", "A b c", None, "same words"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(aims)], "item_id long, text string")
    want = plain(texts, aims, n, least=10, percent=30)
    for docs in (frame(spark, texts), clashing(frame(spark, texts))):
        got = resample.resample(docs, target, n=n, least_words=10, percent=30)
        assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == want
    assert sum(r[4] is not None for r in want) > 5


def test_a_text_cut_into_pieces_is_one_text(monkeypatch):
    text = "ab cd,ef  gh " * 50 + "x" * 300
    whole = [(sum(w for w, _ in found), np.concatenate([b for _, b in found]).tolist()) for found in [list(resample.scan(text, 3, 1000))]]
    monkeypatch.setattr(resample, "_PIECE", 37)
    assert whole == [(sum(w for w, _ in found), np.concatenate([b for _, b in found]).tolist()) for found in [list(resample.scan(text, 3, 1000))]]


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, none).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b d")], none.schema)
    rows = resample.resample(docs, none, n=1, least_words=1, percent=100).collect()
    assert len(rows) == 3 and {r["rank"] for r in rows} == {1, 2, 3} and len({(r["doc_id"], r["weight"]) for r in rows}) == 2
