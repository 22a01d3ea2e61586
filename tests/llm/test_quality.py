"""Positive-unlabelled quality: held-out labels, the prior, and the risk by plain formulas."""

from __future__ import annotations

import numpy as np
import pytest

from seqloom.llm import _text, quality, queries

from .helpers import AWKWARD, frame
from .test_clashes import clashing


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op12_quality(spark, sf).collect()}
    assert got.keys() == {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    labels = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality is not null").collect() if r["doc_id"] in got]
    held = [(q, r["predicted"]) for q, r in labels if r["held_out"]]
    assert len(held) > 30 and np.mean([q == p for q, p in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_prior_of_a_mixture():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.9):
        p = rng.normal(2, 1, 3000)
        u = np.where(rng.random(6000) < share, rng.normal(2, 1, 6000), rng.normal(-3, 1, 6000))
        assert quality.estimate_prior(p, u) == pytest.approx(share, abs=0.05)


def test_risk_keeps_negatives_apart_without_negative_labels():
    rng = np.random.default_rng(4)
    p, n = rng.normal(1.5, 1, (800, 2)), rng.normal(-1.5, 1, (800, 2))
    u = np.concatenate([rng.normal(1.5, 1, (800, 2)), n])
    one = lambda x: np.concatenate([x, np.ones((len(x), 1))], 1)
    w = quality.fit_non_negative(one(p), one(u), 0.5)
    assert (one(p) @ w > 0).mean() > 0.93 and (one(n) @ w < 0).mean() > 0.93
    # the slope vanishes where the risk is smallest: no nearby weights have less
    risk = lambda t: 0.5 * np.logaddexp(0, -one(p) @ t).mean() + max(0, np.logaddexp(0, one(u) @ t).mean() - 0.5 * np.logaddexp(0, one(p) @ t).mean())
    assert all(risk(w) <= risk(w + d) + 2e-3 for d in 0.3 * rng.normal(size=(20, 3)))


def test_features_by_hand():
    import pyarrow as pa

    s = next(_text.slices(pa.array(["AB! AB! c4", "", "x x x y"])))
    x = quality.features(s)
    names = {c: 7 + quality._SIGNS.index(ord(c)) for c in "!"}
    assert x[0, names["!"]] ** 2 == pytest.approx(2 / 10) and x[0, 1] ** 2 == pytest.approx(4 / 10) and x[0, 2] ** 2 == pytest.approx(1 / 10)
    again, commonest, distinct, shouted, signed, alone = (x[:, quality._KINDS : quality._KINDS + 6] ** 2).T
    assert again.tolist() == pytest.approx([1 / 3, 0, 2 / 4]) and commonest.tolist() == pytest.approx([2 / 3, 0, 3 / 4])
    assert distinct.tolist() == pytest.approx([2 / 3, 0, 2 / 4]) and shouted.tolist() == pytest.approx([2 / 3, 0, 0])
    assert signed.tolist() == pytest.approx([2 / 3, 0, 0]) and alone.tolist() == [0, 0, 0] and not x[1].any()


def test_awkward_input(spark):
    texts = [*AWKWARD, "good words of many kinds. " * 9, "BAD!! BAD!! " * 40_000]
    labels = spark.createDataFrame([(i, None if i % 5 == 4 else i % 2) for i in range(8)] + [(1, 1), (None, 1)], "doc_id long, quality int")
    docs = frame(spark, texts)
    rows = [sorted(map(tuple, quality.score(d, quality.learn(d, clashing(labels))).collect())) for d in (docs, clashing(docs))]
    assert rows[0] == rows[1] and len(rows[0]) == len(texts) and all(0 <= r[1] <= 1 for r in rows[0])
    none = quality.learn(docs.limit(0), labels)
    assert {r["predicted"] for r in quality.score(docs, none).collect()} == {1} and quality.score(docs.limit(0), none).count() == 0
    again = docs.unionByName(docs)
    assert quality.score(again, none).count() == 2 * len(texts)
