"""Connected components."""

from __future__ import annotations

import numpy as np

from seqloom.llm._graph import components
from seqloom.llm._shared import Workspace


def test_components(spark):
    rng = np.random.default_rng(8)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 150, (90, 2))] + [(k, k + 1) for k in range(200, 215)]
    label = {x: x for p in links for x in p}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "graph"), "g")
    assert {r["node"]: r["label"] for r in got.collect()} == {x: c for x, c in label.items() if any(x in p and p[0] != p[1] for p in links)}


def test_components_of_stars_and_of_nothing(spark):
    ws = Workspace(spark, "graph")
    star = spark.createDataFrame([("c", "a"), ("a", "b"), ("a", "a")], "a string, b string")
    assert {(r["node"], r["label"]) for r in components(star, ws, "s").collect()} == {(x, "a") for x in "abc"}
    assert components(star.limit(0), ws, "n").count() == 0
