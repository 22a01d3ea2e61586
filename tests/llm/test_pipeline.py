"""The pipeline's stages against plain versions, each on what the stage before it left."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from seqloom.llm import decontam, toxicity

from .helpers import DOCS, frame, groups, lower

SF = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    out, docs = [spark.read.parquet(f"{SF}/documents.parquet")], None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [s.count() for s in stages[:-1]] == sorted((s.count() for s in stages[:-1]), reverse=True)


def test_toxicity(spark, stages):
    model = toxicity.learn(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.score(stages[0], model).filter("predicted = 1").collect()}
    assert toxic and texts(stages[1]).keys() == texts(stages[0]).keys() - toxic


def test_exact(stages):
    best = {}
    for d, t in texts(stages[1]).items():
        key = re.sub("[ \t\n\x0b\x0c\r]", "", t)
        best[key] = min(best.get(key, (1, 0)), (-len(t), d))
    assert texts(stages[2]).keys() == {d for _, d in best.values()}


def test_near(stages):
    rows = sorted(texts(stages[2]).items())
    component = groups([t for _, t in rows], 5)
    assert texts(stages[3]).keys() == {rows[c][0] for c in component}


def test_leaks(spark, stages):
    letters = re.compile("[A-Za-z\x80-\U0010ffff]+")
    words = lambda t: [lower(w) for w in letters.findall(t)]
    gram = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    items = [[w for w in map(words, decontam.split_item(r["text"])) if w] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {
        d
        for d, t in texts(stages[3]).items()
        if not any(parts and all(len(gram(p, k := min(5, len(p))) & gram(words(t), k)) >= 0.8 * len(gram(p, k)) for p in parts) for parts in items)
    }
    assert texts(stages[4]).keys() == clean != texts(stages[3]).keys()


def test_packed(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in stages[5].collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in texts(stages[4]).items()}
    assert got.keys() == ids.keys()
    for d, pieces in got.items():
        assert all(zlib.crc32(np.array(ids[d][a : a + n], "<u4").tobytes()) == c for a, n, c in pieces) and sum(n for _, n, _ in pieces) == len(ids[d])


def test_run_and_nothing(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[5].count()
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_awkward(spark):
    docs = frame(spark, [None, "", " ", "a", None, "x " * 3000, "a"]).union(spark.createDataFrame([(None, "lost words", None, None, None), (None, None, None, None, None)], DOCS))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"] for r in docs.collect()} == {2, 3, 5, None}
