"""The suffix sort and the removal of repeats against plain versions."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from seqloom.llm import suffix

from .helpers import AWKWARD, DOCS, frame


def plain(texts, length=100):
    """(n_bytes, n_removed, n_spans, sha256) of each text, in order."""
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        gone = gone[: len(raw)]
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 2 + seed % 5, rng.integers(1, 200))
    full = [int(i) for i in suffix.suffix_array(text, 10**6)]
    assert full == sorted(range(len(text)), key=lambda i: tuple(text[i:].tolist()))
    cut = suffix.suffix_array(text, 9)
    assert sorted(cut.tolist()) == list(range(len(text)))
    heads = [tuple(text[i : i + 9].tolist()) for i in cut]
    assert heads == sorted(heads)


def results(df):
    return [tuple(r)[1:5] for r in sorted(df.collect(), key=lambda r: r["doc_id"])]


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    assert results(suffix.remove_repeats(docs, keep=False)) == plain(texts)


@pytest.mark.parametrize("options", [{}, {"most_contexts": 1}, {"batch_bytes": 300}])
def test_repeats(spark, options):
    rng = np.random.default_rng(7)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    line, page = word(150), word(700)
    texts = [*AWKWARD, page, word(50) + line + word(30), line, page[:350] + "X" + page[350:], page[100:], line[:99], line[20:], word(10) + line[:100] + word(20)]
    texts += ["ab" * 200, "ab" * 120, page + page, line * 3, page[:300] + line + page[300:], *(word(40) + line + word(40) for _ in range(30)), page, page]
    df = suffix.remove_repeats(frame(spark, texts), **options)
    assert results(df) == plain(texts)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in df.collect())
    assert results(suffix.remove_repeats(frame(spark, texts), length=30, **options)) == plain(texts, 30)


def test_nothing_and_nameless(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    same = "0123456789" * 30
    rows = [(None, same, None, None, None), (1, same, None, None, None), (1, same, None, None, None), (2, same, None, None, None)]
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in suffix.remove_repeats(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [("1", 290), ("1", 290), ("2", 300), ("None", 0)]
