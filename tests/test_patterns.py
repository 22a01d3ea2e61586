"""Primers and anchors over batches against plain versions, read by read."""

from __future__ import annotations

import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import patterns, primers
from seqloom.operators.trim import TrimParams, trim_reads


def letters(rng, n, alphabet="ACGT"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], left + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def as_bytes(words, width):
    return np.array([list(w.encode().ljust(width, b"\0")) for w in words], np.uint8)


def test_bit_vectors_equal_the_tables():
    rng = random.Random(1)
    for m in (1, 2, 9, 31, 63, 64):
        form = ["".join(rng.sample("ACGT", rng.choice([1, 1, 1, 2, 4]))) for _ in range(m)]
        plain = [set("".join(p) for p in product(*form))] if np.prod([float(len(f)) for f in form]) < 300 else None
        words = [letters(rng, m, "ACGTN") for _ in range(40)]
        if plain is None:
            form = list(letters(rng, m))
            plain = [{"".join(form)}]
        windows = as_bytes(words, m)
        assert patterns.edits(windows, form).tolist() == [min(levenshtein(w, p) for p in plain[0]) for w in words]
        short = [w[: rng.randrange(m + 1)] for w in words]
        assert patterns.common(as_bytes(short, m), form).tolist() == [max(lcs(w, p) for p in plain[0]) for w in short]
    with pytest.raises(ValueError):
        patterns.masks("A" * 65)


def slow_anchor(read, anchor, least=0.9):
    """Windows one by one and sequences one by one, as anchors are documented."""
    starts, step = [anchor.start], 1
    while len(starts) < 2 * anchor.freedom + 1:
        starts.append(starts[-1] + step)
        step = -step - 1 if step > 0 else -step + 1
    windows = [(-s, -(s - anchor.length)) if anchor.reversed else (s, s + anchor.length) for s in starts]
    found = []
    for form in primers.expand(anchor.sequence):
        near = []
        for a, b in windows:
            part = read[a:b]
            r = 2 * lcs(part, form) / (len(part) + len(form))
            if part == form:
                return form, a, b, 1.0
            if r >= least:
                near.append((r, (a, b)))
        if near:
            found.append((form, max(near)))
    if not found:
        return None
    form, (r, (a, b)) = sorted(found, key=lambda x: x[1][0], reverse=True)[0]
    return form, a, b, r


#: Four anchors like those in use: two count from the read's end.
ANCHORS = [
    primers.Anchor("a", True, 36, 12, 13, "G[T,G]AG.[A,G]GT[A,G][A,G]AAT"),
    primers.Anchor("b", True, 48, 20, 11, "G[T,G]AG.[A,G]GT[A,G][A,G]AAT"),
    primers.Anchor("c", False, 44, 10, 13, "GGATTAGA[T,G]ACCC"),
    primers.Anchor("d", False, 5, 9, 12, "[A,T,C][A,T,G]GCGAA[A,G]GC[A,G][A,C,G]"),
]


@pytest.mark.parametrize("anchor", ANCHORS, ids=lambda a: a.name)
def test_anchors(spark, anchor):
    rng = random.Random(anchor.name)
    forms = primers.expand(anchor.sequence)
    reads = ["", "A", letters(rng, 8), letters(rng, 20)]
    for i in range(60):
        form = list(rng.choice(forms))
        for _ in range(i % 3):
            form[rng.randrange(len(form))] = rng.choice("ACGTN")
        at = max(0, anchor.start + rng.randrange(-anchor.freedom - 1, anchor.freedom + 2))
        rest = letters(rng, at)
        tail = letters(rng, rng.randrange(0, 40))
        reads.append(tail + "".join(form) + rest[: max(0, at - len(form))] if anchor.reversed else rest + "".join(form) + tail)
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(reads)] + [(-1, None)], "read_id long, seq string")
    for least in (0.9, 0.75):
        found = rows.withColumn("f", primers.find_anchor(F.col("seq"), anchor, least=least))
        got = {r["read_id"]: r for r in found.select("read_id", "f", primers.trim_anchor(F.col("seq"), F.col("f"), anchor.reversed).alias("kept")).collect()}
        want = [slow_anchor(r, anchor, least) for r in reads]
        for i, (read, w) in enumerate(zip(reads, want, strict=True)):
            f = got[i]["f"]
            assert (f and tuple(f)[:3]) == (w and w[:3]) and (not w or f["ratio"] == pytest.approx(w[3])), (read, f, w)
            assert got[i]["kept"] == (read if not w else read[w[1] :] if anchor.reversed else read[: w[2]])
        assert got[-1]["f"] is None and sum(w is not None for w in want) > 10
    exact = {r["read_id"]: r["f"] for r in rows.withColumn("f", primers.find_anchor(F.col("seq"), anchor, fuzzy=False)).collect()}
    for i, read in enumerate(reads):
        w = slow_anchor(read, anchor, 1.1)
        assert (exact[i] and tuple(exact[i])) == w
    good, bad = primers.trim_by_anchor(rows.filter("seq is not null"), anchor)
    assert good.count() + bad.count() == len(reads) and good.count() == sum(slow_anchor(r, anchor) is not None for r in reads)


def test_stops_go_by_the_list_and_then_the_leftmost_place(spark):
    df = spark.createDataFrame([("AAAAAAAAAGTGTCC",), ("AAAAAAAAACAGTAA",), ("AAAAGTAAAAAAAA",), ("AAAAAAAAAAAACAA",), (None,), ("",)], "seq string")
    got = [r[0] for r in df.select(primers.trim_stop(F.col("seq"), ("GT", "CAR"), 8, 13)).collect()]
    assert got == ["AAAAAAAAA", "AAAAAAAAACA", "AAAAGTAAAAAAAA", "AAAAAAAAAAAA", None, ""]


def test_the_chain_keeps_what_stands_before_a_reversed_anchor_too(spark):
    reads = spark.createDataFrame([("r", "l", "TT" + "A" * 60 + "GGCCGG" + "C" * 20)], "read_id string, lane string, seq string")
    samples = spark.createDataFrame([("TT", "l", "s")], "run_key string, lane string, sample string")
    for reversed_ in (False, True):
        p = TrimParams(anchor=primers.Anchor("a", reversed_, 60, 2, 6, "GGCCGG"), run_keys=("TT",), require_distal=False)
        assert trim_reads(reads, samples, primers.PrimerSuite((), ()), "F", p).first()["trimmed"] == "A" * 60 + "GGCCGG"


def test_many_primers_in_one_pass(spark):
    """More degenerate primers than expressions take: the automaton finds what a search word by word finds."""
    rng = random.Random(7)
    degenerate = ["".join(rng.choice(["A", "C", "G", "T", "A", "C", "G", "T", "R", "Y", "[AC]", "N", "A?", "C+"]) for _ in range(rng.randrange(6, 13))) for _ in range(40)]
    pairs = [(s, f"p{k}") for k, d in enumerate(degenerate) for s in primers.expand(d)[:12]] + [("ACG", "short"), ("AC", "shorter")]
    reads = [letters(rng, rng.randrange(0, 90)) for _ in range(80)] + [rng.choice(["", "T"]) + rng.choice(pairs)[0] + letters(rng, 20) + rng.choice(pairs)[0][: rng.randrange(4, 12)] for _ in range(120)] + [""]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(reads)] + [(-1, None)], "read_id long, seq string")
    near, far = primers.trim_proximal(F.col("seq"), pairs), primers.trim_distal(F.col("seq"), pairs)
    got = {r["read_id"]: r for r in rows.select("read_id", near.alias("near"), far.alias("far")).collect()}
    hits = 0
    for i, read in enumerate(reads):
        want = next(((p, n, read.find(p), read[read.find(p) + len(p) :]) for p, n in pairs if read.find(p) in (0, 1)), ("", "", 0, read))
        assert tuple(got[i]["near"]) == want
        tries = ((p[:k], n) for p, n in pairs for k in ([len(p), *range(len(p) - 1, 4, -1)] if len(p) >= 5 else [len(p)]))
        want = next(((p, n, read.rfind(p), read[: read.rfind(p)]) for p, n in tries if p in read), ("", "", -1, read))
        assert tuple(got[i]["far"]) == want
        hits += want[2] >= 0
    assert hits > 60 and got[-1]["near"]["seq"] is None and got[-1]["far"]["at"] == -1


def test_fuzzy_primers(spark):
    rng = random.Random(8)
    own = [("ACGTTGCAAC", "a"), ("GGRTNC", "b"), ("ACGT?TGC", "c"), ("TTTTT", "d")]
    reads = [letters(rng, rng.randrange(0, 60)) for _ in range(150)] + [""]
    x = primers.trim_fuzzy_distal(F.col("seq"), own, most=2)
    got = [r["x"] for r in spark.createDataFrame([(i, r) for i, r in enumerate(reads)], "i int, seq string").withColumn("x", x).orderBy("i").collect()]
    for read, g in zip(reads, got, strict=True):
        best = None
        for k, (pattern, name) in enumerate(own):
            for word in primers.expand(pattern):
                for at in range(len(read) - len(word) + 1):
                    if read[at : at + 2] == word[:2] and (d := levenshtein(read[at : at + len(word)], word)) <= 2:
                        best = max(best or (-d, at, -k, pattern, name), (-d, at, -k, pattern, name))
        assert tuple(g) == ((best[3], best[4], best[1], -best[0], read[: best[1]]) if best else ("", "", -1, None, read))
    assert sum(g["at"] >= 0 for g in got) > 40
