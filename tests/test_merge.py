"""Merged pairs against a plain search of all overlaps."""

from __future__ import annotations

import random

import numpy as np

from seqloom.operators import merge
from seqloom.plans import registry

SF = "/root/testdata/sf0.001"
TURN = str.maketrans("ACGTN", "TGCAN")


def plain(first, mate, qual, mate_qual, least=15, most=None, only=False, by_quality=True):
    """(overlap, mismatches, merged, merged_qual)."""
    if first is None or mate is None:
        return (None,) * 4
    b = np.frombuffer(mate[::-1].translate(TURN).encode(), np.uint8)
    a = np.frombuffer(first.encode(), np.uint8)
    scored = qual is not None and mate_qual is not None and (len(qual), len(mate_qual)) == (len(a), len(b))
    p = np.frombuffer(qual.encode(), np.uint8).astype(int) - 33 if scored else np.ones(len(a), int)
    q = np.frombuffer(mate_qual[::-1].encode(), np.uint8).astype(int) - 33 if scored else np.ones(len(b), int)
    best = None
    for k in range(least, min(len(a), len(b)) + 1):
        differ = a[len(a) - k :] != b[:k]
        d = int(differ.sum())
        if d * 10 > k or most is not None and d > most:
            continue
        w = p[len(p) - k :] * q[:k] if by_quality else np.ones(k, int)
        share = (w * differ).sum() / w.sum() if w.sum() else d / k
        if best is None or (share, -k) < best[:2]:
            best = (share, -k, d)
    if best is None:
        return (None,) * 4
    k, d = -best[1], best[2]
    x, y, s, t = a[len(a) - k :], b[:k], p[len(p) - k :], q[:k]
    middle = np.where(t > s, y, x) if scored else x
    whole = middle if only else np.concatenate([a[: len(a) - k], middle, b[k:]])
    scores = np.maximum(s, t) if only else np.concatenate([p[: len(p) - k], np.maximum(s, t), q[k:]])
    return k, d, bytes(whole.astype(np.uint8)).decode(), bytes((scores + 33).astype(np.uint8)).decode() if scored else None


def test_every_overlap_is_judged(spark):
    rng = random.Random(5)
    rows = [(None, "ACGT" * 9, "I" * 5, "I"), ("", "", "", ""), ("ACGT" * 9, "A" * 14, None, None), ("A" * 40, "T" * 30, "I" * 40, "#" * 30), ("ACGTTGCA" * 4, "TGCAACGT" * 4, "I" * 3, None)]
    for n in [20, 33, 64, 150, 151, 700] * 6:
        whole = "".join(rng.choices("ACGTN", (9, 9, 9, 9, 1), k=n))
        left, right = whole[: n * 2 // 3], list(whole[n // 3 :])
        for i in range(len(right)):
            if rng.random() < 0.04:
                right[i] = rng.choice("ACGT")
        mate = "".join(right)[::-1].translate(TURN)
        rows.append((left, mate, "".join(rng.choices("!#5?I", k=len(left))), "".join(rng.choices("!#5?I", k=len(mate)))))
    rows.append(("ACG" * 30, ("ACG" * 30)[::-1].translate(TURN), "!" * 90, "!" * 90))  # no weight anywhere: places count alike
    pairs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, seq string, mate_seq string, qual string, mate_qual string")
    for options in ({}, {"by_quality": False}, {"least": 10, "most": 1, "only": True}):
        names = {"least": "min_overlap", "most": "max_mismatches", "only": "only_overlap"}
        got = {r["i"]: (r["overlap"], r["mismatches"], r["merged"], r["merged_qual"]) for r in merge.merge_reads(pairs, **{names.get(k, k): v for k, v in options.items()}).collect()}
        assert got == {i: plain(*r, **options) for i, r in enumerate(rows)}
    bare = merge.merge_reads(pairs.select("i", "seq", "mate_seq")).collect()
    assert [(r["overlap"], r["merged"], r["merged_qual"]) for r in sorted(bare, key=lambda r: r["i"])] == [plain(a, b, None, None)[:1] + plain(a, b, None, None)[2:] for a, b, _, _ in rows]
    assert merge.merge_reads(pairs.filter("false")).count() == 0


def test_whole_reads(spark):
    pairs = registry.read_pairs(spark, SF)
    found = {r["read_id"]: r for r in merge.merge_reads(pairs).collect()}
    rows = pairs.collect()
    assert len(found) == len(rows) and max(len(r["seq"]) for r in rows) > 1500
    for r in rows:
        if len(r["seq"]) <= 8000:  # the plain version takes the square of it
            f = found[r["read_id"]]
            assert (f["overlap"], f["mismatches"], f["merged"], f["merged_qual"]) == plain(r["seq"], r["mate_seq"], r["qual"], r["mate_qual"])
