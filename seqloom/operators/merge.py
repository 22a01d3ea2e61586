"""Merging of overlapping mates: every overlap of a pair is judged, by correlation, so the work is near-linear in a read's length.

How many letters agree at each shift of two sequences is the sum, over letters, of the correlation of the places that hold them. The fast
Fourier transform gives all shifts of a whole batch of pairs at once; counts are whole numbers, so rounding makes them exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S

#: Cells of one batch of transforms; a longer pair is taken alone.
_MOST = 1 << 20
_RESULT = "overlap int, mismatches int, merged string, merged_qual string"


def _correlated(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """For each row and shift s the sum of a[s + j] * b[j]."""
    return np.fft.irfft(np.fft.rfft(a, size) * np.conj(np.fft.rfft(b, size)), size)


def _padded(texts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)


def _best(firsts: list[bytes], mates: list[bytes], weights: tuple[list[bytes], list[bytes]] | None, least: int, most: int | None, offset: int) -> list[tuple[int, int]]:
    """(overlap, mismatches) of each pair, (0, 0) without one."""
    n, m = (np.array([len(t) for t in side]) for side in (firsts, mates))
    width = int(max(n.max(), m.max()))
    size = 1 << int(2 * width - 1).bit_length()
    a, b = _padded(firsts, width), _padded(mates, width)
    letters = [c for c in np.union1d(np.unique(a), np.unique(b)) if c]
    same = np.rint(sum(_correlated((a == c).astype(float), (b == c).astype(float), size) for c in letters))[:, :width]
    if weights:
        u, v = (np.where(x > 0, np.maximum(_padded(side, width).astype(float) - offset, 0), 0) for x, side in zip((a, b), weights, strict=True))
        whole = np.rint(_correlated(u, v, size))[:, :width]
        agreed = np.rint(sum(_correlated(u * (a == c), v * (b == c), size) for c in letters))[:, :width]
    out = []
    for i in range(len(n)):
        k = np.arange(least, min(n[i], m[i]) + 1)
        d = (k - same[i, n[i] - k]).astype(np.int64)
        fits = (d * 10 <= k) if most is None else (d * 10 <= k) & (d <= most)
        k, d = k[fits], d[fits]
        if not len(k):
            out.append((0, 0))
            continue
        share = d / k
        if weights:
            w = whole[i, n[i] - k]
            share = np.where(w > 0, (w - agreed[i, n[i] - k]) / np.maximum(w, 1), share)
        at = np.lexsort((-k, share))[0]
        out.append((int(k[at]), int(d[at])))
    return out


def _joined(a: bytes, b: bytes, k: int, p: bytes | None, q: bytes | None, only_overlap: bool) -> tuple[bytes, bytes | None]:
    """The merged sequence and its qualities. The better base of two wins, the first read's of equal ones."""
    head, middle, tail = a[: len(a) - k], a[len(a) - k :], b[k:]
    if p is None or q is None:
        return (middle if only_overlap else head + middle + tail), None
    x, y, s, t = (np.frombuffer(v, np.uint8) for v in (middle, b[:k], p[len(p) - k :], q[:k]))
    middle, scores = np.where(t > s, y, x).tobytes(), np.maximum(s, t).tobytes()
    return (middle, scores) if only_overlap else (head + middle + tail, p[: len(p) - k] + scores + q[k:])


def _merge(least: int, most: int | None, only_overlap: bool, by_quality: bool, offset: int):
    @F.arrow_udf(_RESULT)
    def merge(first: pa.Array, mate: pa.Array, qual: pa.Array, mate_qual: pa.Array) -> pa.Array:
        columns = [[None if v is None else v.encode("latin-1") for v in x.to_pylist()] for x in (first, mate, qual, mate_qual)]
        rows = list(zip(*columns, strict=True))
        out: list[dict | None] = [dict.fromkeys(("overlap", "mismatches", "merged", "merged_qual"))] * len(rows)
        able = [i for i, (a, b, p, q) in enumerate(rows) if a and b and min(len(a), len(b)) >= max(least, 1)]
        able.sort(key=lambda i: max(len(rows[i][0]), len(rows[i][1])))
        at = 0
        while at < len(able):
            end = at + 1
            while end < len(able) and (end - at + 1) * 4 * max(map(len, rows[able[end]][:2])) <= _MOST:
                end += 1
            part = [rows[i] for i in able[at:end]]
            scored = [p is not None and q is not None and (len(p), len(q)) == (len(a), len(b)) for a, b, p, q in part]
            weights = None
            if by_quality:  # a pair without qualities of its length counts every place alike
                weights = [x[2] if s else bytes([offset + 1]) * len(x[0]) for x, s in zip(part, scored, strict=True)], [x[3] if s else bytes([offset + 1]) * len(x[1]) for x, s in zip(part, scored, strict=True)]
            found = _best([x[0] for x in part], [x[1] for x in part], weights, max(least, 1), most, offset)
            for i, (a, b, p, q), s, (k, d) in zip(able[at:end], part, scored, found, strict=True):
                if k:
                    seq, scores = _joined(a, b, k, p if s else None, q if s else None, only_overlap)
                    out[i] = {"overlap": k, "mismatches": d, "merged": seq.decode("latin-1"), "merged_qual": None if scores is None else scores.decode("latin-1")}
            at = end
        kind = pa.struct([("overlap", pa.int32()), ("mismatches", pa.int32()), ("merged", pa.string()), ("merged_qual", pa.string())])
        return pa.array(out, kind)

    return merge


def merge_reads(
    pairs: DataFrame, min_overlap: int = 15, max_mismatches: int | None = None, only_overlap: bool = False, by_quality: bool = True, offset: int = 33
) -> DataFrame:
    """Merges first reads with the reverse complement of their mates: adds overlap, mismatches, merged and merged_qual, null without one.

    pairs: seq, mate_seq and, optionally, qual, mate_qual. Of overlaps of ``min_overlap`` or more in which one place in ten may differ
    (and ``max_mismatches`` at most) the one with the smallest share of differences wins, then the longest. ``by_quality`` weighs a
    place by the product of both scores, so doubtful bases count little. Where mates differ the base of higher score stands, the
    first read's if they are equal; a place's score is the greater one. Without qualities, or where their length isn't the
    sequence's, every place counts alike, the first read's base stands and merged_qual is null. ``only_overlap`` keeps nothing else.
    """
    none = F.lit(None).cast("string")
    own: list[Column] = [F.col("qual"), F.reverse("mate_qual")] if {"qual", "mate_qual"} <= set(pairs.columns) else [none, none]
    udf = _merge(min_overlap, max_mismatches, only_overlap, by_quality, offset)
    found = pairs.withColumn("merge_", udf(F.col("seq"), S.revcomp(F.col("mate_seq")), *own))
    return found.select(*pairs.columns, "merge_.overlap", "merge_.mismatches", "merge_.merged", "merge_.merged_qual")
