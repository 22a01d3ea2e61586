"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

Sorting every suffix of the corpus isn't needed to find repeats of ``length`` bytes, so two exact steps come first. Each window of
``length`` bytes has an anchor, its k-gram of smallest hash, which the window's bytes alone decide: equal windows have equal
anchors at equal places. Windows in a row with one anchor form a block, whose context (the bytes its windows cover) is hashed.

* A block whose anchor and context occurred earlier repeats as a whole: all its windows do.
* A block whose anchor occurs in one context only has no window in common with any other block.
* The windows left, of first blocks whose anchor has several contexts, go to the suffix sort.

Equal windows share an anchor, so the sort is dealt out by anchor, and each task sorts the suffixes of its anchors' contexts by DC3:
suffixes at places 1 and 2 modulo 3 are sampled, their triples sorted and named, and the string of names is sorted by recursion
until names cover ``length`` bytes; the other suffixes are sorted by their first symbol and the rank of what follows, and merged.
Adjacent suffixes that agree in ``length`` bytes are one string; all but its first window by (doc_id, place) are repeats. An anchor
with more contexts than a task should hold is cut into its windows instead, whose firsts an aggregation finds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._filter import bit_filter, passes
from ._shared import Workspace, text_of

U = np.uint64
K = 24
_PLACE = U((1 << 28) - 1)  # bits for a place in a slice, below those of a hash


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every ``w`` neighbours."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(U).max, U)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def _raw_hash(s: X.Slice) -> np.ndarray:
    sums = np.zeros(len(s.data) + 1, U)
    np.cumsum((s.data.astype(U) + U(1)) * X._power(X._BASE, len(s.data)), out=sums[1:])
    return sums


def blocks(s: X.Slice, length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash, context hash) of every block; places are within the text."""
    none = np.zeros(0, np.int64)
    if len(s.data) > int(_PLACE):
        raise ValueError("a text of more than 256 MB")
    if len(s.data) < length:
        return none, none, none, none.astype(U), none.astype(U)
    with np.errstate(over="ignore"):
        sums, inverse = _raw_hash(s), X._power(X._INVERSE, len(s.data) + 1)
        gram = X.mix((sums[K:] - sums[:-K]) * inverse[: len(s.data) - K + 1])
        at = np.arange(len(gram), dtype=U)
        least = _window_min((gram & ~_PLACE) | at, length - K + 1)
        anchor = (least & _PLACE).astype(np.int64)
        start = np.arange(len(anchor))
        doc = np.repeat(np.arange(len(s)), np.diff(s.offsets))[: len(anchor)]
        inside = start + length <= s.offsets[doc + 1]  # windows that don't leave their text
        start, anchor, doc = start[inside], anchor[inside], doc[inside]
        if not len(start):
            return none, none, none, none.astype(U), none.astype(U)
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        a, b, g, d = start[first], start[last], anchor[first], doc[first]
        size = (b - a + length).astype(U)
        context = (sums[b + length] - sums[a]) * inverse[a]
        context = X.mix(context + size * U(0xD6E8FEB86659FD93) + ((g - a).astype(U) << U(20)))
    return d, a - s.offsets[d], b - s.offsets[d], gram[g], context


def _first_contexts(length: int):
    """Per (anchor, context): its first block in this task and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            parts = []
            for s in X.slices(batch.column("text")):
                d, a, _, anchor, context = blocks(s, length)
                parts.append((anchor, _key(anchor, context), ids[s.first + d], a))
            if not parts:
                continue
            anchor, key, doc, a = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((a, doc, key))  # equal keys have equal anchors
            anchor, key, doc, a = anchor[order], key[order], doc[order], a[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(key)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[first].view(np.int64)), pa.array(key[first].view(np.int64)), pa.array(doc[first], pa.int64()), pa.array(a[first].astype(np.int32)), pa.array(n.astype(np.int32))],
                ["anchor", "key", "doc", "start", "n"],
            )

    return run


def _wanted_blocks(length: int, repeated, several):
    """Blocks that the two filters let pass: key, anchor, doc, start, more (windows after the first) and, for ``several``, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_repeated, in_several = repeated.value, several.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for s in X.slices(batch.column("text")):
                d, a, b, anchor, context = blocks(s, length)
                key = _key(anchor, context)
                many = passes(in_several, anchor)
                at = np.flatnonzero(many | passes(in_repeated, key))
                raw = s.data.tobytes()
                base = s.offsets[d] + a
                own = [raw[x : x + m + length] if f else None for x, m, f in zip(base[at].tolist(), (b - a)[at].tolist(), many[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at].view(np.int64)), pa.array(anchor[at].view(np.int64)), pa.array(ids[s.first + d[at]]), pa.array(a[at].astype(np.int32)), pa.array((b - a)[at].astype(np.int32)), pa.array(own, pa.binary())],
                    ["key", "anchor", "doc", "start", "more", "bytes"],
                )

    return run


def _key(anchor: np.ndarray, context: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return X.mix(anchor * U(0x9FB21C651E98DF25) + context)


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, names): the order of the tuples, and for each, ranks that are equal for equal tuples, from 1."""
    order = np.lexsort(keys[::-1]).astype(np.int32)
    new = np.zeros(len(order), bool)
    for k in keys:
        sorted_ = k[order]
        new[1:] |= sorted_[1:] != sorted_[:-1]
    names = np.empty(len(order), np.int32)
    names[order] = np.cumsum(new, dtype=np.int32) + 1
    return order, names


def suffix_array(text: np.ndarray, depth: int, covered: int = 1) -> np.ndarray:
    """The suffixes of ``text`` (numbers from 1) in order; suffixes that agree in ``depth`` bytes may stand in any order.

    A number of ``text`` stands for ``covered`` bytes.
    """
    n = len(text)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: tuple(text[i:].tolist())), np.int32)
    t = np.zeros(n + 3, np.int32)
    t[:n] = text
    one, two = np.arange(1, n + (n % 3 == 1), 3, np.int32), np.arange(2, n, 3, np.int32)
    sample = np.concatenate([one, two])
    order, names = _dense(t[sample], t[sample + 1], t[sample + 2])
    if names.max() < len(sample) and 3 * covered < depth:
        order = suffix_array(names, depth, 3 * covered)
        names = np.empty(len(sample), np.int32)
        names[order] = np.arange(1, len(sample) + 1, dtype=np.int32)
    rank = np.zeros(n + 3, np.int32)
    rank[sample] = names
    sampled = sample[order]
    sampled = sampled[sampled < n]
    zero = np.arange(0, n, 3, np.int32)
    zero = zero[np.lexsort((rank[zero + 1], t[zero]))]
    wide = np.int64(n + 4)
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    below = np.searchsorted(t[first] * wide + rank[first + 1], t[zero] * wide + rank[zero + 1])
    both = np.concatenate([second, zero])
    pair = np.unique(t[both] * np.int64(t.max() + 1) + t[both + 1], return_inverse=True)[1]
    key = pair * wide + rank[both + 2]
    below += np.searchsorted(key[: len(second)], key[len(second) :])
    out = np.empty(n, np.int32)
    # among suffixes that agree in ``depth`` bytes the sampled ones may be out of order; a running maximum stays among them
    at = np.maximum.accumulate(below) + np.arange(len(zero)) if len(zero) else below
    free = np.ones(n, bool)
    free[at] = False
    out[at], out[free] = zero, sampled
    return out


def _equal_neighbours(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix agrees with the one before it in ``length`` bytes. text is padded by ``length``."""
    word = np.zeros(len(text) - 7, U)
    for k in range(8):
        word |= text[k : len(text) - 7 + k].astype(U) << U(8 * k)
    alive = np.arange(1, len(order))
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for k in steps:
        alive = alive[word[order[alive] + k] == word[order[alive - 1] + k]]
    out = np.zeros(len(order), bool)
    out[alive] = True
    return out


def repeated_windows(docs: np.ndarray, starts: np.ndarray, segments: list[bytes], length: int) -> np.ndarray:
    """(segment, place in it) of each window of the segments that also starts earlier, by (doc, start + place)."""
    sizes = np.array([len(x) for x in segments])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    raw = np.frombuffer(b"\0".join([*segments, bytes(length)]), np.uint8)
    text = raw[: begin[-1]].astype(np.int32) + 2
    text[begin[1:] - 1] = 1
    order = suffix_array(text, length)
    owner = np.repeat(np.arange(len(segments), dtype=np.int32), sizes + 1)
    place = (np.arange(len(text)) - begin[owner]).astype(np.int32)
    window = place <= sizes[owner] - length
    order = order[window[order]]
    same = _equal_neighbours(raw, order, length)
    group = np.cumsum(~same)
    o = owner[order]
    by = np.lexsort((starts[o] + place[order], docs[o], group))
    later = np.concatenate([[False], group[by][1:] == group[by][:-1]]) if len(by) else np.zeros(0, bool)
    # the same place of one document is not earlier than itself
    at = order[by]
    for_first = np.maximum.accumulate(np.where(later, 0, np.arange(len(by)))) if len(by) else np.zeros(0, np.int64)
    f = at[for_first]
    itself = (docs[owner[f]] == docs[owner[at]]) & (starts[owner[f]] + place[f] == starts[owner[at]] + place[at])
    at = at[later & ~itself]
    return np.stack([owner[at], place[at]])


def _sorted_contexts(length: int, most: int):
    """Of contexts that come sorted by anchor: ranges (doc, start, end) of repeated windows."""

    def ranges(held: list[tuple]) -> pa.RecordBatch:
        docs, starts = np.array([r[0] for r in held], np.int64), np.array([r[1] for r in held], np.int64)
        seg, place = repeated_windows(docs, starts, [r[2] for r in held], length)
        order = np.lexsort((place, seg))
        seg, place = seg[order], place[order]
        new = np.concatenate([[True], (seg[1:] != seg[:-1]) | (place[1:] != place[:-1] + 1)]) if len(seg) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(seg)) - 1 if len(first) else first
        s = seg[first]
        return pa.RecordBatch.from_arrays([pa.array(docs[s]), pa.array(starts[s] + place[first]), pa.array(starts[s] + place[last] + length)], ["doc", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None
        for batch in batches:
            for anchor, doc, start, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc", "start", "bytes")), strict=True):
                if anchor != now and size > most:
                    yield ranges(held)
                    held, size = [], 0
                now = anchor
                held.append((doc, start, raw))
                size += len(raw)
        if held:
            yield ranges(held)

    return run


def _cut_to_windows(length: int):
    """Each context as its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, start, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "start", "bytes")), strict=True):
                own = [raw[k : k + length] for k in range(len(raw) - length + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(own), pa.int64()), pa.array(range(start, start + len(own)), pa.int64()), pa.array(own, pa.binary())], ["doc", "start", "bytes"]
                )

    return run


def _cut(keep: bool):
    """Removes the byte ranges of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts, ranges = batch.column("text"), batch.column("ranges")
            for i in range(len(batch)):
                raw = texts[i].as_py().encode()
                kept, end, removed, spans = [], 0, 0, 0
                for x in sorted(ranges[i].as_py() or ()):
                    a, b = x >> 32, min(x & 0xFFFFFFFF, len(raw))
                    if b > end:
                        if a > end or not removed:
                            spans += 1
                            kept.append(raw[end:a])
                        removed += b - max(a, end)
                        end = b
                kept.append(raw[end:])
                rest = b"".join(kept)
                rows.append((len(raw), removed, spans, hashlib.sha256(rest).hexdigest(), rest))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: 4 + keep]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + keep])

    return run


def _free(df: DataFrame) -> None:
    """Lets the engine delete the shuffle files of phases whose results are written: it does so as the driver's garbage goes."""
    import gc

    gc.collect()
    df.sparkSession._jvm.System.gc()


def repeated_ranges(docs: DataFrame, ws: Workspace, length: int = 100, most_contexts: int = 60_000, batch_bytes: int = 1 << 20) -> DataFrame:
    """(doc, start, end): byte ranges whose every byte is in a string of ``length`` bytes that also starts earlier. Ranges overlap.

    ``docs``: doc_id (not null) and text (not null). Of equal contexts the smallest doc_id is kept in view, so no group of copies
    is gathered; what is broadcast are two bitmaps of 256 MB at most.
    """
    counted = ws.save(docs.mapInArrow(_first_contexts(length), "anchor long, key long, doc long, start int, n int"), "counted")
    several = ws.save(
        counted.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("contexts")).filter("low != high").select("anchor", "contexts"),
        "several",
    )
    _free(docs)
    first = F.min(F.struct("doc", "start")).alias("first")
    repeated = ws.save(counted.groupBy("key").agg(first, F.sum("n").alias("n")).filter("n > 1").select("key", "first"), "repeated")
    ws.drop("counted")
    _free(docs)
    filters = bit_filter(repeated.select("key")), bit_filter(several.select("anchor"))
    wanted = docs.mapInArrow(_wanted_blocks(length, *filters), "key long, anchor long, doc long, start int, more int, bytes binary")
    later = F.col("first").isNotNull() & (F.struct("doc", "start") != F.col("first"))
    flagged = ws.save(
        wanted.join(repeated, "key", "left")
        .withColumn("later", later)
        .filter("later or bytes is not null")
        .select("anchor", "doc", F.col("start").cast("long"), (F.col("start") + F.col("more") + length).cast("long").alias("end"), "later", F.when(~F.col("later"), F.col("bytes")).alias("bytes")),
        "flagged",
    )
    ws.drop("repeated")
    _free(docs)
    contexts = flagged.filter("not later").select("anchor", "doc", "start", "bytes").join(several, "anchor")
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    small = contexts.filter(F.col("contexts") <= most_contexts).select("anchor", "doc", "start", "bytes")
    dealt = small.repartition(n, "anchor").sortWithinPartitions("anchor")
    found = dealt.mapInArrow(_sorted_contexts(length, batch_bytes), "doc long, start long, end long")
    # too many contexts for one task: their windows meet by an aggregation, which no group of equal ones can outgrow
    windows = contexts.filter(F.col("contexts") > most_contexts).mapInArrow(_cut_to_windows(length), "doc long, start long, bytes binary")
    firsts = windows.groupBy("bytes").agg(first, F.count("*").alias("n")).filter("n > 1").select("bytes", "first")
    more = windows.join(firsts, "bytes").filter(F.struct("doc", "start") != F.col("first")).select("doc", "start", (F.col("start") + length).alias("end"))
    return ws.save(flagged.filter("later").select("doc", "start", "end").unionByName(found).unionByName(more), "ranges")


def remove_repeats(docs: DataFrame, length: int = 100, keep: bool = True, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``keep``, kept (the bytes left).

    Texts are UTF-8 bytes; a null text is empty. A byte goes if a string of ``length`` bytes over it also starts earlier: in a
    smaller doc_id, or earlier in the same text. Strings are judged on the input, never across texts, and may overlap. n_spans
    counts maximal removed runs. doc_id names a document: rows that repeat one with the same text get the same result. A row
    without a doc_id has no place in the order, is not compared and keeps all its bytes. Of equal strings the first by doc_id and
    place stays. A very long text is read whole, up to 256 MB (beyond it is an error); an empty table gives an empty one; other
    columns are ignored.
    """
    ws = Workspace(docs.sparkSession, "suffix")
    source = docs.select("doc_id", text_of().alias("text"))
    ranges = repeated_ranges(source.filter("doc_id is not null"), ws, length, **options)
    packed = F.shiftleft("start", 32).bitwiseOR(F.col("end"))
    by_doc = ranges.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(packed).alias("ranges"))
    _free(docs)
    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep
    return source.join(by_doc, "doc_id", "left").mapInArrow(_cut(keep), names)
