"""Degenerate primers, anchors, and trimming by them."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import sequence as S
from . import patterns

# What degenerate letters stand for.
DEGENERATE = {"N": "ACGT", ".": "ACGT", "R": "AG", "Y": "CT", "W": "AT", "S": "CG", "M": "AC", "K": "GT"}
_ITEM = re.compile(r"(\[[^\]]+\]|.)(\?|\+|\*|\{(\d),(\d)\})?")
_REPEATS = {"": (1, 1), "?": (0, 1), "+": (1, 2), "*": (0, 2)}


def class_forms(pattern: str) -> list[tuple[str, ...]]:
    """A pattern as rows of letter sets, one for each way its repeats can go."""
    choices = []
    for item, times, least, most in _ITEM.findall(pattern):
        letters = item[1:-1].replace(",", "") if item[0] == "[" else DEGENERATE.get(item, item)
        low, high = (int(least), int(most)) if least else _REPEATS[times]
        choices.append([(letters,) * k for k in range(low, high + 1)])
    return list(dict.fromkeys(sum(p, ()) for p in product(*choices)))


def expand(pattern: str) -> list[str]:
    """All plain sequences of a pattern: degenerate letters, groups like [AC] or [A,C], and ? + * {m,n}; sorted, without repeats."""
    return sorted({"".join(p) for form in class_forms(pattern) for p in product(*form)})


def reverse_complement(seq: str) -> str:
    return seq[::-1].translate(str.maketrans(S.BASES, S.COMPLEMENTS))


@dataclass(frozen=True)
class Primer:
    name: str
    domain: str
    region: str
    direction: str
    sequence: str


def load_primers(path: str) -> dict[str, list[Primer]]:
    """suite -> primers, of a JSON file {suite: {name: {domain, region, direction, sequence}}}."""
    with open(path) as f:
        raw = json.load(f)
    return {suite: [Primer(n, p["domain"], p["region"], p["direction"].upper(), p["sequence"]) for n, p in own.items()] for suite, own in raw.items()}


@dataclass(frozen=True)
class Anchor:
    name: str
    reversed: bool
    start: int
    freedom: int
    length: int
    sequence: str


def load_anchors(path: str) -> dict[str, Anchor]:
    with open(path) as f:
        raw = json.load(f)
    return {n: Anchor(n, str(a["reversed"]).lower() == "true", int(a["start"]), int(a["freedom"]), int(a["length"]), a["sequence"]) for n, a in raw.items()}


@dataclass(frozen=True)
class PrimerSuite:
    """What a sample's reads are searched for: (sequence, primer name), in list order."""

    proximal: tuple[tuple[str, str], ...]
    distal: tuple[tuple[str, str], ...]

    @classmethod
    def build(cls, primers: list[Primer], direction: str, domain: str = "", region: str = "", proximal: tuple = (), distal: tuple = ()) -> PrimerSuite:
        """Direction F: forward primers near, reverse ones far; R: both as reverse complements the other way round; B: both.

        domain and region keep the primers of that kind (a domain may carry the suffix l); own sequences come after.
        """
        fits = [p for p in primers if (not domain or p.domain in (domain, domain + "l", domain.removesuffix("l"))) and (not region or p.region == region)]
        f = [(s, p.name) for p in fits if p.direction == "F" for s in expand(p.sequence)]
        r = [(s, p.name) for p in fits if p.direction == "R" for s in expand(p.sequence)]
        f_rc, r_rc = ([(reverse_complement(s), n) for s, n in x] for x in (f, r))
        near = {"F": f, "R": r_rc, "B": f + r_rc}[direction]
        far = {"F": r, "R": f_rc, "B": r + f_rc}[direction]
        own = [[(s, "custom") for c in x for s in expand(c)] for x in (proximal, distal)]
        return cls((*near, *own[0]), (*far, *own[1]))


def _literals(pairs) -> Column:
    return F.array(*[F.struct(F.lit(s).alias("seq"), F.lit(n).alias("name")) for s, n in pairs])


def _once(value: Column, f) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


#: Up to so many words are looked for by expressions, more of them by an automaton; what is found is the same.
_FEW = 64


def _by_automaton(words: list[tuple[str, str]], found, cut) -> object:
    """A function of reads: struct(primer, name, at, seq) of the word that ``found`` names, and what ``cut`` leaves."""

    @F.arrow_udf("primer string, name string, at int, seq string")
    def run(reads: pa.Array) -> pa.Array:
        automaton = patterns.Words([w for w, _ in words])
        rows = []
        for read in reads.to_pylist():
            hit = None if read is None else found(automaton, read)
            rows.append((*words[hit[0]], hit[1], cut(read, words[hit[0]][0], hit[1])) if hit else None if read is None else ("", "", None, read))
        fields = [("primer", pa.string()), ("name", pa.string()), ("at", pa.int32()), ("seq", pa.string())]
        return pa.StructArray.from_arrays([pa.array([r and r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])

    return run


def trim_proximal(seq: Column, primers) -> Column:
    """struct(primer, name, at, seq): the first primer, in list order, whose first occurrence is at 0 or 1, and what follows it."""
    if not primers:
        return F.struct(F.lit("").alias("primer"), F.lit("").alias("name"), F.lit(0).alias("at"), seq.alias("seq"))
    if len(primers) > _FEW:
        found = _by_automaton(list(primers), lambda a, read: a.near(read), lambda read, word, at: read[at + len(word) :])(seq)
        return _once(found, lambda x: F.struct(*[F.coalesce(x[c], F.lit(v)).alias(c) for c, v in (("primer", ""), ("name", ""), ("at", 0))], x["seq"].alias("seq")))
    found = F.get(F.filter(_literals(primers), lambda p: F.position(p["seq"], seq).isin(1, 2)), 0)

    def out(p: Column) -> Column:
        at = F.position(p["seq"], seq) - 1
        return F.struct(
            F.coalesce(p["seq"], F.lit("")).alias("primer"),
            F.coalesce(p["name"], F.lit("")).alias("name"),
            F.coalesce(at, F.lit(0)).alias("at"),
            F.coalesce(F.substring(seq, at + F.length(p["seq"]) + 1, F.length(seq)), seq).alias("seq"),
        )

    return _once(found, out)


def trim_distal(seq: Column, primers, least: int = 5) -> Column:
    """struct(primer, name, at, seq): what stands before a far primer.

    Per primer in list order: its last whole occurrence, else that of its longest prefix of ``least`` bases or more. The first
    primer found that way wins. at is -1 and seq unchanged if none is.
    """
    tries = [(s[:k], n) for s, n in primers for k in ([len(s), *range(len(s) - 1, least - 1, -1)] if len(s) >= least else [len(s)])]
    if not tries:
        return F.struct(F.lit("").alias("primer"), F.lit("").alias("name"), F.lit(-1).alias("at"), seq.alias("seq"))
    if len(tries) > _FEW:
        found = _by_automaton(tries, lambda a, read: a.last(read), lambda read, word, at: read[:at])(seq)
        return _once(found, lambda x: F.struct(*[F.coalesce(x[c], F.lit(v)).alias(c) for c, v in (("primer", ""), ("name", ""), ("at", -1))], x["seq"].alias("seq")))
    found = F.get(F.filter(_literals(tries), lambda p: F.contains(seq, p["seq"])), 0)

    def out(p: Column) -> Column:
        at = S.last_position(seq, p["seq"])
        return F.struct(
            F.coalesce(p["seq"], F.lit("")).alias("primer"),
            F.coalesce(p["name"], F.lit("")).alias("name"),
            F.coalesce(F.when(p.isNotNull(), at), F.lit(-1)).alias("at"),
            F.when(p.isNotNull(), F.substring(seq, F.lit(1), at)).otherwise(seq).alias("seq"),
        )

    return _once(found, out)


def trim_fuzzy_distal(seq: Column, primers, most: int = 3, exact: int = 2) -> Column:
    """struct(primer, name, at, edits, seq): what stands before the nearest match of a far primer, which may be degenerate.

    Windows of a primer's length that begin with its first ``exact`` bases and are at most ``most`` edits away; the fewest edits
    win, then the last place, then the earlier primer. at is -1 and seq unchanged if there is none. Primers of up to 64 bases.
    """
    forms = [(k, form) for k, (pattern, _) in enumerate(primers) for form in class_forms(pattern)]

    @F.arrow_udf("primer string, name string, at int, edits int, seq string")
    def near(reads: pa.Array) -> pa.Array:
        number, place, d = (np.zeros(len(reads), np.int64) for _ in range(3))
        for first, data, offsets in patterns.batches(reads):
            own = slice(first, first + len(offsets) - 1)
            number[own], place[own], d[own] = patterns.nearest(data, offsets, forms, most, exact)
        found = number >= 0
        words = [pa.array([primers[k][i] if k >= 0 else "" for k in number.tolist()], pa.string()) for i in (0, 1)]
        kept = pa.array([None if r is None else r[:p] if f else r for r, p, f in zip(reads.to_pylist(), place.tolist(), found.tolist(), strict=True)], pa.string())
        at, d = pa.array(np.where(found, place, -1).astype(np.int32)), pa.array(d.astype(np.int32), mask=~found)
        return pa.StructArray.from_arrays([*words, at, d, kept], ["primer", "name", "at", "edits", "seq"])

    return near(F.coalesce(seq, F.lit("")))


def anchor_windows(anchor: Anchor) -> list[tuple[int, int]]:
    """(start, end) at the expected place, then one further, one nearer, and so on. A reversed anchor's count back from the read's end."""
    starts = [anchor.start, *(anchor.start + d for k in range(1, anchor.freedom + 1) for d in (k, -k))]
    return [(-s, -(s - anchor.length)) if anchor.reversed else (s, s + anchor.length) for s in starts]


def _slice_at(place: Column, size: Column) -> Column:
    """A place as slices take it: from the end where it is negative, within the read."""
    return F.when(place < 0, F.greatest(size + place, F.lit(0))).otherwise(F.least(place, size))


def find_anchor(seq: Column, anchor: Anchor, fuzzy: bool = True, least: float = 0.9, stops: tuple[str, ...] = ()) -> Column:
    """struct(sequence, start, end, ratio) of the best window, null if none is near enough.

    A perfect window of the first sequence that has one wins; else the greatest ratio from ``least`` on, of sequences the
    earlier one, of a sequence the later window. Of a window that runs out of the read what is there is compared; a negative
    place counts from the read's end, as in slices. Perfect windows alone (not ``fuzzy``) are found by expressions.
    """
    forms = list(dict.fromkeys([*expand(anchor.sequence), *(s for x in stops for s in expand(x))]))
    windows = anchor_windows(anchor)
    if not fuzzy:
        places = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(windows)])
        known = F.array(*map(F.lit, forms))

        def best(read: Column) -> Column:
            size = F.length(read)

            def window(w: Column) -> Column:
                first = _slice_at(w["a"], size)
                part = F.substring(read, first + 1, F.greatest(_slice_at(w["b"], size) - first, F.lit(0)))
                return F.struct(F.array_position(known, part).alias("form"), w["k"].alias("k"), w["a"].alias("a"), w["b"].alias("b"))

            return F.array_min(F.filter(F.transform(places, window), lambda x: x["form"] > 0))

        def told(x: Column) -> Column:
            row = F.struct(F.element_at(known, x["form"].cast("int")).alias("sequence"), x["a"].alias("start"), x["b"].alias("end"), F.lit(1.0).alias("ratio"))
            return F.when(x.isNotNull(), row)

        return _once(_once(seq, best), told)
    classes = [*class_forms(anchor.sequence), *(f for x in stops for f in class_forms(x))]

    @F.arrow_udf("sequence string, start int, end int, ratio double")
    def found(reads: pa.Array) -> pa.Array:
        rows: list = [None] * len(reads)
        for first, data, offsets in patterns.batches(reads, 1 << 18):
            for own, best in _best_windows(data, offsets, windows, classes, forms, least):
                rows[first + own] = best
        kind = pa.struct([("sequence", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("ratio", pa.float64())])
        told = [None if row is None or not known else row for row, known in zip(rows, reads.is_valid().to_pylist(), strict=True)]
        return pa.array([x and dict(zip(("sequence", "start", "end", "ratio"), x, strict=True)) for x in told], kind)

    return found(seq)


def _best_windows(data: np.ndarray, offsets: np.ndarray, windows: list[tuple[int, int]], classes: list[tuple[str, ...]], forms: list[str], least: float):
    """(read, (sequence, start, end, ratio)) of the reads with a window that is near enough."""
    reads, size = len(offsets) - 1, np.diff(offsets)[:, None]
    a, b = (np.array([w[i] for w in windows])[None, :] for i in (0, 1))
    first, end = (np.where(x < 0, np.maximum(size + x, 0), np.minimum(x, size)) for x in (a, b))
    length = np.maximum(end - first, 0)
    letters = np.arange(int(length.max(initial=1)))
    padded = np.append(data, 0)
    step = max(1, patterns._MOST // max(1, len(windows) * len(letters)))
    for low in range(0, reads, step):
        own = slice(low, min(reads, low + step))
        held = letters < length[own][:, :, None]
        text = np.where(held, padded[np.where(held, (offsets[:-1][own, None] + first[own])[:, :, None] + letters, len(data))], 0)
        flat, size_of = text.reshape(-1, len(letters)), length[own].ravel()
        ratio = np.zeros(len(flat))
        for form in classes:
            ratio = np.maximum(ratio, 2 * patterns.common(flat, form) / np.maximum(size_of + len(form), 1))
        ratio = ratio.reshape(-1, len(windows))
        top = ratio.max(1)
        near = np.flatnonzero(top >= least)
        row, w = np.nonzero(ratio[near] == top[near][:, None])
        row = near[row]
        if not len(row):
            continue
        # which plain sequence it is: only for the windows that have a read's best ratio
        text, size_of = text[row, w], length[own][row, w]
        which = np.full(len(row), len(forms))
        for k in reversed(range(len(forms))):
            hit = 2 * patterns.common(text, forms[k]) / np.maximum(size_of + len(forms[k]), 1) == top[row]
            which[hit] = k
        perfect = top[row] == 1
        start = np.array([x[0] for x in windows])[w]
        order = np.lexsort((np.where(perfect, w, -start), which, row))
        row, w, which = row[order], w[order], which[order]
        lead = np.concatenate([[True], row[1:] != row[:-1]])
        for r, x, k in zip(row[lead].tolist(), w[lead].tolist(), which[lead].tolist(), strict=True):
            yield low + r, (forms[k], *windows[x], float(top[r]))


def trim_anchor(seq: Column, found: Column, reversed_: bool) -> Column:
    """Up to and with the anchor; of a reversed one, from it on. Unchanged without an anchor."""
    size = F.length(seq)
    cut = F.substring(seq, _slice_at(found["start"], size) + 1, size) if reversed_ else F.substring(seq, F.lit(1), _slice_at(found["end"], size))
    return F.when(found.isNotNull(), cut).otherwise(seq)


def trim_stop(seq: Column, stops: tuple[str, ...], start: int, end: int) -> Column:
    """What stands before a stop sequence: the first stop in list order that begins at ``start`` or later and before ``end``, at its
    first such place. Stops may be degenerate: one stands wherever one of its plain sequences does."""

    def place(stop: str) -> Column:
        places = [F.locate(w, seq, start + 1) for w in expand(stop)]
        return F.array_min(F.array(*[F.when(p.between(start + 1, end), p - 1) for p in places]))

    found = F.coalesce(*map(place, stops))
    return F.when(found.isNotNull(), F.substring(seq, F.lit(1), found)).otherwise(seq)


def strip_inline(seq: Column, run_key: str, primer_regex: str) -> Column:
    """Without the run key and the primer (a regular expression) at its start."""
    return F.regexp_replace(seq, f"^{re.escape(run_key)}{primer_regex}", "")


def primer_regex(pattern: str) -> str:
    """A degenerate primer as a regular expression."""
    out = ""
    for item, times, least, most in _ITEM.findall(pattern):
        letters = item[1:-1].replace(",", "") if item[0] == "[" else DEGENERATE.get(item, item)
        low, high = (int(least), int(most)) if least else _REPEATS[times]
        out += (f"[{letters}]" if len(letters) > 1 else letters) + ("" if (low, high) == (1, 1) else f"{{{low},{high}}}")
    return out


def trim_by_anchor(reads, anchor: Anchor, least: float = 0.9):
    """(trimmed, failed): reads cut at the anchor, and those in which it isn't found."""
    found = reads.withColumn("found_", find_anchor(F.col("seq"), anchor, least=least))
    trimmed = found.filter("found_ is not null").withColumn("seq", trim_anchor(F.col("seq"), F.col("found_"), anchor.reversed))
    return trimmed.drop("found_"), found.filter("found_ is null").drop("found_")
