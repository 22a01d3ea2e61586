"""Language-model scoring by Brown class-based bigrams.

P(text) is the product of P(class | class before) * P(word | class) over its words and its end. Exchange clustering assigns
classes: it moves one unit at a time to the class that most increases the likelihood of the corpus' unit bigrams. First it runs
to its end over the most frequent words and all other words in groups, by the hash of their last two bytes. Then every word
that occurs often enough, however many there are, leaves its group for the class that most increases the likelihood of its own
bigrams, in a distributed step; so do the groups of what is left, which are those of very rare and unseen words only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X
from ._shared import Workspace, text_of

U = np.uint64


@dataclass
class Units:
    """Units 0..h-1: frequent words (sorted hashes); then one for each group of word endings; the last is the end of a text."""

    head: np.ndarray
    endings: int

    def group(self, s: X.Slice, w: X.Words) -> np.ndarray:
        """The unit of each word's group, whether or not the word has one of its own."""
        return len(self.head) + ending(s, w, self.endings)

    @property
    def size(self) -> int:
        return len(self.head) + self.endings + 1

    def of(self, s: X.Slice, w: X.Words) -> np.ndarray:
        unit = self.group(s, w)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, w.hash), len(self.head) - 1)
            unit = np.where(self.head[at] == w.hash, at, unit)
        return unit


def ending(s: X.Slice, w: X.Words, endings: int) -> np.ndarray:
    """The group of each word's last two bytes."""
    if not len(w.end):
        return np.zeros(0, np.int64)
    low = X.LOWER[s.data]
    last = low[w.end - 1].astype(U) << U(8) | np.where(w.end - w.start > 1, low[np.maximum(w.end - 2, 0)], 0).astype(U)
    return (X.mix(last + U(1)) % U(endings)).astype(np.int64)


def bigrams(unit: np.ndarray, doc: np.ndarray, n: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, unit before, unit) of every token; a text begins after an end and closes with one."""
    size = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(size + 1)])
    stream = np.full(first[-1], end, np.int64)
    stream[np.arange(len(unit)) + doc] = unit
    before = np.concatenate([[end], stream[:-1]])  # before a text's first token stands the end of the one before
    return np.repeat(np.arange(n), size + 1), before, stream


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(table: np.ndarray, out_: np.ndarray, in_: np.ndarray, self_: float) -> np.ndarray:
    """What the likelihood gains if a unit joins each class. table: bigrams of classes without the unit.

    out_, in_: the unit's bigrams with each class after and before it, without those with itself, which are self_.
    """
    right, left = table.sum(1) + in_, table.sum(0) + out_  # the other classes' totals grow by these, whichever class is joined
    # the change in sum f(pairs) - sum f(left) - sum f(right) if the unit joins class k; what its bigrams don't touch is unchanged
    o, i = np.flatnonzero(out_), np.flatnonzero(in_)
    rows = (_f(table[:, o] + out_[o]) - _f(table[:, o])).sum(1) + (_f(table[i] + in_[i, None]) - _f(table[i])).sum(0)
    d = np.diagonal(table)
    rows += _f(d + out_ + in_ + self_) - _f(d) - (_f(d + out_) - _f(d)) - (_f(d + in_) - _f(d))
    gain = rows - (_f(right + out_.sum() + self_) - _f(right)) - (_f(left + in_.sum() + self_) - _f(left))
    gain[0] = -np.inf
    return gain


def exchange(counts: np.ndarray, classes: int) -> np.ndarray:
    """The class of each unit. counts[i, j]: how often unit j follows unit i. The last unit keeps class 0 for itself.

    Starts from frequency order dealt over the classes, then moves each unit in turn to the class with the greatest likelihood
    (ties: the smallest class), until a round moves none. Each move adds to the likelihood, by more than its rounding errors.
    """
    n = len(counts)
    classes = max(2, min(classes, n))
    mass = counts.sum(0) + counts.sum(1)
    order = [int(i) for i in np.argsort(-mass, kind="stable") if i != n - 1]
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.arange(len(order)) % (classes - 1)
    one_hot = np.eye(classes)[of]
    table = one_hot.T @ counts @ one_hot
    least = max(1e-9, 1e-12 * float(_f(counts.sum())))
    moved = True
    while moved:
        moved = False
        for w in order:
            if not mass[w]:
                continue
            old, self_ = of[w], counts[w, w]
            out_, in_ = np.bincount(of, counts[w], classes), np.bincount(of, counts[:, w], classes)
            out_[old] -= self_
            in_[old] -= self_
            table[old] -= out_
            table[:, old] -= in_
            table[old, old] -= self_
            gain = gains(table, out_, in_, self_)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + least:
                new = old
            table[new] += out_
            table[:, new] += in_
            table[new, new] += self_
            moved |= new != old
            of[w] = new
    return of


def own_class(table: np.ndarray, old: int, bigrams_: np.ndarray) -> int:
    """The class a unit moves to by its own bigrams, all others staying. table: bigrams of classes with the unit in class ``old``.

    bigrams_: with each class after it, with each before it, and with itself (which the others don't count).
    """
    k = len(table)
    out_, in_, self_ = bigrams_[:k], bigrams_[k : 2 * k], bigrams_[2 * k]
    rest = table.copy()
    rest[old] -= out_
    rest[:, old] -= in_
    rest[old, old] -= self_
    gain = gains(np.maximum(rest, 0), out_, in_, self_)
    new = int(gain.argmax())
    return new if gain[new] > gain[old] + 1e-9 else old


@dataclass
class BrownModel:
    units: Units
    klass: np.ndarray  # of each unit; an ending group's holds for its words without a class of their own
    own: np.ndarray  # the words with a class of their own, sorted hashes, and their classes
    own_klass: np.ndarray
    step: np.ndarray  # log10 P(class | class before)
    base: np.ndarray  # per class: log10 of what divides count + 1
    tokens: int
    types: int
    ends: int
    top: np.ndarray  # the most frequent words' hashes, sorted, and their counts
    top_n: np.ndarray

    def classes_of(self, s: X.Slice, w: X.Words) -> np.ndarray:
        return _classes(self.units, self.klass, self.own, self.own_klass, s, w)


def _classes(units: Units, klass: np.ndarray, own: np.ndarray, own_klass: np.ndarray, s: X.Slice, w: X.Words) -> np.ndarray:
    out = klass[units.of(s, w)]
    if len(own) and len(w.hash):
        at = np.minimum(np.searchsorted(own, w.hash), len(own) - 1)
        out = np.where(own[at] == w.hash, own_klass[at], out)
    return out


def learn(train: DataFrame, ws: Workspace, head: int = 511, endings: int = 256, classes: int = 64, top: int = 1 << 18, enough: int = 20) -> tuple[BrownModel, DataFrame]:
    """The model and the table of all training words (hash, n), which stays distributed.

    The ``head`` most frequent words start as units; each other word that occurs ``enough`` times gets a class of its own after
    them. What reaches the driver: 9 bytes for each word with a class (their number grows with the corpus), the counts of at
    most ``top`` words, the units' totals and bigram counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(h: np.ndarray, e: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(n)], ["h", "ending", "n"])

        def merged(parts: list[tuple]) -> tuple:
            h, e, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            h, at, back = np.unique(h, return_index=True, return_inverse=True)
            return h, e[at], np.bincount(back, n, len(h)).astype(np.int64)

        held: list[tuple] = []
        size = texts = 0
        for batch in batches:
            texts += len(batch)
            for s in X.slices(batch.column("text")):
                w = X.words(s)
                h, at, n = np.unique(w.hash, return_index=True, return_counts=True)
                held.append((h, ending(s, w, endings)[at], n))
                size += len(h)
                if size > 2_000_000:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        yield batch_of(*held[0])
                        held, size = [], 0
        if held:
            last = merged(held)
            for i in range(0, len(last[0]), 200_000):
                yield batch_of(*(x[i : i + 200_000] for x in last))
        if texts:
            yield batch_of(np.zeros(1, U), np.full(1, -1), np.full(1, texts, np.int64))  # ends

    counted = train.mapInArrow(count, "h long, ending int, n long").groupBy("h", "ending").agg(F.sum("n").alias("n"))
    words = ws.save(counted, "words")
    ends = words.filter("ending < 0").agg(F.sum("n")).first()[0] or 0
    words = words.filter("ending >= 0")
    grade = F.floor(F.log2("n") * 8).cast("int")
    grades = sorted(words.groupBy(grade.alias("g")).agg(F.count("*").alias("k")).collect(), key=lambda r: -r["g"])  # a few hundred at most
    room, least = top, None
    for r in grades:
        room -= r["k"]
        if room < 0:
            break
        least = r["g"]
    frequent = words.filter(grade >= least).toPandas() if least is not None else None
    top_h = frequent["h"].to_numpy(np.int64).view(U) if frequent is not None else np.zeros(0, U)
    top_n = frequent["n"].to_numpy(np.int64) if frequent is not None else np.zeros(0, np.int64)
    order = np.argsort(top_h)
    top_h, top_n = top_h[order], top_n[order]
    first = words.orderBy(F.desc("n"), "h").limit(head).select("h").collect()
    units = Units(np.sort(np.array([r["h"] for r in first], np.int64).view(U)), endings)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = units.size
        table = np.zeros(k * k, np.int64)
        for batch in batches:
            for s in X.slices(batch.column("text")):
                w = X.words(s)
                _, a, b = bigrams(units.of(s, w), w.doc, len(s), k - 1)
                table += np.bincount(a * k + b, minlength=k * k)
        cell = np.flatnonzero(table)
        for i in range(0, len(cell), 200_000):
            part = cell[i : i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(table[part])], ["cell", "n"])

    cells = train.mapInArrow(pairs, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # at most units.size squared
    table = np.zeros(units.size**2)
    table[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    table = table.reshape(units.size, units.size)
    klass = exchange(table, classes)
    k = int(klass.max()) + 1
    hot = np.eye(k)[klass]
    middle = words.filter(F.col("n") >= enough)
    if len(units.head):
        middle = middle.filter(~F.col("h").isin([int(x) for x in units.head.view(np.int64)]))
    own = np.sort(middle.select("h").toPandas()["h"].to_numpy(np.int64).view(U))
    moved = _moved(train, middle, units, klass, hot.T @ table @ hot, own, ws)
    rows = moved.filter("ending < 0").select("h", F.col("klass").cast("byte" if k <= 128 else "int")).toPandas()
    order = np.argsort(rows["h"].to_numpy(np.int64).view(U))
    own, own_klass = rows["h"].to_numpy(np.int64).view(U)[order], rows["klass"].to_numpy()[order]
    for r in moved.filter("ending >= 0").collect():  # at most one for each ending
        klass[len(units.head) + r["ending"]] = r["klass"]

    def transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(k * k, np.int64)
        for batch in batches:
            for s in X.slices(batch.column("text")):
                w = X.words(s)
                _, a, b = bigrams(_classes(units, klass, own, own_klass, s, w), w.doc, len(s), 0)
                table += np.bincount(a * k + b, minlength=k * k)
        cell = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(table[cell])], ["cell", "n"])

    cells = train.mapInArrow(transitions, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    step = np.zeros(k * k)
    step[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(float)
    step = step.reshape(k, k) + 0.5
    step = np.log10(step / step.sum(1, keepdims=True))
    # tokens and types of each class, from every word
    by_ending = words.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    n_unit, v_unit = np.zeros(units.size), np.zeros(units.size)
    for r in by_ending:
        n_unit[len(units.head) + r["ending"]] += r["n"]
        v_unit[len(units.head) + r["ending"]] += r["v"]
    if len(units.head):
        head_rows = words.filter(F.col("h").isin([int(x) for x in units.head.view(np.int64)])).collect()
        for r in head_rows:
            n_unit[len(units.head) + r["ending"]] -= r["n"]
            v_unit[len(units.head) + r["ending"]] -= 1
            at = int(np.searchsorted(units.head, np.array([r["h"]], np.int64).view(U)[0]))
            n_unit[at] += r["n"]
            v_unit[at] += 1
    n_class, v_class = np.bincount(klass, n_unit, k), np.bincount(klass, v_unit, k)
    placed = middle.join(moved.filter("ending < 0").select("h", "klass"), "h")
    for r in placed.groupBy("ending", "klass").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # at most endings * classes
        for total, x in ((n_class, r["n"]), (v_class, r["v"])):
            total[klass[len(units.head) + r["ending"]]] -= x
            total[r["klass"]] += x
    base = np.log10(n_class + v_class + 1)
    tokens = int(n_unit.sum()) + int(ends)
    types = int(v_unit.sum()) + (ends > 0)
    return BrownModel(units, klass, own, own_klass, step, base, tokens, types, int(ends), top_h, top_n), words.select("h", "n")


def _moved(train: DataFrame, middle: DataFrame, units: Units, klass: np.ndarray, table: np.ndarray, own: np.ndarray, ws: Workspace) -> DataFrame:
    """(h, ending, klass): the class of each word of ``own`` (ending -1), and of each ending's other words (h is null).

    middle: those words with their ending. A unit's bigrams with the classes about it are summed over the corpus; each unit is
    then judged by itself. What a task reads of one unit has a fixed size.
    """
    k, head = len(table), len(units.head)
    width = 2 * k + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def merged() -> tuple:
            cell = np.concatenate([x for x, _ in held])
            cell, back = np.unique(cell, return_inverse=True)
            return cell, np.bincount(back, np.concatenate([x for _, x in held]), len(cell)).astype(np.int64)

        def made(cell: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            unit, side = cell // width, cell % width
            word = unit < len(own)
            h = own[np.minimum(unit, len(own) - 1)].view(np.int64) if len(own) else np.zeros(len(unit), np.int64)
            end = np.where(word, -1, unit - len(own))
            for i in range(0, len(cell), 200_000):
                j = slice(i, i + 200_000)
                columns = [pa.array(np.where(word, h, 0)[j]), pa.array(end[j].astype(np.int32)), pa.array(side[j].astype(np.int32)), pa.array(n[j])]
                yield pa.RecordBatch.from_arrays(columns, ["h", "ending", "side", "n"])

        for batch in batches:
            for s in X.slices(batch.column("text")):
                w = X.words(s)
                n = len(s)
                unit = units.of(s, w)
                mine = np.full(len(unit), -1)  # a place in own, then the endings
                if len(own) and len(unit):
                    at = np.minimum(np.searchsorted(own, w.hash), len(own) - 1)
                    mine = np.where(own[at] == w.hash, at, mine)
                mine = np.where((mine < 0) & (unit >= head), len(own) + unit - head, mine)
                _, a, b = bigrams(unit, w.doc, n, units.size - 1)
                _, x, y = bigrams(mine, w.doc, n, -1)
                same = (x == y) & (x >= 0)
                after, before = (x >= 0) & ~same, (y >= 0) & ~same
                cells = x[after] * width + klass[b[after]], y[before] * width + k + klass[a[before]], x[same] * width + 2 * k
                held.append(np.unique(np.concatenate(cells), return_counts=True))
                size += len(held[-1][0])
                if size > 3_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_500_000:
                        yield from made(*held[0])
                        held, size = [], 0
        if held:
            yield from made(*merged())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column("old").to_numpy()
            sides, n = batch.column("sides"), batch.column("ns")
            new = np.zeros(len(batch), np.int32)
            for i in range(len(batch)):
                own_bigrams = np.bincount(sides[i].values.to_numpy(), n[i].values.to_numpy(), width)
                new[i] = own_class(table, int(old[i]), own_bigrams)
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("ending"), pa.array(new)], ["h", "ending", "klass"])

    dealt = train.mapInArrow(count, "h long, ending int, side int, n long").repartition("h", "ending")
    sums = dealt.groupBy("h", "ending", "side").agg(F.sum("n").alias("n"))
    units_ = sums.groupBy("h", "ending").agg(F.collect_list("side").alias("sides"), F.collect_list("n").alias("ns"))
    old_of = F.array([F.lit(int(c)) for c in klass[head : head + units.endings]])
    groups = middle.select("h", F.lit(-1).alias("ending"), F.col("ending").alias("group"))
    units_ = units_.join(groups, ["h", "ending"], "left").withColumn("old", F.get(old_of, F.coalesce("group", "ending")))
    return ws.save(units_.select("h", "ending", "old", "sides", "ns").mapInArrow(assign, "h long, ending int, klass int"), "classes")


def score(docs: DataFrame, model: BrownModel, words: DataFrame, ws: Workspace) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score for each row; other columns but text are carried along.

    Counts of the most frequent words are at hand in every task; the others are looked up by a join with all words.
    """
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for s in X.slices(batch.column("text")):
                n = len(s)
                w = X.words(s)
                doc, a, b = bigrams(model.classes_of(s, w), w.doc, n, 0)
                emit = np.where(b == 0, 0.0, -model.base[b])
                classed = np.bincount(doc, model.step[a, b] + emit, n)
                if len(model.top):
                    at = np.minimum(np.searchsorted(model.top, w.hash), len(model.top) - 1)
                    seen = model.top[at] == w.hash
                    logs = np.bincount(w.doc[seen], np.log10(model.top_n[at[seen]] + 1.0), n)
                else:
                    seen, logs = np.zeros(len(w.hash), bool), np.zeros(n)
                known = np.bincount(w.doc[seen], minlength=n)
                rest = ~seen
                first = np.concatenate([[0], np.cumsum(np.bincount(w.doc[rest], minlength=n))])
                tail = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(w.hash[rest].view(np.int64)))
                parts.append((np.bincount(doc, minlength=n), known, logs, classed, tail))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))
            made = [pa.concat_arrays([p[i] if i == 4 else pa.array(p[i], kinds[i]) for p in parts]) if parts else pa.array([], kinds[i]) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *made], [*others, "n_", "known_", "logs_", "classed_", "tail_"])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", n_ long, known_ long, logs_ double, classed_ double, tail_ array<long>"
    rows = ws.save(docs.mapInArrow(run, schema).withColumn("row_", F.monotonically_increasing_id()), "rows")
    tail = rows.select("row_", F.explode("tail_").alias("h"))
    looked = (
        tail.join(words, "h")
        .groupBy("row_")
        .agg(F.sum(F.log10(F.col("n") + 1)).alias("more_"), F.count("*").alias("found_"))
    )
    logs = F.col("logs_") + F.coalesce("more_", F.lit(0.0))
    whole = float(np.log10(model.tokens + model.types + 1))
    end_log = float(np.log10(model.ends + 1))
    return rows.drop("tail_").join(looked, "row_", "left").select(
        *others,
        F.col("n_").alias("n_tokens"),
        (F.col("known_") + F.coalesce("found_", F.lit(0)) + int(model.ends > 0)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs + end_log - F.col("n_") * whole).alias("base_score"),
        (F.col("classed_") + logs).alias("score"),
    )


def score_corpus(docs: DataFrame, train: DataFrame, **options) -> DataFrame:
    """Scores ``docs`` by a model of ``train`` (both with doc_id and text). A null text is empty: one token, its end.

    Words: A-Z lower-cased runs without [\\x20\\x09-\\x0D], told apart by 64-bit hashes. base_score: add-one unigrams.
    Rows that repeat are each scored, and each learned from. With no training text every word is unseen and the model is uniform
    over endings. A very long text is scored whole, an empty table gives an empty one, and other columns are ignored. Of words
    of equal count the smaller hash is in the head; a move between classes that gain alike goes to the smaller class.
    """
    ws = Workspace(docs.sparkSession, "brown")
    model, words = learn(train.select(text_of().alias("text")), ws, **options)
    return score(docs.select("doc_id", text_of().alias("text")), model, words, ws)
