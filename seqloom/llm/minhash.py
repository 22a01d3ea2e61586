"""MinHash near-dedup: fast similarity sketches, banding, and verification on full shingle sets.

The sketch (Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching", FOCS 2017) throws every element into one of ``t`` bins
in each of up to ``t`` rounds and keeps, per bin, the smallest (round, value); ``t`` further rounds throw everything into one
bin each, so every coordinate fills. Two sets agree in a coordinate with the probability of their Jaccard similarity, and the
share of equal coordinates is concentrated about it.

Texts with equal shingle sets form a class, of which one member goes on. A bucket holds the classes that share a band of
coordinates. Its pairs are not expanded:

* Each bucket has a centre, the class that shares most with others, and every class is compared with the centres of its buckets
  on full sets. That links most, and tells of each class what it lacks of its centre and what it has besides.
* Two classes that met one centre have in common, at most, what both have of the centre and the lesser of their additions. Both
  numbers are bounded, first by counts and then by bitmaps that the comparison leaves behind, so a pair below the threshold is
  refused without its sets, and none at the threshold ever is.
* Two rounds compare a few unconnected classes about each centre with the others about it, verify what the bound lets pass on
  full sets, and contract what is linked. A centre goes on only while not all about it are known to be connected. As buckets
  with one centre are one group, a pair is met once, not in every band that it shares.
* Of what is open then, only classes meet whose differences from the centre have one of their rarest elements in common, as
  those of every linked pair do. So a group that shares a phrase and nothing else isn't compared pair by pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _text as X
from ._filter import bit_filter, passes
from ._graph import components
from ._shared import Workspace, one_of_each, text_of

U = np.uint64


class Sketcher:
    """Fast similarity sketches of ``t`` coordinates."""

    def __init__(self, t: int):
        self.t = t
        with np.errstate(over="ignore"):
            self.seeds = X.mix(np.arange(1, 2 * t + 1, dtype=U) * U(0xA0761D6478BD642F))

    def __call__(self, items: np.ndarray) -> np.ndarray:
        t, n = self.t, len(items)
        out = np.full(t, np.iinfo(U).max, U)
        step = max(1, (2 * t) // n)
        i = 0
        with np.errstate(over="ignore"):
            while i < t and (out == np.iinfo(U).max).any():
                rounds = np.arange(i, min(t, i + step))
                x = X.mix(items[None, :] ^ self.seeds[rounds][:, None])
                bins = ((x >> U(32)) * U(t)) >> U(32)
                value = (rounds.astype(U)[:, None] << U(32)) | (x & U(0xFFFFFFFF))
                np.minimum.at(out, bins.ravel().astype(np.int64), value.ravel())
                i += step
            for b in np.flatnonzero(out == np.iinfo(U).max):
                out[b] = (U(t + b) << U(32)) | (X.mix(items ^ self.seeds[t + b]) & U(0xFFFFFFFF)).min()
        return out

    def bands(self, items: np.ndarray, rows: int) -> np.ndarray:
        """One 64-bit key for each band of ``rows`` coordinates."""
        s = self(items).reshape(-1, rows)
        key = np.arange(1, len(s) + 1, dtype=U)
        with np.errstate(over="ignore"):
            for k in range(rows):
                key = X.mix(key * U(0x9FB21C651E98DF25) + s[:, k])
        return key


def bands_for(percent: int, rows: int, miss: float = 1.3e-7) -> int:
    """So many bands that a pair at ``percent`` shares none with a probability of ``miss`` at most."""
    return -(-math.log(miss) // math.log1p(-((percent / 100) ** rows))) if percent < 100 else 1


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text that has words."""
    for s in X.slices(column):
        value, first = X.shingles(X.words(s), len(s), width)
        for d in np.flatnonzero(np.diff(first)):
            yield s.first + d, X.distinct(value[first[d] : first[d + 1]])


def _features(width: int, bands: int, rows: int):
    """Per text: size and digest of its shingle set, and its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(bands * rows)
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            digest: list = [None] * len(batch)
            keys: list = [None] * len(batch)
            for i, items in _sets(batch.column("text"), width):
                n[i] = len(items)
                digest[i] = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
                keys[i] = sketch.bands(items, rows).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "keys"],
            )

    return run


def _full_sets(width: int, wanted):
    """(doc_id, digest, items) of the texts whose doc_id the filter lets pass, in batches of bounded size."""

    def rows(held: list) -> pa.RecordBatch:
        ids, items = zip(*held, strict=True)
        digest = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in items]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digest, pa.binary()), pa.array([x.view(np.int64) for x in items], pa.list_(pa.int64()))], ["doc_id", "digest", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(passes(bitmap, ids.view(U)))
            held: list = []
            size = 0
            for i, items in _sets(batch.column("text").take(pa.array(at)), width):
                held.append((ids[at[i]], items))
                size += len(items)
                if size > 500_000:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    return run


#: Bits of the bitmaps that sets are folded into.
FOLD = 512


def _folded(items: np.ndarray) -> np.ndarray:
    bits = np.zeros(FOLD, np.uint8)
    bits[(items & U(FOLD - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set and centre: the size of what is common, and bitmaps of what the set lacks of the centre and has besides."""
    for batch in batches:
        common = np.zeros(len(batch), np.int64)
        lacks, adds = [], []
        for i, (x, p) in enumerate(zip(batch.column("items"), batch.column("other"), strict=True)):
            own, centre = (v.values.to_numpy(zero_copy_only=False).view(U) for v in (x, p))
            at = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
            both = centre[at] == own
            left = np.ones(len(centre), bool)
            left[at[both]] = False
            common[i] = both.sum()
            lacks.append(_folded(centre[left]))
            adds.append(_folded(own[~both]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("x"), batch.column("p"), pa.array(common), pa.array(lacks, pa.list_(pa.int64())), pa.array(adds, pa.list_(pa.int64()))],
            ["x", "p", "common", "lacks", "adds"],
        )


def _beside(pairs: DataFrame, sets: DataFrame, others: DataFrame, spread: int = 256) -> DataFrame:
    """``pairs`` (x, p, more columns) with x's items of ``sets``, and p's of ``others`` as ``other``. The set of a p in many pairs
    is copied, one copy for each ``spread`` of them, and its pairs are dealt out over the copies."""
    load = pairs.groupBy("p").agg(F.ceil(F.count("*") / spread).alias("copies"))
    dealt = pairs.join(load, "p").withColumn("copy", F.pmod(F.xxhash64("x"), F.col("copies"))).drop("copies")
    centres = others.withColumnsRenamed({"x": "p", "items": "other"}).join(load, "p").select("p", "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return dealt.join(sets, "x").join(centres, ["p", "copy"]).drop("copy")


def _linked(common: Column, n: Column, m: Column, percent: int) -> Column:
    return common * 100 >= (n + m - common) * percent


def _counts_allow(percent: int) -> Column:
    """Whether the sizes of two rows that met one centre, and of what each has of it, leave a link possible."""
    n, m, common, other = (F.col(c) for c in ("n", "p_n", "common", "p_common"))
    by_counts = F.least(common, other) + F.least(n - common, m - other)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & _linked(by_counts, n, m, percent)


def _can_be_linked(centre: Column, percent: int) -> Column:
    """Whether two rows that met one centre of so many shingles can be linked; columns of the second have the prefix p_.

    Counts decide most. Else, elements share bits of a bitmap: a union has at least as many elements as bits, and of one set's
    additions at least as many are missing from the other as there are bits that the other's lack.
    """
    n, m, common, other = (F.col(c) for c in ("n", "p_n", "common", "p_common"))
    words = range(FOLD // 64)

    def total(parts) -> Column:
        first, *rest = parts
        return sum(rest, first)

    def word(name: str, k: int) -> Column:
        return F.get(F.col(name), F.lit(k))

    def shared(one: str, two: str) -> Column:
        return F.col(f"{one}n") - F.col(f"{one}common") - total(F.bit_count(word(f"{one}adds", k).bitwiseAND(F.bitwise_not(word(f"{two}adds", k)))) for k in words)

    missing = total(F.bit_count(word("lacks", k).bitwiseOR(word("p_lacks", k))) for k in words)
    by_bits = F.least(centre - missing, common, other) + F.least(shared("", "p_"), shared("p_", ""))
    return _counts_allow(percent) & _linked(by_bits, n, m, percent)


def _hubs(pairs: DataFrame) -> DataFrame:
    """(p, hub): the centres p about which at least half of the rows x of ``pairs`` (x, p) have one other centre, the hub, as the
    largest that they are about or are themselves. A hub has no hub.

    When the other rows about p are compared with the hub too, all that were to meet about p can meet about the hub. For each row
    that comes to a hub two or more leave p, so a large group, whose rows share buckets of many centres, meets about few.
    """
    sizes = pairs.groupBy("p").agg(F.count("*").alias("size"))
    all_ = pairs.join(sizes, "p").select("x", "p", "size").unionByName(sizes.select(F.col("p").alias("x"), "p", "size"))
    largest = all_.groupBy("x").agg(F.max(F.struct("size", "p"))["p"].alias("hub"))
    held = pairs.join(largest, "x").groupBy("p", "hub").agg(F.count("*").alias("held"))
    most = held.groupBy("p").agg(F.max(F.struct("held", "hub")).alias("most"), F.sum("held").alias("size"))
    most = most.filter("most.hub != p and 2 * most.held >= size").select("p", "most.hub")
    return most.join(most.select(F.col("p").alias("hub")), "hub", "left_anti").select("p", "hub")


#: So many classes about a centre are compared with all others about it, in each round.
ROUNDS = (8, 64)


def _still_open(rows: DataFrame) -> DataFrame:
    """Of the centres with classes of several labels about them: their rows, with the numbers of classes about the centre
    (``size``) and of those with the row's label (``held``)."""
    held = rows.groupBy("centre", "label").agg(F.count("*").alias("held"))
    several = held.groupBy("centre").agg(F.count("*").alias("labels"), F.sum("held").alias("size")).filter("labels > 1")
    return rows.join(held.join(several.drop("labels"), "centre"), ["centre", "label"])


def _second(rows: DataFrame, *kept: str) -> DataFrame:
    """``rows`` as the second of a pair: x is p, and other columns have the prefix p_, but for those to join on."""
    return rows.withColumnsRenamed({c: "p" if c == "x" else f"p_{c}" for c in rows.columns if c not in kept})


def _about_centres(open_: DataFrame, chosen: DataFrame, percent: int, spread: int = 4096) -> DataFrame:
    """Pairs of rows about one centre, one of them ``chosen``. The chosen are copied, one copy for each ``spread`` rows about
    their centre, and the rows are dealt out over the copies."""
    copies = F.ceil(F.col("size") / spread)
    second = _second(chosen.select("centre", "x", "n", "common", "lacks", "adds", "label", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy")), "centre", "copy")
    marked = open_.join(chosen.select("centre", "x", F.lit(True).alias("is_chosen")), ["centre", "x"], "left")
    dealt = marked.withColumn("copy", F.pmod(F.xxhash64("x"), copies))
    # a pair of chosen ones is met from one side
    other = (F.col("label") != F.col("p_label")) & (F.col("is_chosen").isNull() | (F.col("x") < F.col("p")))
    return dealt.join(second, ["centre", "copy"]).filter(other & _can_be_linked(F.col("centre_n"), percent))


def _differences(lacking: bool):
    """Of each set x (of the label ``by``) and centre p: the elements that the set has besides the centre's, or, ``lacking``, those
    that it lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *ids, own, centre in zip(*(batch.column(c).to_pylist() for c in ("x", "p", "by")), batch.column("items"), batch.column("other"), strict=True):
                own, centre = (v.values.to_numpy(zero_copy_only=False) for v in (own, centre))
                found = np.setdiff1d(centre, own, assume_unique=True) if lacking else np.setdiff1d(own, centre, assume_unique=True)
                for i in range(0, len(found), 100_000):
                    part = found[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.full(len(part), i)) for i in ids), pa.array(part)], ["x", "centre", "by", "element"])

    return run


def _of_several(found: DataFrame) -> DataFrame:
    """(centre, element, often): the elements that rows about a centre with more than one ``by`` have, and how many rows have them."""
    counted = found.groupBy("centre", "element").agg(F.count("*").alias("often"), F.min("by").alias("low"), F.max("by").alias("high"))
    return counted.filter("low != high").select("centre", "element", "often")


def _may_be_linked(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` (centre, centre_n, lacks, adds, held, ...) without those that no other row about their centre C can be linked with.

    ``held`` of a row's additions are in rows of other labels too. With K = 100 * lacks + percent * adds and
    T = (100 - percent) * C, a row is linked with C if E = K - T is at most 0, and two rows are linked if (100 + percent) times the
    elements that their differences have in common are at least K(x) + K(y) - T. These are at most the lesser number of elements
    lacked and the lesser ``held``. So S = (100 + percent) * (lacks + held) - K of each is at least E of the other, and so is this
    with the other's ``held``. Rows that are both linked with C have one label, so one of the two isn't linked with it.
    """
    whole = 100 + percent
    k = F.col("lacks") * 100 + F.col("adds") * percent
    e = k - F.col("centre_n") * (100 - percent)
    bounds = {"e": e, "s": (F.col("lacks") + F.col("held")) * whole - k, "bare": F.col("lacks") * whole - k}
    rows = rows.withColumns(bounds)
    of_centre = rows.groupBy("centre").agg(
        F.min("e").alias("least_e"), F.min(F.when(F.col("e") > 0, F.col("e"))).alias("least_free"), F.max("s").alias("most_s"), F.max("bare").alias("most_bare")
    )
    met = (F.col("least_e") <= F.col("s")) & (F.col("most_s") >= F.col("e")) & (F.col("most_bare") + F.col("held") * whole >= F.col("e"))
    able = rows.join(of_centre, "centre").filter(F.when(F.col("e") > 0, met).otherwise(F.col("least_free") <= F.col("s")))
    return able.drop(*bounds, *of_centre.columns[1:])


def _rare_differences(open_: DataFrame, sets: DataFrame, of_centres: DataFrame, percent: int, ws: Workspace, by: str = "x") -> DataFrame:
    """(centre, x, element, n, common, linked, strong): the rarest elements of each row's difference D from its centre C, as
    many as are needed for every linked pair of rows about C to have one in common.

    Of a row, let l be what it lacks of C and a what it has besides, so D has l + a elements. Two rows x and y have
    C - l(x) - l(y) + the common elements of D(x) and D(y) in common. As a link needs percent / (100 + percent) of both sizes, and
    a y that isn't linked with C has less than that of its own and C's, the differences of x and such a y have more than
    (percent * a(x) + 100 * l(x)) / (100 + percent) elements in common; of x and a y that is linked with C, at least
    (100 - percent) * C / (100 + percent) fewer. Sets that have k elements in common share one of the first size - k + 1 by any
    one order, so these are kept: ``strong`` ones by the first number, all by the second. Rows that are both linked with C have
    one label and needn't meet. Elements go by the number of rows that have them, rarest first, so what a group has in common is
    reached last.

    Additions are looked at first, and only the rows that may be linked by what they have in common of them (`_may_be_linked`)
    are looked at for what they lack. Rows of one ``by`` needn't meet.
    """
    lacks, adds, whole = F.col("centre_n") - F.col("common"), F.col("n") - F.col("common"), 100 + percent
    of_row = Window.partitionBy("centre", "x")
    open_ = open_.withColumn("by", F.col(by))

    def differences(rows: DataFrame, lacking: bool) -> DataFrame:
        beside = _beside(rows.select("x", F.col("centre").alias("p"), "by"), sets, of_centres)
        return ws.save(beside.mapInArrow(_differences(lacking), "x long, centre long, by long, element long"), "lacking" if lacking else "additions")

    additions = differences(open_.filter(adds > 0), False)
    held = additions.join(_of_several(additions), ["centre", "element"]).groupBy("centre", "x").agg(F.count("*").alias("held"))
    able = open_.select("centre", "x", "n", "common", "centre_n", "by", lacks.alias("lacks"), adds.alias("adds"))
    able = ws.save(able.join(held, ["centre", "x"], "left").fillna(0, ["held"]), "held")
    for again in (1, 2):  # without the first ones that can't be linked, less is possible for others
        able = ws.save(_may_be_linked(able, percent), f"able-{again}")
    found = additions.join(able, ["centre", "x"], "left_semi").unionByName(differences(able.filter("lacks > 0"), True))
    often = ws.save(_of_several(found), "often")
    least = F.col("least")
    rows = able.select(
        "centre", "x", "n", "common", (lacks + adds).alias("d"), _linked(F.col("common"), F.col("n"), F.col("centre_n"), percent).alias("linked"),
        F.floor((lacks * 100 + adds * percent) / whole).alias("least"), F.ceil((lacks * 100 + adds * percent - F.col("centre_n") * (100 - percent)) / whole).alias("weak"),
    )
    # elements of one row, or one label, only share nothing: they come first and are counted, not kept
    shared = found.drop("by").join(often, ["centre", "element"])
    shared = shared.withColumns({"place": F.row_number().over(of_row.orderBy("often", "element")), "held": F.count("*").over(of_row)})
    place = F.col("d") - F.col("held") + F.col("place")
    strong = place <= F.col("d") - least
    kept = strong | (~F.col("linked") & (place <= F.col("d") - F.greatest("weak", F.lit(1)) + 1))
    rare = shared.join(rows, ["centre", "x"]).filter(kept)
    rare = ws.save(rare.select("centre", "x", "element", "n", "common", "linked", strong.alias("strong")), "rare")
    ws.drop("additions", "held", "able-1", "able-2", "lacking", "often")
    return rare


def _stars(rare: DataFrame) -> DataFrame:
    """Pairs of each row with the first of those that share a rare element."""
    strong = rare.filter("strong")
    first = strong.groupBy("centre", "element").agg(F.min(F.struct("x", "n", "common", "label")).alias("first")).select("centre", "element", "first.*")
    return strong.join(_second(first, "centre", "element"), ["centre", "element"]).filter("x != p")


def _sharing(rare: DataFrame) -> DataFrame:
    """All pairs that share a rare element."""
    free = rare.filter("not linked")
    strong = free.filter("strong")
    both = strong.join(_second(strong, "centre", "element"), ["centre", "element"]).filter("x < p")
    return both.unionByName(free.join(_second(rare.filter("linked"), "centre", "element"), ["centre", "element"]))


def _groups(docs: DataFrame, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles and digest of every row, and ``component``: the smallest doc_id linked with its class."""
    ws = Workspace(docs.sparkSession, "near")
    source = docs.select("doc_id", text_of().alias("text"))
    features = ws.save(source.mapInArrow(_features(width, bands, rows), "doc_id long, n_shingles long, digest binary, keys array<long>"), "features")
    named = features.filter("n_shingles > 0 and doc_id is not null")
    # a class has a number of its own, as a doc_id may have several texts
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"))
    classes = ws.save(classes.withColumn("x", F.monotonically_increasing_id()), "classes")
    # one member of each class: its keys are those of every other member
    members = named.join(classes.select("digest", F.col("doc").alias("doc_id"), "x"), ["digest", "doc_id"]).dropDuplicates(["doc_id", "digest"])
    entries = ws.save(members.select(F.explode("keys").alias("key"), "x"), "entries")
    sized = entries.withColumn("size", F.count("*").over(Window.partitionBy("key"))).filter("size > 1")
    sized = ws.save(sized, "sized")
    ws.drop("entries")
    # every class of a bucket is to meet its centre
    weight = sized.groupBy("x").agg(F.sum("size").alias("weight"))
    centres = sized.join(weight, "x").groupBy("key").agg(F.max(F.struct("weight", "x"))["x"].alias("p"))
    around = ws.save(sized.select("key", "x").join(centres, "key").filter("x != p").select("x", "p").distinct(), "around")
    hubs = ws.save(_hubs(around), "hubs")
    pairs = ws.save(around.unionByName(around.join(hubs, "p").filter("x != hub").select("x", F.col("hub").alias("p"))).distinct(), "pairs")
    ws.drop("sized", "around")
    ends = pairs.select("x", F.lit(False).alias("centre")).unionByName(pairs.select(F.col("p").alias("x"), F.lit(True).alias("centre")))
    ends = ends.groupBy("x").agg(F.max("centre").alias("centre"))
    in_buckets = ws.save(classes.join(ends, "x").select("x", "digest", F.col("doc").alias("doc_id"), "centre"), "in-buckets")
    # sets are made where the texts are, of those that the filter lets pass; the join keeps the wanted ones
    sets = source.mapInArrow(_full_sets(width, bit_filter(in_buckets.select("doc_id"))), "doc_id long, digest binary, items array<long>")
    sets = sets.join(in_buckets, ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"])
    sets = ws.save(sets.select("x", "items", "centre"), "sets")
    of_centres, sets = sets.filter("centre").drop("centre"), sets.drop("centre")

    met = _beside(pairs, sets, of_centres).mapInArrow(_compared, "x long, p long, common long, lacks array<long>, adds array<long>")
    sizes = classes.select("x", "n")
    met = met.join(sizes, "x").join(sizes.withColumnsRenamed({"x": "p", "n": "p_n"}), "p")
    met = ws.save(met, "met")
    links = met.filter(_linked(F.col("common"), F.col("n"), F.col("p_n"), percent)).select(F.col("x").alias("a"), F.col("p").alias("b"))
    # rows that share a doc_id are one document, whatever their texts
    twice = named.groupBy("doc_id").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).filter("first != last").select("doc_id", "first")
    number = classes.select("digest", "x")
    same = named.join(twice, "doc_id").select("digest", "first").distinct().join(number.withColumnRenamed("x", "a"), "digest")
    links = links.unionByName(same.join(number.withColumnsRenamed({"digest": "first", "x": "b"}), "first").select("a", "b"))
    labels = ws.save(components(links, ws, "components-0"), "labels-0")

    def relabelled(df: DataFrame, map_: DataFrame, of: str) -> DataFrame:
        now = map_.select(F.col("node").alias(of), F.col("label").alias("new_"))
        return df.join(now, of, "left").withColumn("label", F.coalesce("new_", of)).drop("new_")

    open_ = relabelled(met, labels, "x").withColumnsRenamed({"p": "centre", "p_n": "centre_n"})
    open_ = ws.save(_still_open(open_.join(hubs, F.col("centre") == hubs["p"], "left_anti")), "open-0")
    ws.drop("met", "pairs")
    step = 0

    def contracted(both: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The labels when the pairs of ``both`` are verified and those that are linked have one, and the map from old to new ones."""
        nonlocal step
        pairs = _beside(ws.save(both.select("x", "p", "n", "p_n", "label", "p_label").distinct(), f"pairs-{step}"), sets, sets)
        found = pairs.filter(_linked(F.size(F.array_intersect("items", "other")), F.col("n"), F.col("p_n"), percent))
        map_ = components(found.select(F.col("label").alias("a"), F.col("p_label").alias("b")), ws, f"components-{step + 1}")
        step += 1
        now = relabelled(labels.withColumnRenamed("label", "old_"), map_, "old_").select("node", "label")
        labels = ws.save(now.unionByName(map_.join(labels, "node", "left_anti")), f"labels-{step}")
        ws.drop(f"labels-{step - 1}", f"pairs-{step - 1}")
        return labels, map_

    for most in ROUNDS:
        if open_.isEmpty():
            break
        # labels with few classes come first
        chosen = open_.withColumn("rank", F.row_number().over(Window.partitionBy("centre").orderBy("held", "x"))).filter(F.col("rank") <= most)
        chosen = ws.save(chosen.drop("rank"), f"chosen-{step}")
        labels, map_ = contracted(_about_centres(open_, chosen, percent), labels)
        # a chosen class has met all others about its centre
        left = open_.join(chosen.select("centre", "x"), ["centre", "x"], "left_anti").drop("size", "held").withColumnRenamed("label", "old_")
        open_ = ws.save(_still_open(relabelled(left, map_, "old_").drop("old_")), f"open-{step}")
        ws.drop(f"open-{step - 1}", f"chosen-{step - 1}")
    if not open_.isEmpty():
        rare = _rare_differences(open_, sets, of_centres, percent, ws, "label")
        bits = open_.select("centre", "x", "centre_n", "lacks", "adds")
        for candidates in (_stars, _sharing):
            both = candidates(relabelled(rare, labels.select("node", "label"), "x")).filter(F.col("label") != F.col("p_label")).filter(_counts_allow(percent))
            both = both.select("centre", "x", "p", "n", "p_n", "common", "p_common", "label", "p_label").distinct()
            both = both.join(bits, ["centre", "x"]).join(_second(bits.drop("centre_n"), "centre"), ["centre", "p"])
            labels, _ = contracted(both.filter(_can_be_linked(F.col("centre_n"), percent)), labels)
        ws.drop("rare")
    ws.drop("sets")
    least = labels.join(classes.withColumnRenamed("x", "node"), "node").groupBy("label").agg(F.min("doc").alias("component"))
    of_class = labels.join(least, "label").select(F.col("node").alias("x"), "component")
    of_class = classes.join(of_class, "x", "left").select("digest", F.coalesce("component", "doc").alias("component"))
    return features.drop("keys").join(of_class, "digest", "left")


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int | None = None, rows: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A document's set: its distinct ``width``-word shingles, A-Z lower-cased, words being runs without [\\x20\\x09-\\x0D]; with
    fewer words the whole sequence; without words (null or blank text) empty, and linked with nothing. Documents are linked if
    100 * intersection >= ``percent`` * union, confirmed on full sets. component_id is the smallest doc_id reachable; kept says
    that it is the row's own, so of ties the smallest doc_id stays. doc_id names a document: rows that share one, with equal
    texts or others, are one node, but for empty rows, which are components of their own doc_id. A row without a doc_id is a
    component of its own and kept. An empty table gives an empty one. A very long text is read whole and its set compared whole.
    Other columns are ignored, whatever their names. Sets hold 64-bit hashes of shingles.

    ``bands`` of ``rows`` coordinates follow from ``percent`` (40 at 80), so that a pair at the threshold shares none with a
    probability of 1.3e-7; nothing else loses a link.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies between 1 and 100")
    found = _groups(docs, width, percent, int(bands or bands_for(percent, rows)), rows)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"), own.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, with all their columns.

    Of rows that share the doc_id that stays, one stays: the longest, then the greatest text. Rows without a doc_id stay.
    """
    groups = Workspace(docs.sparkSession, "near").save(near_groups(docs, **options), "groups")
    gone = groups.filter(~F.col("kept")).select("doc_id")
    return one_of_each(docs.join(gone, "doc_id", "left_anti"), groups.filter("kept").select("doc_id")).select(docs.columns)
