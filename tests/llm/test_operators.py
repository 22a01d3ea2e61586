"""Each operator against a plain version on small fixtures, with nulls, empty and long texts, ties, repeated rows and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seqloom.llm import _text, arrowfile, brown, chat, decontam, exact, langid, minhash, packing, queries, toxicity

from .helpers import AWKWARD, DOCS, frame, groups, lower, sets, tokens

SF = "/root/testdata/sf0.001"
TOK = public_tokenizers.path


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return sorted(((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()))


def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_words_and_shingles():
    texts = [None, "", " a B\tc ", "b", "c a b c a", "", "é x"]
    for s in _text.slices(pa.array(texts), 4):
        w = _text.words(s)
        got = [[bytes(s.data[a:b]).decode().lower() for a, b, d in zip(w.start, w.end, w.doc) if d == i] for i in range(len(s))]
        assert got == [tokens(texts[s.first + i]) for i in range(len(s))]
    s = next(_text.slices(pa.array(texts)))
    w = _text.words(s)
    assert len(set(w.hash.tolist())) == 5
    value, first = _text.shingles(w, len(s), 2)
    assert [len(set(value[a:b].tolist())) for a, b in zip(first, first[1:])] == [len(x) for x in sets(texts, 2)]


def test_exact(spark, documents, rows):
    def plain(pairs):
        groups_ = {}
        for d, t in pairs:
            groups_.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), d))
        return {
            d: (min(v)[1], len(v), d == min(v)[1], hashlib.sha256(k.encode()).hexdigest()) for k, v in groups_.items() for _, d in v
        }

    def check(df, pairs, **options):
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.exact_groups(df, **options).collect()}
        assert got == plain(pairs)

    check(documents, rows)
    copies = ["a b", "ab", " a\tb "] * 30 + AWKWARD + [f"t{i}" for i in range(50)]
    check(frame(spark, copies), list(enumerate(copies)))
    check(frame(spark, copies), list(enumerate(copies)), heavy=2, counters=8)
    assert exact.exact_groups(empty(spark)).count() == 0
    again = frame(spark, ["x", "y"]).union(frame(spark, ["x", "y"])).union(spark.createDataFrame([(None, "x", None, None, None)], DOCS))
    got = sorted((r["doc_id"] is None, r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_groups(again).collect() if r["doc_id"] != 1)
    assert got == [(False, 0, None, 3, False), (False, 0, None, 3, False), (True, None, None, 3, True)]
    assert exact.drop_exact(frame(spark, copies)).columns == frame(spark, copies).columns


def test_exact_leaves_one_row_of_each_text(spark):
    rows_ = [(1, "a b"), (5, "ab"), (5, "c"), (5, "c"), (5, " c"), (6, "c"), (7, "d"), (7, "d"), (None, "e"), (None, "e"), (None, "d"), (8, "f"), (9, "f "), (None, "long er"), (10, "longer"), (11, None), (11, "")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows_], DOCS)
    left = sorted((str(r["doc_id"]), str(r["text"])) for r in exact.drop_exact(df).collect())
    assert left == sorted([("1", "a b"), ("5", " c"), ("None", "d"), ("None", "e"), ("9", "f "), ("None", "long er"), ("11", "")])


@pytest.mark.parametrize("width", [2, 5])
def test_near(spark, documents, rows, width):
    got = by_id(minhash.near_groups(documents, width=width))
    want = groups([t for _, t in rows], width)
    assert {d: r["component_id"] for d, r in got.items()} == {d: rows[c][0] for (d, _), c in zip(rows, want)}
    assert {d: r["n_shingles"] for d, r in got.items()} == {d: len(s) for (d, _), s in zip(rows, sets([t for _, t in rows], width))}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_near_chains_and_awkward(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(100)]
    texts = list(AWKWARD)
    for k in range(60):  # each differs from the base in a few words, and from each other in twice as many
        own = list(base)
        for i in rng.integers(0, 100, 1 + k % 6):
            own[i] = f"x{k}-{i}"
        texts.append(" ".join(own))
    chain = list(base)
    for k in range(12):  # a chain whose ends are unlike
        chain = [*chain[8:], *(f"c{k}-{i}" for i in range(8))]
        texts.append(" ".join(chain))
    got = by_id(minhash.near_groups(frame(spark, texts), width=2))
    assert [got[i]["component_id"] for i in range(len(texts))] == groups(texts, 2)
    assert minhash.near_groups(empty(spark)).count() == 0
    nameless = spark.createDataFrame([(None, "a b c", None, None, None), (1, "a b c", None, None, None), (1, "a b c", None, None, None)], DOCS)
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in minhash.near_groups(nameless).collect()) == [("1", "1", True)] * 2 + [("None", "None", True)]


@pytest.mark.parametrize("rounds", [(), (1,), (8, 64)])
def test_near_groups_with_a_phrase_in_common(spark, monkeypatch, rounds):
    # one phrase of three quarters; some share a second one, some are near copies, some are parts of others, some are near the phrase itself
    rng = np.random.default_rng(8)
    core, second = [f"c{i}" for i in range(60)], [f"s{i}" for i in range(12)]
    texts = []
    for k in range(200):
        own = [f"u{k}-{i}" for i in range(20)]
        texts.append(core + (second + own[12:] if k % 5 == 0 else own))
        if k % 7 == 0:  # a few words away from the one before, in either part
            near = list(texts[-1])
            for i in rng.integers(0, 80, 1 + k % 11):
                near[i] = f"n{k}-{i}"
            texts.append(near)
        if k % 9 == 0:
            texts.append(texts[-1][: int(rng.integers(50, 80))])
        if k % 20 == 0:
            texts.append(core + [f"z{k}-{i}" for i in range(k % 16)])
    texts = [" ".join(t) for t in texts]
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    got = by_id(minhash.near_groups(frame(spark, texts), width=1))
    want = groups(texts, 1)
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert 20 < len(texts) - len(set(want)) < 200


@pytest.mark.parametrize("percent", [50, 80, 93])
def test_near_rare_differences_lose_no_link(spark, percent):
    rng = np.random.default_rng(percent)
    centre = np.arange(1000, 1060)
    rows_ = [centre]
    for _ in range(150):  # parts of the centre, with additions from few elements, some of them alike
        x = np.concatenate([rng.permutation(centre)[: rng.integers(20, 61)], rng.permutation(40)[: rng.integers(0, 30)]])
        rows_ += [np.unique(x), np.unique(np.append(rng.permutation(x)[rng.integers(0, 6) :], rng.integers(0, 40, 2)))]
    rows_ = [np.array(x) for x in sorted({tuple(x.tolist()) for x in rows_[1:]} - {tuple(centre.tolist())})]
    sets_ = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate([centre, *rows_])], "x long, items array<long>").cache()
    open_ = spark.createDataFrame([(i + 1, 0, len(centre), len(x), len(np.intersect1d(x, centre))) for i, x in enumerate(rows_)], "x long, centre long, centre_n long, n long, common long")
    rare = minhash._rare_differences(open_, sets_, sets_.filter("x = 0"), percent, minhash.Workspace(spark, "near"))
    rare = rare.withColumn("label", F.col("x"))
    met = {tuple(sorted(r)) for r in minhash._sharing(rare).select("x", "p").distinct().collect()}

    def share(x, y):
        return 100 * len(np.intersect1d(x, y)) / len(np.union1d(x, y))

    with_centre = [share(x, centre) >= percent for x in rows_]
    linked = {(i + 1, j + 1) for i, x in enumerate(rows_) for j in range(i + 1, len(rows_)) if not (with_centre[i] and with_centre[j]) and share(x, rows_[j]) >= percent}
    assert len(linked) > 20 and linked <= met


def test_near_copies_meet_about_few_centres(spark, monkeypatch):
    # copies of one text with other words changed share buckets of many centres; what they differ in grows with their number only
    rng = np.random.default_rng(3)
    core = [f"c{i}" for i in range(150)]
    texts = []
    for k in range(400):
        own = list(core)
        for i in rng.permutation(150)[: 1 + k % 14]:
            own[i] = f"x{k}-{i}"
        texts.append(" ".join(own))
    made = {}
    save = minhash.Workspace.save

    def saved(ws, df, name, *args):
        out = save(ws, df, name, *args)
        made[name] = out.count()
        return out

    monkeypatch.setattr(minhash, "ROUNDS", ())
    monkeypatch.setattr(minhash.Workspace, "save", saved)
    got = by_id(minhash.near_groups(frame(spark, texts), width=5))
    want = groups(texts, 5)
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert 20 < len(set(want)) < 400
    assert made["open-0"] < 2 * len(texts) < made["met"]
    assert made["additions"] + made["lacking"] < 50 * len(texts)


def test_near_hubs(spark):
    about = [(x, 1) for x in range(10, 30)] + [(x, 2) for x in range(10, 16)] + [(1, 2), (40, 2)] + [(x, 3) for x in (10, 40, 41)] + [(x, 4) for x in (50, 51)]
    got = minhash._hubs(spark.createDataFrame(about, "x long, p long")).collect()
    assert [(r["p"], r["hub"]) for r in got] == [(2, 1)]


def test_near_words_that_differ_in_a_regular_pattern(spark):
    # complementary Thue-Morse words are equal to any polynomial modulo 2**64
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    docs = frame(spark, [one[:1024], other[:1024], one, other, one[:256], other[:256], "x" * 700_000 + " y", "x" * 700_000 + " z"])
    got = by_id(minhash.near_groups(docs, width=2))
    assert all(r["kept"] for r in got.values())
    words = [*(one[:n] for n in range(1, 300)), *(other[:n] for n in range(1, 300))]
    w = _text.words(next(_text.slices(pa.array([" ".join(words)]))))
    assert len(set(w.hash.tolist())) == len(words)


def test_near_one_document_with_two_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows_ = [(5, a), (5, b), (6, a + " z"), (7, b + " z"), (8, "other"), (5, b), (8, "other"), (None, "other"), (None, "other"), (9, None), (9, " ")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows_], DOCS)
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_groups(df, width=2).collect()}
    assert got == {(5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True), (None, None, True), (9, 9, True)}
    left = sorted((str(r["doc_id"]), str(r["text"])) for r in minhash.drop_near(df, width=2).collect())
    assert left == sorted([("5", max(a, b)), ("8", "other"), ("None", "other"), ("None", "other"), ("9", " ")])


def test_near_bound_never_refuses_a_link(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    rows_ = []
    for k in range(60):  # the first with few additions, the others with more than the bitmaps can tell apart
        x, y = (np.unique(np.concatenate([rng.permutation(centre)[: rng.integers(100, 300)], rng.integers(0, 1 << 63, rng.integers(0, 100 if k < 30 else 1500), dtype=np.uint64)])) for _ in "xy")
        extra = rng.integers(0, 1 << 63, rng.integers(0, 50 if k < 30 else 200), dtype=np.uint64)
        x, y = np.unique(np.append(x, extra)), np.unique(np.append(y, extra))
        rows_.append((x, y))
    c = pa.array([np.sort(centre).view(np.int64)] * 60, pa.list_(pa.int64()))
    met = []
    for k in (0, 1):
        own = pa.array([r[k].view(np.int64) for r in rows_], pa.list_(pa.int64()))
        met += [next(minhash._compared(iter([pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(range(60)), own, c], ["x", "p", "items", "other"])]))).to_pydict()]
    for m, k in ((met[0], 0), (met[1], 1)):
        assert m["common"] == [len(np.intersect1d(r[k], centre)) for r in rows_]
    table = [(300, *(m[c][i] if c != "n" else len(rows_[i][k]) for k, m in enumerate(met) for c in ("n", "common", "lacks", "adds"))) for i in range(60)]
    df = spark.createDataFrame(table, "c long, n long, common long, lacks array<long>, adds array<long>, p_n long, p_common long, p_lacks array<long>, p_adds array<long>")
    share = np.array([len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for x, y in rows_])
    for percent in range(1, 100, 3):
        passed = np.array([r[0] for r in df.select(minhash._can_be_linked(F.col("c"), percent)).collect()])
        assert passed[100 * share >= percent].all()
        assert not passed[:30][100 * share[:30] < percent - 25].any()


def test_bands_follow_from_the_threshold():
    assert minhash.bands_for(80, 5) == 40
    assert all((1 - (p / 100) ** 5) ** minhash.bands_for(p, 5) <= 1.3e-7 for p in (50, 60, 80, 90, 99))


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    sketch = minhash.Sketcher(256)
    for n in (3, 40, 3000):
        items = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = items[: n + n // 2], items[n // 2 :]
        truth = len(set(a.tolist()) & set(b.tolist())) / len(set(items.tolist()))
        assert abs((sketch(a) == sketch(b)).mean() - truth) < 0.15


def _plain_ids(name, text):
    from tokenizers import Tokenizer

    global _cached
    try:
        tk = _cached[name]
    except (NameError, KeyError):
        tk = Tokenizer.from_file(TOK(name))
        _cached = {**globals().get("_cached", {}), name: tk}
    return tk.encode(text or "", add_special_tokens=False).ids


WEIRD = ["  a   b \n\n c\t\td ", "x   y", "\x1cq  z", "don't  Stop!!\r\n\r\n OK \x01", "<|endoftext|> hi", "a <|endoftext|>b <|startoftext|> <|ENDOFTEXT|> <|endoftext", "ΑΣ ẞ É", "a\x85b", "İst 12½ ²", "a.b,c. d.,"]


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing(spark, rows, capacity):
    texts = AWKWARD + WEIRD + [t for _, t in rows[:60]]
    got = packing.pack(frame(spark, texts), TOK("byte_bpe_50k.json"), capacity=capacity).collect()
    ids = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        own = ids.setdefault(r["doc_id"], [])
        assert r["start"] == len(own) and len(r["ids"]) == 4 * r["length"] and (r["length"] == capacity or r["piece"] == 0)
        own += np.frombuffer(r["ids"], "<u4").tolist()
    assert ids == {i: [*_plain_ids("byte_bpe_50k.json", t), 2] for i, t in enumerate(texts)}
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(sequences) <= 1.05 * sum(map(len, ids.values())) / capacity + 2
    digest = packing.pack_digest(frame(spark, texts), TOK("byte_bpe_50k.json"), capacity=capacity)
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in digest.collect()} == {(r["doc_id"], r["piece"], zlib.crc32(r["ids"])) for r in got}


def test_packing_shards_and_empty(spark):
    assert packing.pack(empty(spark), TOK("byte_bpe_50k.json")).count() == 0
    sizes = np.random.default_rng(3).integers(1, 1024, 4000)
    of, at = packing.sum_of_squares(np.sort(sizes)[::-1], 1024)
    assert of.max() + 1 <= 1.01 * sizes.sum() / 1024 + 1
    pieces = spark.createDataFrame([(i, 0, int(s)) for i, s in enumerate(sizes)], "doc_id long, piece int, length long")
    packed = packing.place(pieces, 1024, shard=500).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k"))
    assert packed.agg(F.sum("k")).first()[0] == 4000 and packed.filter("n > 1024").count() == 0


def test_arrow_files(spark, rows, tmp_path):
    texts = AWKWARD + WEIRD + [t for _, t in rows[:80]]
    parts = arrowfile.write_parts(frame(spark, texts), f"file://{tmp_path}", TOK("word_bpe_49k.json"), "word", 1, length=64)
    got = by_id(arrowfile.read_documents(parts, f"file://{tmp_path}"))
    start, stream = 0, []
    for i, t in enumerate(texts):
        ids = [*_plain_ids("word_bpe_49k.json", t), 1]
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
        stream += ids
    read, firsts = [], 0
    for p in sorted(tmp_path.glob("part-*.index.arrow")):
        part = arrowfile.TokenPart(f"file://{str(p).removesuffix('.index.arrow')}")
        for k in range(sum(len(b) for b in part.batches)):
            ids, mask = part.sequence(k)
            assert len(ids) == 64
            read += ids[mask.to_numpy(zero_copy_only=False)].tolist()
        firsts += sum(b.column("first").flatten().to_numpy(zero_copy_only=False).sum() for b in part.batches)
    assert read == stream and firsts == len(texts)
    none = arrowfile.write_parts(empty(spark), f"file://{tmp_path}/none", TOK("word_bpe_49k.json"), "word", 1)
    assert arrowfile.read_documents(none, f"file://{tmp_path}/none").count() == 0


def test_chat(spark):
    rows_ = [(c, k, r, t) for c, turns in {1: "abc", 2: "ab", 3: "abd", 4: "ab", 5: "x", 6: "x", 7: "abca"}.items() for k, (r, t) in enumerate(("user", x) for x in turns)]
    rows_ += [(8, 0, None, None), (8, 1, "user", "z"), (9, 0, None, None), (None, 0, "user", "lost"), (3, 0, "user", "a"), (10, None, "user", "x")]
    df = spark.createDataFrame(rows_, "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["snapshots"]) for r in chat.collapse(df).collect()}
    assert got == {7: (4, 1), 3: (3, 1), 5: (1, 3), 8: (2, 1)}
    assert chat.collapse(df.limit(0)).count() == 0
    text = chat.collapse(df).filter("conv_id = 8").first()["text"]
    assert text == "<|im_start|>\n<|im_end|>\n<|im_start|>user\nz<|im_end|>\n"


def test_language(spark, documents):
    got = by_id(queries.op2_language_id(spark, SF))
    want = {r["doc_id"]: (r["lang"], r["text"]) for r in documents.select("doc_id", "lang", "text").collect()}
    held = [d for d, r in got.items() if r["held_out"]]
    assert len(got) == len(want) and all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert np.mean([got[d]["lang_pred"] == want[d][0] for d in held]) > 0.97
    model = langid.learn(documents)
    awkward = by_id(langid.predict(frame(spark, [*AWKWARD, "— …"]), model))
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= r["score"] <= 1 for t, r in zip([*AWKWARD, "— …"], (awkward[i] for i in range(len(AWKWARD) + 1))))
    assert langid.predict(frame(spark, ["abc"]), langid.learn(empty(spark))).first()["lang_pred"] == "und"
    profile = model.languages
    assert profile == sorted({x for x, _ in want.values()})


def test_grams():
    texts = ["", "Ab", "a1b", "é", "  "]
    owner, gram = langid.grams(next(_text.slices(pa.array(texts))))
    got = [[int(g).to_bytes(4, "little") for g in gram[owner == i]] for i in range(len(texts))]
    want = []
    for t in texts:
        raw = b"  " + re.sub(rb"[^a-z\x80-\xff]", b" ", lower(t).encode()) + b"  "
        want.append([raw[i : i + 4] for i in range(len(raw) - 3) if raw[i : i + 4] != b"    "])
    assert got == want


def test_toxicity(spark):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    texts, toxic = [], []
    for k in range(600):
        sentences = [" ".join(rng.choice(words, 8)) for _ in range(rng.integers(1, 40))]
        toxic.append(int(k % 4 == 0))
        if toxic[-1]:
            sentences[rng.integers(len(sentences))] += " " + rng.choice(["vile", "nasty"])
        texts.append(". ".join(sentences))
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic) if i < 400] + [(None, 1), (3, None), (9999, 0)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = by_id(toxicity.score(docs, model))
    assert all(got[i]["predicted"] == toxic[i] for i in range(600))
    raw = texts[0].encode()
    assert [raw[x["start"] : x["end"]] for x in got[0]["offending"]] in ([b"vile"], [b"nasty"])
    awkward = by_id(toxicity.score(frame(spark, AWKWARD), model, spans=False))
    assert all(0 <= r["score"] < 0.5 for r in awkward.values()) and len(awkward) == len(AWKWARD)
    nothing = toxicity.learn(docs, labels.limit(0))
    assert toxicity.score(docs, nothing).filter("predicted = 1").count() == 0
    assert toxicity.score(empty(spark), model).count() == 0


def test_brown(spark, rows):
    texts = AWKWARD + [t for _, t in rows[:100]]
    docs = frame(spark, texts)
    ok = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    train = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    for top in (1 << 18, 100):  # most words at hand, or by the join
        got = by_id(brown.score_corpus(docs, train, head=40, endings=20, classes=8, top=top))
        count = Counter(w for i, t in enumerate(texts) if ok(i) for w in [*tokens(t), None])
        n, v = sum(count.values()), len(count)
        for i, t in enumerate(texts):
            own = [*tokens(t), None]
            assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(own), sum(w in count for w in own), n)
            assert got[i]["base_score"] == pytest.approx(sum(np.log10((count[w] + 1) / (n + v + 1)) for w in own))
        scores = {i: got[i]["score"] for i in got} if top > 100 else scores
    assert {i: got[i]["score"] for i in got} == pytest.approx(scores)
    held = [i for i in got if not ok(i)]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)
    assert brown.score_corpus(empty(spark), empty(spark)).count() == 0
    assert by_id(brown.score_corpus(docs, empty(spark)))[0]["n_known"] == 0


def test_brown_words_beyond_the_first_get_their_own_class(spark):
    # of two words of one ending and count, one is used like p, the other like q; only a, b, p and q are in the first step
    train = frame(spark, ["a xab a p a p a p a p", "b yab b q b q b q b q"] * 20)
    docs = frame(spark, ["a xab", "a yab", "b yab", "b xab"])
    got = {k: r["score"] for k, r in by_id(brown.score_corpus(docs, train, head=4, endings=4, classes=6)).items()}
    assert got[0] > got[1] + 0.5 and got[2] > got[3] + 0.5


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(5)
    counts, of = rng.poisson(3, (30, 30)).astype(float), np.append(rng.integers(1, 6, 29), 0)
    f = lambda x: float((x * np.log(np.maximum(x, 1e-300))).sum())
    found = []
    for k in range(1, 6):
        hot = np.eye(6)[np.append(k, of[1:])]
        table = hot.T @ counts @ hot
        found.append(f(table) - f(table.sum(0)) - f(table.sum(1)))
    rest, own = counts.copy(), counts[0, 0]
    rest[0] = rest[:, 0] = 0
    hot = np.eye(6)[of]
    got = brown.gains(hot.T @ rest @ hot, np.bincount(of[1:], counts[0, 1:], 6), np.bincount(of[1:], counts[1:, 0], 6), own)[1:]
    assert got - got[0] == pytest.approx(np.array(found) - found[0])


def test_exchange_ends_where_no_move_gains():
    rng = np.random.default_rng(3)
    counts = rng.poisson(rng.gamma(0.2, 5, (80, 80))).astype(float)
    of = brown.exchange(counts, 12)
    for w in range(79):
        out_, in_ = np.bincount(of, counts[w], 12), np.bincount(of, counts[:, w], 12)
        out_[of[w]] -= counts[w, w]
        in_[of[w]] -= counts[w, w]
        own = np.concatenate([out_, in_, [counts[w, w]]])
        hot = np.eye(12)[of]
        assert brown.own_class(hot.T @ counts @ hot, of[w], own) == of[w]


def test_exchange_finds_classes_and_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    counts = np.zeros((9, 9))
    for i in range(8):  # even units follow odd ones
        for j in range(8):
            counts[i, j] = rng.integers(50, 60) if (i + j) % 2 else 1
    counts[8, :8] = counts[:8, 8] = 5
    of = brown.exchange(counts, 3)
    assert of[8] == 0 and len({*of[:8:2]}) == len({*of[1:8:2]}) == 1 and of[0] != of[1]


def test_decontamination(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontam.leaks(documents, bench)

    def plain(texts, items):
        letters = re.compile("[A-Za-z\x80-\U0010ffff]+")
        words = lambda t: [lower(w) for w in letters.findall(t or "")]
        gram = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
        out = set()
        for item, text in items:
            parts = [w for w in map(words, decontam.split_item(text or "")) if w]
            for d, t in texts:
                own = words(t)
                if parts and all(len(gram(p, k := min(5, len(p))) & gram(own, k)) >= 0.8 * len(gram(p, k)) for p in parts):
                    out.add((d, item))
        return out

    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == plain(texts, items) != set()
    awkward = frame(spark, [*AWKWARD, *(t for _, t in items[:5]), "word " * 4000 + items[7][1] + " more", items[8][1].upper()], first=1000)
    odd = spark.createDataFrame([*items, (900, None), (901, ""), (902, items[0][1]), (903, "a")], "item_id long, text string")
    texts = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = plain(texts, [(i, t) for i, t in [*items, (902, items[0][1]), (903, "a")]])
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(awkward, odd).collect()} == want
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(awkward, odd, most_bytes=2000).collect()} == want
    assert decontam.leaks(empty(spark), bench).count() == decontam.leaks(awkward, odd.limit(0)).count() == 0


def test_block_max_wand_equals_full_scores():
    rng = np.random.default_rng(4)
    vocabulary = [f"{a}{b}" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    rows_ = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 40), p=weight / weight.sum())), "") for i in range(300)]
    index = decontam.ItemIndex.build(rows_, 5, block=4)
    for _ in range(60):
        query = np.unique(rng.choice(len(index.terms), 30))
        scores = np.zeros(300)
        for t in query:
            a, b = index.first[t], index.first[t + 1]
            scores[index.item[a:b]] += index.impact[a:b]
        for threshold in (0.1, 0.3, 0.5):
            got = dict(index.block_max_wand(query, threshold))
            assert got == pytest.approx({i: scores[i] for i in np.flatnonzero(scores >= threshold)})


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[2] / "seqloom"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "llm" in p.read_text()]
