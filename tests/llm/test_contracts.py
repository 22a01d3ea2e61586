"""The queries as they are registered, over whole tables, against plain versions of what they promise."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from seqloom.llm import _text, brown, langid, queries, toxicity
from seqloom.llm._shared import Workspace, crc_mod

from .helpers import frame, lower, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(spark, name, sf=SF):
    return queries.QUERIES[name](spark, sf).collect()


def part(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_repeats(spark, texts):
    seen, want = set(), {}
    for d, t in sorted(texts.items()):
        raw = t.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 99):
            if (w := raw[i : i + 100]) in seen:
                gone[i : i + 100] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        want[d] = (len(raw), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows_of(spark, "op3_suffix_array")}
    assert got == want and any(w[1] for w in want.values())


def _ids(name, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return {d: [*tokenizer.encode(t, add_special_tokens=False).ids, end] for d, t in texts.items()}


def test_packing(spark, texts):
    ids, got, sequences = _ids("byte_bpe_50k.json", texts, 2), defaultdict(list), defaultdict(list)
    for r in rows_of(spark, "op5_packing"):
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got.keys() == ids.keys()
    for d, pieces in got.items():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r["piece"])):
            own = np.array(ids[d][at : at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(own.tobytes())) and (r["length"] == 1024 or k == 0)
            at += r["length"]
        assert at == len(ids[d]) and (len(pieces) == 1 or at > 1024)
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= math.ceil(sum(map(len, ids.values())) / 1024) + 2


def test_token_files(spark, texts):
    ids, start, want = _ids("word_bpe_49k.json", texts, 1), 0, {}
    for d in sorted(ids):
        want[d] = (start, len(ids[d]), zlib.crc32(np.array(ids[d], "<u4").tobytes()))
        start += len(ids[d])
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of(spark, "op7_arrow_tokens")} == want


def test_language(spark, texts):
    """Profiles as plain sets, without a filter's false positives."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}

    def grams(t):
        raw = b"  " + re.sub(rb"[^a-z\x80-\xff]", b" ", lower(t).encode()) + b"  "
        return [raw[i : i + 4] for i in range(len(raw) - 3) if raw[i : i + 4] != b"    "]

    held, size = defaultdict(Counter), Counter()
    for d, t in texts.items():
        if part(d, 3) != 1 and lang[d]:
            held[lang[d]].update(set(grams(t)))
            size[lang[d]] += 1
    order = lambda c: sorted(c.items(), key=lambda x: (-x[1], int.from_bytes(x[0], "little")))
    profile = {k: {g for g, n in order(c)[:8192] if n >= max(min(2, size[k] / 4), 0.005 * size[k])} for k, c in held.items()}
    got = {r["doc_id"]: r for r in rows_of(spark, "op2_language_id")}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        own = grams(t)
        hits = {k: sum(g in p for g in own) for k, p in sorted(profile.items())}
        best = max(hits, key=hits.get) if any(c.isalpha() for c in t) else "und"
        first, second = sorted(hits.values())[-1], sorted(hits.values())[-2]
        assert got[d]["held_out"] == (part(d, 3) == 1)
        if best == "und" or first - second > 0.02 * len(own):
            assert got[d]["lang_pred"] == best
        if best != "und" and sum(hits.values()):
            assert got[d]["score"] == pytest.approx(first / sum(hits.values()), abs=0.03)


def test_toxicity(spark):
    """The noisy-or of sentences, worked out one by one with the model's weights; held-out labels."""
    sf = "/root/testdata/sf0.01"  # the smallest tables have too few toxic documents to learn a word
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    model = toxicity.learn(docs, labels.filter(crc_mod("doc_id", 5) != 0))
    weight = dict(zip(model.vocabulary.tolist(), model.weights.tolist(), strict=True))
    letters = re.compile("[A-Za-z\x80-\U0010ffff]+")
    hashed = {}

    def number(word):
        if word not in hashed:
            s = next(_text.slices(pa.array([word])))
            hashed[word] = int(_text.words(s, _text.LETTER).hash[0])
        return hashed[word]

    got = {r["doc_id"]: r for r in rows_of(spark, "op9_toxicity", sf)}
    assert got.keys() == texts.keys() and weight
    for d, t in texts.items():
        none = math.exp(model.leak)
        for sentence in re.split("[.!?\n]", t):
            known = {h for w in letters.findall(sentence) if (h := number(w)) in weight}
            if known:
                none *= 1 - min(1 / (1 + math.exp(-max(-30, min(30, sum(weight[h] for h in known) + model.bias)))), 1 - 1e-9)
        assert got[d]["score"] == pytest.approx(1 - none, abs=1e-6) and got[d]["predicted"] == (got[d]["score"] >= 0.5)
        assert got[d]["held_out"] == (part(d, 5) == 0)
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels.filter("toxic is not null").collect() if r["doc_id"] in got and part(r["doc_id"], 5) == 0]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_brown(spark, texts):
    """The model's probabilities, added up word by word from plain counts and the words' classes; they sum to one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ws = Workspace(spark, "test")
    model, _ = brown.learn(docs.filter(crc_mod("doc_id", 7) != 2).select("text"), ws)
    count = Counter(w for d, t in texts.items() if part(d, 7) != 2 for w in tokens(t))
    ends = sum(part(d, 7) != 2 for d in texts)
    words = sorted(set(count) | {w for t in texts.values() for w in tokens(t)})
    klass = {}
    for s in _text.slices(pa.array(words)):
        klass |= dict(zip(words[s.first : s.first + len(s)], model.classes_of(s, _text.words(s)).tolist(), strict=True))
    n, v = Counter(), Counter()
    for w, c in count.items():
        n[klass[w]] += c
        v[klass[w]] += 1
    got = {r["doc_id"]: r for r in rows_of(spark, "op10_brown")}
    total, kinds = sum(count.values()) + ends, len(count) + 1
    for d, t in texts.items():
        own, before, value, base = tokens(t), 0, 0.0, 0.0
        for w in own:
            value += model.step[before, klass[w]] + math.log10((count[w] + 1) / (n[klass[w]] + v[klass[w]] + 1))
            base += math.log10((count[w] + 1) / (total + kinds + 1))
            before = klass[w]
        value += model.step[before, 0]  # the end's class holds the end alone
        base += math.log10((ends + 1) / (total + kinds + 1))
        assert got[d]["base_score"] == pytest.approx(base) and got[d]["n_tokens"] == len(own) + 1
        assert got[d]["n_known"] == sum(w in count for w in own) + 1 and got[d]["train_tokens"] == total
        assert got[d]["held_out"] == (part(d, 7) == 2)
        assert got[d]["score"] == pytest.approx(value), d
    assert (10**model.step).sum(1) == pytest.approx(np.ones(len(model.step)))


def test_empty_and_very_long_texts_pass_through_every_query_operator(spark):
    """A text longer than a slice of the scanners, between others."""
    long = " ".join(f"word{i % 9000} x{i}" for i in range(60_000))
    assert len(long) > 1 << 19
    df = frame(spark, ["a b c", long, None, long + " more", "a b c"])
    from seqloom.llm import minhash, suffix

    near = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(df, width=2).collect()}
    assert near == {0: 0, 1: 1, 2: 2, 3: 1, 4: 0}
    cut = {r["doc_id"]: r for r in suffix.remove_repeats(df, keep=False).collect()}
    assert cut[1]["n_removed"] == 0 and cut[3]["n_removed"] == len(long) and cut[3]["n_spans"] == 1
    model = langid.learn(df)
    assert {r["lang_pred"] for r in langid.predict(df, model).filter("doc_id != 2").collect()} == {"en"}
