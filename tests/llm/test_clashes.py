"""Extra columns named like those operators use inside change nothing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from seqloom.llm import arrowfile, brown, chat, decontam, exact, langid, minhash, packing, suffix, toxicity

from .helpers import AWKWARD, frame

NAMES = "key keys doc digest n n_ size sha label bits start end first anchor ids length piece sequence_id offset shard_ row_ h hash_ all_ place_ score predicted kept component_id group_size toxic turns prefixes item_id".split()


def clashing(df):
    return df.withColumns({c: F.lit(None).cast("string") for c in NAMES if c not in df.columns})


def test_clashes(spark, tmp_path):
    texts = [*AWKWARD, "the same words here " * 20, "the same words here " * 20 + "again", "other words " * 60]
    plain = frame(spark, texts)
    docs = clashing(plain)
    labels = clashing(spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, toxic int"))
    bench = clashing(spark.createDataFrame([(1, "the same words here the same words. Here again the")], "item_id long, text string"))
    tok = public_tokenizers.path

    def same(f):
        a, b = (sorted(map(str, f(d).collect())) for d in (docs, plain))
        assert a == b and len(a) >= 1

    same(exact.exact_groups)
    same(minhash.near_groups)
    same(lambda d: suffix.remove_repeats(d, keep=False))
    same(lambda d: packing.pack_digest(d, tok("byte_bpe_50k.json")).drop("sequence_id", "offset"))
    same(lambda d: langid.predict(d, langid.learn(d)))
    same(lambda d: toxicity.score(d, toxicity.learn(d, labels)))
    same(lambda d: brown.score_corpus(d, d))
    assert decontam.leaks(docs, bench).count() == decontam.leaks(plain, bench).count()
    parts = arrowfile.write_parts(docs, f"file://{tmp_path}/a", tok("word_bpe_49k.json"), "word", 1)
    assert arrowfile.read_documents(parts, f"file://{tmp_path}/a").count() == len(texts)
    turns = clashing(spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, None, "b")], "conv_id long, turn int, role string, text string"))
    assert [r["conv_id"] for r in chat.collapse(turns).collect()] == [2]
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns, name
