"""What the findings of round 3 told, each with a case that failed before."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from seqloom.functions import quality as Q
from seqloom.operators import align, consensus, mates, prefixes, primers, search, seeds
from seqloom.plans import registry
from seqloom.sources import ranges, shared


def _documents(spark, folder, texts):
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_multiline_fastq_holds_some_records_only(tmp_path):
    path = tmp_path / "a.fq"
    with open(path, "w") as f:
        for i in range(4000):
            f.write(f"@r{i}\n" + ("ACGT" * 25 + "\n") * 20 + "+\n" + ("@+I5" * 25 + "\n") * 20)
    reader = ranges._WholeReader({"path": str(path)})
    tracemalloc.start()
    seen = [len(b) for part in reader.partitions() for b in reader.read(part)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(seen) == 4000 and len(seen) > 3
    assert most < path.stat().st_size * 2  # of 16 MB; the whole text and its lines took more


def test_common_words_come_to_the_driver_as_bits(spark):
    rows = spark.range(0, 5000).withColumn("at", F.col("id") % 1700 * 7)
    flags = seeds._bits(rows.select("at"), 1 << 16)
    assert flags.nbytes == (1 << 16) // 8
    assert np.flatnonzero(np.unpackbits(flags, bitorder="little")).tolist() == sorted({i % 1700 * 7 for i in range(5000)})


def test_a_filter_on_reasons_leaves_the_chain_once(spark):
    trimmed = registry._trim(spark, "/root/testdata/sf0.001").filter("deleted and delete_reason = 'Distal'").select("read_id")
    plan = trimmed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[TAAG,p1]") == 1 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_totals_of_quality_strings(spark):
    texts = ["I5?#!", "", None, "!" * 700] * 100
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, qual string")
    assert [r[0] for r in df.orderBy("id").select(Q.total(F.col("qual"))).collect()] == [92, 0, 0, 0] * 100
    assert [len(x) for x in Q.slices(pa.array(range(600)))] == [256, 256, 88]


def test_colors_of_a_read_without_bases(spark, tmp_path):
    got = {r["read_id"]: r for r in registry.QUERIES["color_space"](spark, _documents(spark, tmp_path, ["", None, "a"])).collect()}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert [(got[i]["colors"], got[i]["bases"]) for i in range(3)] == [(md5("G2"), md5("")), (md5("G2"), md5("")), (md5("G2"), md5("A"))]


def test_a_degenerate_stop_stands_at_its_first_place(spark):
    df = spark.createDataFrame([("TTTTTTTTCAGCAATT",), ("TTTTTTTTCAGCGTTT",), ("TTTT",)], "seq string")
    assert [r[0] for r in df.select(primers.trim_stop(F.col("seq"), ("GT", "CAR"), 8, 13)).collect()] == ["TTTTTTTT", "TTTTTTTTCAGC", "TTTT"]


def test_an_empty_index_begins_no_key(spark):
    files = spark.createDataFrame([("",), ("TA",), (None,), ("G",)], "index string")
    keys = spark.createDataFrame([("TAC_1",), ("",), (None,)], "demux_key string")
    assert [r[0] for r in prefixes.begins_any(files, "index", keys, "demux_key").collect()] == ["TA"]


def test_votes_are_dealt_out_by_a_number(spark):
    rows = spark.createDataFrame([(1, "a;b", 2), (2, "a;c", 1)], "read_id long, taxonomy string, n long")
    plan = consensus.consensus(rows)._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(read_id#{plan.split('hashpartitioning(read_id#')[1].split(',')[0]}, 256), REPARTITION_BY_NUM" in plan


def test_batches_for_python_are_small(spark):
    registry.QUERIES["quality_gate"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("4m", "4194304", "4194304b")


def test_pairs_are_merged_in_batches(spark):
    pairs = spark.createDataFrame([(1, "ACGTACGTACGT", "TTACGTACGT", "x"), (2, "A", "C", "y"), (3, None, "C", "z")], "id int, seq string, mate_seq string, qual string")
    found = mates.merge_pairs(pairs, 4)
    assert found.columns == ["id", "seq", "mate_seq", "qual", "overlap", "mismatches", "merged"]
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["id"], r["overlap"], r["merged"]) for r in found.orderBy("id").collect()] == [(1, 8, "ACGTACGTACGTAA"), (2, None, None), (3, None, None)]


def test_seeds_and_sequences_are_not_broadcast(spark, capsys):
    """What Python makes of a small file is taken for small; every join by seed or sequence has to be dealt by key on both sides."""
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    reads = spark.createDataFrame([(i, some(200)) for i in range(5)], "read_id long, seq string")
    refs = reads.select(F.col("read_id").alias("ref_id"), F.concat("seq", F.lit("ACGT")).alias("seq"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        seeder = seeds.Seeder.learn(refs, 12)
        pairs = search.candidates(seeder.table(reads, "read_id"), seeder.table(refs, "ref_id"), 3)
        assert pairs.count() == 5
        for df in (pairs, search.align_pairs(pairs, reads, refs)):
            df.explain()
            plan = capsys.readouterr().out
            assert "Join" in plan and "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_words_are_counted_by_task_and_summed_by_chunk(spark):
    rng = random.Random(9)
    often, rare = ("".join(rng.choice("ACGT") for _ in range(24)) for _ in range(2))
    rows = [(i, often * 3) for i in range(40)] + [(100 + i, rare) for i in range(8)] + [(200, None), (201, "")]
    refs = spark.createDataFrame(rows, "ref_id long, seq string").repartition(6)
    seeder = seeds.Seeder.learn(refs, 12, 8, levels=2)
    flags = np.unpackbits(seeder.common[0], bitorder="little")
    place = lambda s: (seeds._words(seeds._CODE[np.frombuffer(s.encode(), np.uint8)], 12) & np.uint64((1 << 24) - 1)).astype(int)
    assert set(np.flatnonzero(flags).tolist()) == set(place(often * 3).tolist())
    assert not flags[place(rare)].any()
    sent = seeds._above(spark.createDataFrame([(0, b"\x05\x09\x00"), (0, b"\x04\x00\x08"), (1, b"\x09\x09\x09")], "chunk long, times binary"), 8, 1 << 16)
    assert np.flatnonzero(np.unpackbits(sent, bitorder="little")).tolist() == [0, 1, 1 << 15, (1 << 15) + 1, (1 << 15) + 2]


def test_equal_ends_are_left_out_of_alignments(monkeypatch):
    """A parent and its chimera: half of the work is spared and the alignment stays the same."""
    rng = random.Random(10)
    some = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    steps, whole = [], align.align_batch
    monkeypatch.setattr(align, "align_batch", lambda pieces, costs: steps.extend(p.steps for p in pieces) or whole(pieces, costs))
    for head, tail in ((some(260), some(60)), ("ACCA" * 65, some(60)), (some(40), some(280)), ("A" * 150, "AAT" * 50)):
        for own, other in ((head + some(30) + tail, head + some(34) + tail), (head + tail, head + some(45)), (some(45) + tail, head + tail), (head + tail, head)):
            got = align.align_all([own], [other], [(-20, 20)])
            with monkeypatch.context() as whole_pieces:
                whole_pieces.setattr(align, "_core", lambda piece, costs: (0, piece, 0))
                assert align.align_all([own], [other], [(-20, 20)]) == got
    own = some(320)
    steps.clear()
    align.align_all([own], [own[:260] + some(60)], [(-20, 20)])
    assert 0 < sum(steps) < 0.5 * 640


def test_denovo_keeps_no_seeds(spark, monkeypatch):
    """Seeds take many times a read's bytes; with their counts they were written, after a shuffle of all."""
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    a, b = some(300), some(300)
    reads = spark.createDataFrame([(1, a, 4), (2, b, 4), (3, a[:150] + b[150:], 1)], "read_id long, seq string, seq_count long")
    kept, save = [], shared.Workspace.save
    monkeypatch.setattr(shared.Workspace, "save", lambda ws, df, name, *more: kept.append((name, df.columns)) or save(ws, df, name, *more))
    assert {r["read_id"]: r["chimeric"] for r in search.find_chimeras_denovo(reads).collect()} == {1: False, 2: False, 3: True}
    assert kept and not any("seed" in columns for _, columns in kept)
