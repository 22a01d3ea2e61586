"""Functions, primers, filters, hits and the other read operators against known values and plain versions."""

from __future__ import annotations

import gzip
import json
from statistics import median

import pytest
from pyspark.sql import functions as F

from seqloom.functions import quality as Q
from seqloom.functions import sequence as S
from seqloom.operators import chimera, consensus, derep, filters, hits, mates, primers, qc, rollup, search, setops, trim, validate, warehouse
from seqloom.sources import config, fasta, fastq, formats, sinks, tables
from seqloom.streaming import runlog


def one(spark, column, **values):
    """The value of a column over one row."""
    names = list(values)
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()]) if names else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_expand():
    assert primers.expand("A.A") == ["AAA", "ACA", "AGA", "ATA"]
    assert [len(primers.expand(p)) for p in ("N[CT]", "N[CTA]", "NC?", "NC+", "NC*", "C{1,2}N")] == [8, 12, 8, 8, 12, 8]
    assert primers.expand("[T,G]A") == ["GA", "TA"] and len(primers.expand("[A,T,C,G]R")) == 8


@pytest.mark.parametrize("p, seq, want", [("TAT", "AATAT", ("", 0, "AATAT")), ("TAT", "TATAAA", ("TAT", 0, "AAA")), ("TAT", "ATATAAA", ("TAT", 1, "AAA"))])
def test_proximal(spark, p, seq, want):
    x = one(spark, primers.trim_proximal(F.col("s"), [(p, "n")]), s=seq)
    assert (x["primer"], x["at"], x["seq"]) == want


@pytest.mark.parametrize("p, seq, want", [("GTAT", "AATAT", None), ("AAA", "TATAAA", "TAT"), ("AAAG", "ATATAAAG", "ATAT"), ("CACACACA", "ATATCACACA", "ATAT"), ("CACACACA", "ATATCACA", None)])
def test_distal(spark, p, seq, want):
    x = one(spark, primers.trim_distal(F.col("s"), [(p, "n")]), s=seq)
    assert (x["seq"] if x["at"] >= 0 else None) == want


@pytest.mark.parametrize("freedom, seq, want", [(0, "GGGCACACATTT", "GGGCACACA"), (1, "GGCACACATTT", "GGCACACA"), (1, "GGGGCACACATTT", "GGGGCACACA"), (0, "GGCACACATTT", None)])
def test_anchor(spark, freedom, seq, want):
    a = primers.Anchor("a", False, 3, freedom, 6, "CACACA")
    found = primers.find_anchor(F.col("s"), a)
    assert one(spark, F.when(found.isNotNull(), primers.trim_anchor(F.col("s"), found, False)), s=seq) == want


def test_fuzzy_anchor_and_stop(spark):
    a = primers.Anchor("a", False, 2, 1, 10, "ACGTACGTAC")
    found = primers.find_anchor(F.col("s"), a, least=0.8)
    assert one(spark, found, s="TTACGTTCGTACGG").asDict() == {"sequence": "ACGTACGTAC", "start": 2, "end": 12, "ratio": 0.9}
    assert one(spark, found, s="TTGGGGGGGGGGGG") is None and one(spark, found, s="") is None
    # what is there of a window that the read's end cuts
    assert one(spark, found, s="TTACGTACGTA").asDict() == {"sequence": "ACGTACGTAC", "start": 2, "end": 12, "ratio": pytest.approx(18 / 19)}
    assert one(spark, primers.trim_anchor(F.col("s"), found, False), s="TTACGTACGTA") == "TTACGTACGTA"
    assert one(spark, primers.trim_stop(F.col("s"), ("ACGT",), 0, 5), s="TTTACGTGG") == "TTT"
    assert one(spark, primers.strip_inline(F.col("s"), "TA", primers.primer_regex("RC*")), s="TAGCCT") == "T"


def test_fuzzy_distal(spark):
    x = primers.trim_fuzzy_distal(F.col("s"), [("ACGTACGT", "d"), ("GGGG", "e")], most=2)
    assert one(spark, x, s="TTTACGTTCGTA").asDict() == {"primer": "ACGTACGT", "name": "d", "at": 3, "edits": 1, "seq": "TTT"}
    assert one(spark, x, s="TTTGGGGA")["name"] == "e" and one(spark, x, s="TTT")["at"] == -1
    reads = spark.createDataFrame([("a", "GGGCACACATTT"), ("b", "GGGG")], "read_id string, seq string")
    good, bad = primers.trim_by_anchor(reads, primers.Anchor("a", False, 3, 0, 6, "CACACA"))
    assert [r["seq"] for r in good.collect()] == ["GGGCACACA"] and [r["read_id"] for r in bad.collect()] == ["b"]


def test_suite():
    own = [primers.Primer("f", "bacteria", "v6", "F", "AAR"), primers.Primer("r", "bacteria", "v6", "R", "GTT")]
    assert primers.PrimerSuite.build(own, "F") == primers.PrimerSuite((("AAA", "f"), ("AAG", "f")), (("GTT", "r"),))
    assert primers.PrimerSuite.build(own, "R").proximal == (("AAC", "r"),)
    assert primers.PrimerSuite.build(own, "B").distal == (("GTT", "r"), ("TTT", "f"), ("CTT", "f"))


def test_functions(spark):
    s = F.col("s")
    assert one(spark, S.revcomp(s), s="GTTCAAAGAYTCGATGATTCAC") == "GTGAATCATCGARTCTTTGAAC"
    assert one(spark, S.revcomp_strict(s), s="AC.") == "NGT" and one(spark, S.revcomp_strict(s), s="ACX") is None
    assert one(spark, S.iupac_revcomp(s), s="aBR") == "YVt" and one(spark, S.complement(s, True), s="AU") == "UA"
    assert one(spark, S.to_rna(s), s="Tt") == "Uu" and one(spark, S.to_dna(s), s="Uu") == "Tt"
    colors = one(spark, S.color_encode(s), s="ACGNT")
    assert colors == "G21345" and one(spark, S.color_encode(s, "T"), s="NxA") == "T4.5" and one(spark, S.color_encode(s), s="NN") == "G46" and one(spark, S.color_decode(F.lit("G2133")), s="") == "ACGC"
    with pytest.raises(ValueError):
        S.color_encode(s, "x")
    with pytest.raises(Exception, match="no adapter base"):
        one(spark, S.color_decode(s), s="x01")
    assert one(spark, S.color_decode(s), s="G21345") == "ACGNN"
    assert one(spark, S.normalize_env_source(s), s="fresh_water") == "fresh water" and one(spark, S.normalize_env_source(s), s=S.MISCELLANEOUS) == "miscellaneous"
    read = spark.createDataFrame([("ACGN", "1234"), ("ACGu", "1234")], "seq string, qual string")
    assert [tuple(r) for r in S.revcomp_read(read).collect()] == [("NCGT", "4321"), ("aCGU", "4321")]
    for start, end in ((0, 3), (-2, None), (1, -1), (4, 2), (-9, 9)):
        assert one(spark, S.cut(s, start, end), s="ACGT") == "ACGT"[start:end]
        assert one(spark, S.cut_array(F.array(*map(F.lit, range(4))), start, end)) == list(range(4))[start:end]
    assert one(spark, S.frequency(s), s="a|b|frequency:12") == 12 and one(spark, S.frequency(s), s="x") is None
    assert one(spark, S.size_defline(s), s="a|frequency:3") == "a;size=3" and one(spark, S.frequency_defline(s), s="a;size=3") == "a|frequency:3"
    assert one(spark, S.mate_header(s), s="M:1:2 1:N:0:A") == "M:1:2 2:N:0:A" and one(spark, S.mate_id(s), s="r/1") == "r/2"
    assert one(spark, S.is_first_mate(s), s="r/2") is False
    assert one(spark, S.depth(S.lineage(s)), s="A; B;NA;C;Unassigned") == 3 and one(spark, S.depth(S.lineage(s)), s="NA") == -1
    assert one(spark, S.depth_name(S.lineage(s)), s="A;B") == "phylum"
    assert one(spark, S.pad_lineage(S.lineage(s)), s="A;B")[1:4] == ["B", "class_NA", "order_NA"] and one(spark, S.strip_na(s), s="A;NA") == "A"
    assert one(spark, S.subtract_first(s, F.lit("CG")), s="ACGCG") == "ACG" and one(spark, S.last_position(s, F.lit("CG")), s="ACGCG") == 3
    assert one(spark, S.indel_ratio(s, F.lit("ACGTACGTACGTA")), s="ACGTACCTACGTA") == pytest.approx(24 / 26)
    assert one(spark, S.indel_ratio(s, F.lit("")), s="") == 1.0 and one(spark, S.indel_ratio(s, F.lit("A")), s="") == 0.0
    assert one(spark, S.file_base(s), s="/a/b.c.fa") == "b.c" and one(spark, S.big_number(F.lit(1234567))) == "1,234,567"
    assert one(spark, S.window_mean(s, F.lit("GT"), F.array(*map(F.lit, (1, 2, 3, 4)))), s="ACGT") == 3.5
    assert one(spark, S.normalize_suite(s), s="Bac_V6 Suite") == "bacv6suite" and one(spark, S.direction(F.lit(False), F.lit(True))) == "R"


def test_quality(spark):
    q = Q.scores(F.col("s"))
    assert one(spark, q, s="!I") == [0, 40] and one(spark, q, s="") == [] and one(spark, Q.encode(q), s="#5I") == "#5I"
    assert one(spark, Q.q_mean(q), s="!I") == 20 and one(spark, Q.q_std(q), s="!I") == 20
    assert [one(spark, Q.phred_to_solexa(F.lit(x))) for x in (-1, 0, 1, 3, 40)] == [-5, -5, -6, 0, 40]
    assert one(spark, Q.solexa_to_phred(F.lit(-5))) == 1 and one(spark, Q.reencode(F.col("s"), "sanger", "solexa"), s="!I") == ";h"
    assert one(spark, Q.valid_quality(q, "sanger"), s="~") and not one(spark, Q.is_ascii(F.col("s")), s="1 2")
    assert one(spark, Q.lengths_agree(F.lit("A1"), q, True), s="I") and one(spark, Q.valid_sequence(F.lit("G01.2"), True))
    assert one(spark, Q.fake_quality(F.lit("AC"))) == "~~" and one(spark, Q.decimal_scores(F.lit("1  2"))) == [1, 2]


def test_filters(spark):
    df = spark.createDataFrame([("ACGTACGT", [2, 30, 30, 2, 30, 30, 2, 2])], "seq string, scores array<int>")
    assert filters.trim_ends(df, threshold=30).first()["seq"] == "CGTAC"
    assert filters.trim_ends(df, ends="3", threshold=30).first()["seq"] == "ACGTAC"
    assert filters.trim_ends(df, window=2, step=1, agg="mean", threshold=30).first()["seq"] == "CGTAC"
    assert filters.trim_ends(df, window=3, agg="min", exclude=1, threshold=30).first()["seq"] == "ACGTACG"
    cut = lambda scores, **x: filters.trim_ends(spark.createDataFrame([("ACGTACGT"[: len(scores)], scores)], "seq string, scores array<int>"), **x).first()["seq"]
    assert cut([2, 2, 30], window=2, agg="mean", threshold=30, ends="5") == "G"  # the last window is cut by the read's end
    assert cut([2, 2, 30], window=2, agg="mean", threshold=30, ends="3") == "" and cut([30], window=2, ends="53", threshold=30) == ""
    assert cut([40, 2, 2], window=3, agg="max", op="<=", threshold=10, exclude=1, ends="5") == "ACG"  # any place may be left out
    assert [cut([1, 1, 9, 9, 1], window=2, step=2, agg="sum", threshold=t) for t in (10, 11)] == ["GTA", ""]
    assert cut([], threshold=3) == "" and cut([1], exclude=1, threshold=3) == "A"
    assert filters.trim_ends(df, threshold=99).first()["seq"] == ""
    assert filters.clip(df, 2, 3).first()["seq"] == "GTA"
    assert one(spark, filters.fails_ambiguity(F.lit("ANC"), 2)) is False and one(spark, filters.fails_ambiguity(F.lit("ANC")))
    assert one(spark, filters.fails_first_50(F.array(*[F.lit(2)] * 34)))
    assert [one(spark, filters.compare(F.lit(2), op, 2)) for op in (">", ">=", "==", "<", "<=", "!=")] == [False, True, True, False, True, False]


def test_trim_precedence(spark):
    suite = primers.PrimerSuite((("AC", "p"),), (("GGGGG", "d"),))
    params = trim.TrimParams(min_length=4, max_length=10, run_keys=("TT",))
    body = {"ok": "ACTATATGGGGG", "near": "CCTATATGGGGG", "far": "ACTATATAA", "short": "ACTAT", "insert": "ACGGGGG", "long": "AC" + "TA" * 8 + "GGGGG", "n": "ACTATNATGGGGG", "low": "ACTATATGGGGG"}
    rows = [(k, "1", "TT" + b, [20 if k == "low" else 40] * (len(b) + 2)) for k, b in body.items()] + [("key", "1", "AATTT", [40] * 5), ("lane", "2", "TTACC", [40] * 5)]
    reads = spark.createDataFrame(rows, "read_id string, lane string, seq string, scores array<int>")
    samples = spark.createDataFrame([("TT", "1", "s")], "run_key string, lane string, sample string")
    got = {r["read_id"]: (r["delete_reason"], r["trimmed"]) for r in trim.trim_reads(reads, samples, suite, "F", params).collect()}
    assert {k: v[0] for k, v in got.items()} == {"ok": None, "near": "Proximal", "far": "Distal", "short": "Minimum Length", "insert": "No Insert", "long": "Maximum Length", "n": "N", "low": "Quality", "key": "Runkey", "lane": "Lanekey"}
    assert got["ok"][1] == "TATAT"
    assert {r["delete_reason"] for r in trim.trim_reads(reads, samples, primers.PrimerSuite((("AC", "p"),), ()), "F", params).filter("read_id = 'ok'").collect()} == {"Distal"}
    mixed = {"one": suite, "two": primers.PrimerSuite((("CC", "q"),), (("GGGGG", "d"),))}
    kinds = spark.createDataFrame([("TT", "1", "s", "one", "R"), ("TT", "2", "t", "two", "F")], "run_key string, lane string, sample string, suite string, direction string")
    both = reads.filter("read_id = 'ok'").unionByName(reads.filter("read_id = 'near'").withColumn("lane", F.lit("2"))).unionByName(reads.filter("read_id = 'ok'").withColumns({"read_id": F.lit("off"), "seq": F.concat(F.lit("TTA"), F.substring("seq", 3, 99))}))
    got2 = {r["read_id"]: (r["trimmed"], r["primer_name"], r["orientation"], r["idx_key"], r["delete_reason"]) for r in trim.trim_reads(both, kinds, mixed, None, params).collect()}
    assert got2 == {"ok": ("ATATA", "p", "+", "1_TT", None), "near": ("TATAT", "q", "+", "2_TT", None), "off": ("ATATA", "offset ", "+", "1_TT", None)}
    forced = trim.trim_reads(reads.filter("read_id = 'ok'").withColumn("seq", F.concat(F.lit("GG"), F.substring("seq", 3, 99))), samples, suite, "F", trim.TrimParams(min_length=4, forced_key="TT")).first()
    assert (forced["run_key"], forced["trimmed"]) == ("TT", "TATAT")
    out = trim.trim_outputs(trim.trim_reads(reads, samples, suite, "R", params), ["lane"])
    assert [r["seq"] for r in out["trimmed"].collect()] == ["ATATA"]
    assert out["no_key"].count() == 1 and out["deleted"].count() == 7 and sum(r["reads"] for r in out["stats"].collect()) == len(rows)
    assert out["unique"].first()["id"] == "ok|frequency:1" and out["abundance"].first()["id"] == "ok;size=1"


def test_hits_and_consensus(spark):
    h = spark.createDataFrame([(1, "a", 99.0, "10M2D5M"), (1, "b", 99.0, "10M"), (1, "c", 99.5, "4M12I4M"), (2, "a", 97.35, "12D8M")], "read_id int, ref_id string, pct_id double, cigar string")
    assert sorted((r["ref_id"], r["distance"]) for r in hits.top_hits(h).collect()) == [("a", 0.01), ("b", 0.01)]
    assert hits.top_hits(h, terminal="DI").filter("read_id = 2").first()["distance"] == 0.027
    assert hits.top_hits(h, None).filter("read_id = 1").first()["ref_id"] == "c" and hits.top_hits_chained(h).count() == 2
    uc = spark.createDataFrame([("H\t0\t9\t97.5\t+\t0\t0\t9M\tq\tr",), ("N\t1\t9\t*\t*\t*\t*\t*\tq\t*",)], "value string")
    assert tuple(hits.parse_uc(uc).first()) == ("q", 97.5, "r", "9M")
    rows = [(1, "Bacteria;X;Y", 2), (1, "Bacteria;X;Z", 1), (1, "Bacteria;X", 7), (2, None, None), (3, "Bacteria;X", 1), (3, "Bacteria;W", 1), (4, "NA;X", 1)]
    got = {r["read_id"]: r for r in consensus.consensus(spark.createDataFrame(rows, "read_id int, taxonomy string, n int")).collect()}
    assert got[1]["taxonomy"] == "Bacteria;X;NA" and got[1]["vote"] == 100 and got[1]["minrank"] == "class"
    assert (got[1]["taxa_counts"], got[1]["max_pcts"], got[1]["na_pcts"]) == ("1;1;2;0;0;0;0", "100;100;20;0;0;0;0", "0;0;70;100;100;100;100")
    assert got[2]["taxonomy"] == "Unknown" and got[3]["taxonomy"] == "Bacteria" and got[4]["taxonomy"] == "NA"


def test_derep_marts_chimeras(spark):
    reads = spark.createDataFrame([("s", i, q) for i, q in enumerate(["AC", "ac", "AC", "G"])], "sample string, read_id int, seq string")
    assert sorted((r["rep_id"], r["ids"]) for r in derep.dereplicate(reads, ["sample"]).collect()) == [(0, [0, 2]), (1, [1]), (3, [3])]
    assert sorted((r["rep_id"], r["seq"], r["seq_count"]) for r in derep.unique_by_hash(reads).collect()) == [(0, "AC", 3), (3, "G", 1)]
    two = reads.unionByName(reads.withColumns({"sample": F.lit(None).cast("string"), "read_id": F.col("read_id") + 10}))
    assert sorted((r["rep_id"], r["read_id"]) for r in derep.members(two, ["sample"]).collect()) == [(0, 0), (0, 2), (1, 1), (3, 3), (10, 10), (10, 12), (11, 11), (13, 13)]
    ranked = derep.abundance_rank(derep.counts(two, ["sample"]), ["sample"])
    assert sorted((r["rep_id"], r["abundance_rank"]) for r in ranked.collect()) == [(0, 1), (1, 2), (3, 3), (10, 1), (11, 2), (13, 3)]
    assert [r["abundance_rank"] for r in derep.abundance_rank(derep.counts(reads, []), []).orderBy("rep_id").collect()] == [1, 2, 3]
    cube = spark.createDataFrame([("d", "A;B;C", 3), ("d", "A;B", 1), ("d", "A;X", 2)], "dataset string, taxonomy string, knt int")
    up = {(r["rank"], r["taxonomy"]): r["sum_tax_counts"] for r in rollup.prefix_rollup(cube, ["dataset"]).collect()}
    assert up[0, "A"] == 6 and up[1, "A;B"] == 4 and up[2, "A;B;class_NA"] == 1
    assert all(sum(v for (k, _), v in up.items() if k == level) == 6 for level in range(8))
    rows = [("a", i, "ref", i < 8) for i in range(10)] + [("a", i, "denovo", i < 2) for i in range(10)] + [("b", 20, "ref", True), ("b", 21, "denovo", False)]
    checked = spark.createDataFrame(rows, "sample string, read_id int, source string, chimeric boolean")
    assert sorted((r["sample"], r["read_id"]) for r in chimera.believed(checked, ["sample"]).collect()) == [("a", 0), ("a", 1)]
    names = spark.createDataFrame([("k", 1, [1, 2, 3]), ("k", 5, [5])], "key string, rep_id int, ids array<int>")
    gone = spark.createDataFrame([("k", 1), ("k", 5)], "key string, read_id int")
    assert [(r["rep_id"], r["ids"]) for r in chimera.clean_names(names, gone, ["key"]).collect()] == [(2, [2, 3])]
    line = "\t".join(["1.0", "r;size=3", *["x"] * 14, "Y"])
    assert tuple(chimera.parse_uchime(spark.createDataFrame([(line,)], "value string")).first()) == ("r", True)


def test_sets_and_warehouse(spark):
    a, b = (spark.createDataFrame(x, "id string, seq string") for x in ([("1", "A"), ("2", "B")], [("2", "C"), ("3", "D")]))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(setops.plus(a, b)) == [("1", "A"), ("2", "C"), ("3", "D")] and rows(setops.either(a, b))[1] == ("2", "B")
    assert rows(setops.minus(setops.either(a, b), b)) == [("1", "A")] and rows(setops.both(a, b)) == [("2", "B")]
    with pytest.raises(KeyError):
        setops.minus(a, b, strict=True)
    assert setops.contains_all(setops.plus(a, b), a) and not setops.same_ids(a, b)
    assert rows(setops.set_value(a, "2", "Z")) == [("1", "A"), ("2", "Z")]
    assert rows(setops.position_range(a, 2, 9, "id")) == [("2", "B")]
    assert [r["i"] for r in warehouse.with_ids(spark.range(500).select(F.format_string("%05d", "id").alias("k")), ["k"], "i").orderBy("k").collect()] == list(range(1, 501))
    flake = warehouse.snowflake(spark.createDataFrame([("Bacteria;X",), ("bacteria;Y",)], "taxonomy string"))
    assert flake.select("domain_id").distinct().count() == 1 and flake.select("silva_taxonomy_id").distinct().count() == 2
    wide = spark.range(0, 60_000, 1, 40).select((F.col("id") * 7919 % 60_000).alias("k"), *[F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias(f"c{i}") for i in range(4)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        got = warehouse.numbered(wide.repartition(40), ["k"], "n").select("k", "n")
        assert got.agg(F.count("*"), F.countDistinct("n"), F.max(F.abs(F.col("n") - F.col("k") - 1))).first() == (60_000, 60_000, 0)
        assert setops.position_range(wide, 1000, 20_000, "k").count() == 19_001
        ids = warehouse.with_ids(wide, ["c0", "k"], "i")
        assert ids.agg(F.count("*"), F.countDistinct("i"), F.max("i")).first() == (60_000, 60_000, 60_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    samples = spark.createDataFrame([("r1", "p", "miseq", "k1", "v6", "proj", "t", "d", "f", "ds", "dd", "1"), ("r1", "p", "miseq", "k2", "v6", "proj", "t", "d", "f", "ds2", "dd", "1")], "run string, run_prefix string, platform string, run_key string, dna_region string, project string, project_title string, project_description string, funding string, dataset string, dataset_description string, lane string")
    t = warehouse.run_tables(samples)
    assert warehouse.run_info(samples, t).select("run_info_id").distinct().count() == 2 and t["projects"].first()["rev_project_name"] == "jorp" and set(t) == {"runs", "run_keys", "dna_regions", "projects", "datasets", "sequencing_platforms"}


def test_qc(spark):
    reads = spark.createDataFrame([(s,) for s in ([30, 2], [10, 2], [20, 40], [40])], "scores array<int>")
    got = {r["column"]: r for r in qc.column_stats(reads).collect()}
    assert (got[1]["count"], got[1]["min"], got[1]["max"], got[1]["sum"], got[1]["med"], got[1]["q1"], got[1]["q3"]) == (4, 10, 40, 100, 25.0, 10.0, 40.0)
    assert got[2]["med"] == median([2, 2, 40]) and (got[2]["q1"], got[2]["q3"], got[2]["outliers"]) == (2, 40, [])

    def plain(x):
        x, n = sorted(x), len(x)
        middle = lambda k: [k // 2] if k % 2 else [k // 2 - 1, k // 2]
        value = lambda at: sum(x[i] for i in at) / len(at)
        low, high = ([0], [n - 1]) if n < 3 else (middle(min(middle(n))), [max(middle(n)) + 1 + i for i in middle(min(middle(n)))])
        q1, q3 = value(low), value(high)
        inside = [v for v in x if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        return q1, value(middle(n)), q3, inside[0], inside[-1], sorted({v for v in x if v < inside[0]}) + sorted({v for v in x if v > inside[-1]}, reverse=True)

    for n in range(1, 14):
        column = [(i * i * 7 + n) % 11 + 20 * (i % 6 == 5) - 30 * (i % 7 == 6) for i in range(n)]
        r = qc.column_stats(spark.createDataFrame([([v],) for v in column], "scores array<int>")).first()
        assert (r["q1"], r["med"], r["q3"], r["left_whisker"], r["right_whisker"], r["outliers"]) == plain(column), column
    assert qc.column_stats(reads.filter("false")).count() == 0
    profile = qc.tile_profile(reads.withColumn("tile", F.lit("t")), ["tile"])
    assert qc.merge_tiles(profile, []).filter("cycle = 0").first()["mean"] == 25


def test_mates(spark):
    t = "ACGGTCATTGCAGGCTAACGTTGCA"
    pairs = spark.createDataFrame([(t[:18], t[6:][::-1].translate(str.maketrans("ACGT", "TGCA"))), ("A" * 18, "A" * 18)], "seq string, mate_seq string")
    got = mates.merge_pairs(pairs, 8).collect()
    assert (got[0]["merged"], got[0]["overlap"], got[0]["mismatches"]) == (t, 12, 0) and got[1]["merged"] is None
    assert mates.merge_pairs(pairs, 8, only_overlap=True).first()["merged"] == t[6:18] and mates.filter_merged(mates.merge_pairs(pairs, 8)).count() == 1
    halves = mates.split_halves(spark.createDataFrame([("r", "ACGT", "IIJJ"), ("x", "ACG", "III")], "read_id string, seq string, qual string"))
    assert sorted(map(tuple, halves.collect())) == [("r/1", "AC", "II"), ("r/2", "GT", "JJ")]
    assert tuple(mates.join_mates(halves.filter("read_id = 'r/1'"), halves.filter("read_id = 'r/2'")).first()) == ("r", "ACGT", "IIJJ")


def test_search_and_chimeras(spark):
    assert search.align("ACGTACGT", "ACGTACGT") == (100.0, "8M")
    identity, cigar = search.align("ACGTTTACGGACGA", "CCACGTTTACGACGACC")
    assert cigar == "2D8MI5M2D" and identity > 90
    left, right = "ACGTTGCAATCGGATCCAGT" * 2, "TGCAACGTTAGCCTAGGTCA" * 2
    mixed = left[:20] + right[20:]
    refs = spark.createDataFrame([("l", left, None), ("r", right, None)], "ref_id string, seq string, seq_count long")
    own = spark.createDataFrame([("q", mixed, 1), ("p", left, 9)], "read_id string, seq string, seq_count long")
    found = search.search(own, refs, k=6, least_shared=4, min_id=30.0)
    assert found.filter("read_id = 'p'").orderBy(F.desc("pct_id")).first()["ref_id"] == "l"
    got = {r["read_id"]: (r["chimeric"], r["cut"]) for r in search.find_chimeras(own, found, refs).collect()}
    assert got == {"q": (True, 20), "p": (False, 0)}
    # parents of other lengths, and near relatives of one of them
    assert search.aligned("ACGT", "CACTTG", "DMMIMD") == ["A", "C", "-", "T"] and search.aligned("AC", "AGC", "MDM") == ["A", "GC"]
    kin = [(f"k{i}", "".join("ACGT"["ACGT".index(c) ^ 1] if j in (3, 9 + i) else c for j, c in enumerate(left)), None) for i in range(6)]
    refs = spark.createDataFrame([("l", left, None), ("r", "GA" + right, None), *kin], "ref_id string, seq string, seq_count long")
    found = search.search(own, refs, k=6, least_shared=4, min_id=30.0)
    got = {r["read_id"]: (r["chimeric"], r["cut"]) for r in search.find_chimeras(own, found.drop("cigar"), refs).collect()}
    assert got == {"q": (True, 20), "p": (False, 0)} == {r["read_id"]: (r["chimeric"], r["cut"]) for r in search.find_chimeras(own, found, refs).collect()}


def test_search_aligns_all_that_share_kmers(spark):
    read = "ACGTTGCAATCGGATCCAGTTGACCATGGA"
    far = read[:15] + "A" * 16 + read[15:]  # shares more k-mers, but is rejected
    other = lambda c: "C" if c == "A" else "A"
    near = "".join(other(c) if i in (6, 13, 20) else c for i, c in enumerate(read))
    refs = [(f"a{i:02}", far) for i in range(11)] + [(f"b{i:02}", near) for i in range(12)] + [("c", read)]
    own = spark.createDataFrame([("q", read)], "read_id string, seq string")
    find = lambda **x: {r["ref_id"] for r in search.search(own, spark.createDataFrame(refs, "ref_id string, seq string"), k=6, least_shared=2, **x).collect()}
    assert find() == {"c", *(f"b{i:02}" for i in range(12))} == find(accepted=2) and find(accepted=1) == {"c"}


def test_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">r1 note one\nAC\nGT\n\n>r2\nGG\n# skip\n>r1 again\nTT\n")
    fa = fasta.with_comment(fasta.read_fasta(spark, str(tmp_path / "a.fa"), comments=True))
    assert [(r["id"], r["comment"], r["seq"]) for r in fa.orderBy("pos").collect()] == [("r1", "note one", "ACGT"), ("r2", "", "GG"), ("r1", "again", "TT")]
    assert setops.last_wins(fa.select("id", "pos", "seq"), "pos").filter("id = 'r1'").first()["seq"] == "TT"
    (tmp_path / "q.qual").write_text(">r1\n40 2\n3\n>r2 x\n7\n")
    assert {r["id"]: r["quals"] for r in fasta.read_qual(spark, str(tmp_path / "q.qual")).collect()} == {"r1": [40, 2, 3], "r2": [7]}
    assert fasta.count_records(spark, str(tmp_path / "a.fa")).first()["records"] == 3
    records = "".join(f"@M:1:F:1:1101:{i}:7 1:N:0:ACG\nACGT{'A' * (i % 3)}\n+\n@III{'I' * (i % 3)}\n" for i in range(50))
    (tmp_path / "x.fq").write_text(records)
    with gzip.open(tmp_path / "y.fq.gz", "wt") as f:
        f.write(records)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    got = fastq.read_fastq(spark, str(tmp_path / "*.fq*"), trim_to=4)
    assert got.count() == 100 and got.filter("seq = 'ACGT' and qual = '@III' and filter_flag = 'N' and pair_no = 1").count() == 100
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "bad.fastq").write_text("@a\nAC\n+\nI\n")
    assert fastq.read_fastq(spark, str(tmp_path / "bad.fastq"), strict=False).first()["error"].startswith("lengths differ")
    with pytest.raises(Exception, match="lengths differ"):
        fastq.read_fastq(spark, str(tmp_path / "bad.fastq")).collect()
    (tmp_path / "m.fastq").write_text("\n@a\nAC\nGT\n+a\n@I\nII\n@b\nA\n+x\nI\n")
    assert [(r["header"], r["seq"], r["qual"], r["error"]) for r in fastq.read_multiline_fastq(spark, str(tmp_path / "m.fastq")).collect()] == [("a", "ACGT", "@III", None), ("b", "A", "I", "no +")]
    sinks.write_fasta(fa.select("id", "seq"), str(tmp_path / "out"), wrap=2)
    assert fasta.read_fasta(spark, str(tmp_path / "out")).filter("seq = 'ACGT'").count() == 1
    sinks.write_fastq(got.select("header", "seq", "qual"), str(tmp_path / "out2"), compress=True)
    assert fastq.read_fastq(spark, str(tmp_path / "out2")).count() == 100
    sinks.write_demultiplexed(got.withColumns({"sample": F.lit(None).cast("string"), "pair": F.lit(1)}), str(tmp_path / "out3"))
    assert (tmp_path / "out3" / "sample=unknown" / "pair=1").exists()
    assert [r["path"].rpartition("/")[2] for r in fasta.find_files(spark, str(tmp_path), ".gz").filter("path like '%/y.fq.gz'").collect()] == ["y.fq.gz"]
    assert formats.parser_of("sff") == "sff-trim" and formats.parser_of("fastq-sanger") == "fastq"
    (tmp_path / "mbl.fa").write_text(">r1 x 3 y\nAC\n")
    mbl = formats.read_reads(spark, str(tmp_path / "mbl.fa"), "fasta-mbl").first()
    assert (mbl["read_id"], mbl["lane"], mbl["seq"]) == ("r1", "3", "AC")
    with pytest.raises(NotImplementedError):
        formats.read_reads(spark, "x", "sff")
    sinks.write_names(spark.createDataFrame([("a", ["a", "b"])], "rep_id string, ids array<string>"), str(tmp_path / "n"))
    assert tables.read_step_table(spark, str(tmp_path / "n"), "names").first()["ids"] == ["a", "b"]
    (tmp_path / "t.tax").write_text("refhvr_id\ttaxonomy\tcount\nr\tA;B\t3\n")
    assert tuple(tables.read_step_table(spark, str(tmp_path / "t.tax"), "ref_tax").first()) == ("r", "A;B", 3)
    (tmp_path / "m.csv").write_text("run,dataset,,\nr, d ,,\n")
    assert tables.read_metadata_csv(spark, str(tmp_path / "m.csv")).first().asDict() == {"run": "r", "dataset": "d"}


def test_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"sample":"s","read_id":1,"seq":"A"}\n{"sample":"s","read_id":2,"seq":"A"}\n')
    reads = spark.readStream.schema("sample string, read_id long, seq string").json(str(folder))
    runlog.ingest(reads, ["sample"], str(tmp_path / "sink"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sink")).first()["seq_count"] == 2


def test_config(spark, tmp_path):
    ini = config.parse_ini("[general]\nplatform = miseq\ncompressed = True\n[x]\na = 1\n")
    assert ini["general"] == {"platform": "miseq", "compressed": True}
    rules = {"general": {"platform": config.Option(True), "run": config.Option(True), "compressed": config.Option(test=lambda v: v == "False", required="no")}}
    assert len(config.check_ini(ini, rules)) == 3
    assert config.resolve({"a": 1, "run": 0}, {"a": 2}, {"run": 5, "b": None}, {"run": 7}) == {"a": 2, "run": 5}
    missing, extra = validate.header_differences(["run", "odd"], "miseq")
    assert "lane" in missing and extra == {"odd"} and len(validate.HEADERS["454"]) == 29
    (tmp_path / "p.json").write_text(json.dumps({"s": {"n": {"domain": "bacteria", "region": "v6", "direction": "f", "sequence": "AC"}}}))
    assert primers.load_primers(str(tmp_path / "p.json"))["s"][0].direction == "F"
    (tmp_path / "a.json").write_text(json.dumps({"x": {"reversed": "True", "start": 3, "freedom": 1, "length": 4, "sequence": "AC[T,G]A"}}))
    assert primers.load_anchors(str(tmp_path / "a.json"))["x"].reversed
    s = spark.createDataFrame([("Water ",)], "env_sample_source string")
    assert validate.env_source_ids(s, spark.createDataFrame([(9, "water")], "env_sample_source_id int, env_source_name string")).first()["env_sample_source_id"] == 9
