"""All queries of the read-analytics operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import sequence as S
from ..operators import chimera, consensus, derep, filters, hits, mates, merge, names, primers, qc, rollup, search, setops, trim, validate, warehouse
from ..sources import sinks, tables
from ..sources.shared import Workspace
from . import views as V
from .registration import ORACLE, QUERIES, query

R, H, T, A, C = V.READS, V.HITS, V.REF_TAX, V.ASSIGNED, V.CHECKED

# ---- dereplication


@query("select sample, md5(seq) as seq_md5, min(read_id) as rep_id, count(*) as seq_count from reads group by sample, seq", R)
def derep_by_sample(spark, sf):
    return derep.counts(V.reads(spark, sf), ["sample"]).select("sample", F.md5("seq").alias("seq_md5"), "rep_id", "seq_count")


@query("""select sample, rep_id, seq_count, row_number() over (partition by sample order by seq_count desc, rep_id) as abundance_rank
  from (select sample, min(read_id) as rep_id, count(*) as seq_count from reads where length(seq) >= 75 group by sample, seq)""", R)
def abundance_rank(spark, sf):
    passed = V.reads(spark, sf).filter(F.length("seq") >= 75)
    return derep.abundance_rank(derep.counts(passed, ["sample"]), ["sample"]).select("sample", "rep_id", "seq_count", "abundance_rank")


@query("select sample, min(read_id) as rep_id, string_agg(cast(read_id as varchar), ',' order by read_id) as ids, count(*) as seq_count from reads group by sample, seq", R)
def names_by_sample(spark, sf):
    ids = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return derep.dereplicate(V.reads(spark, sf), ["sample"]).select("sample", "rep_id", ids.alias("ids"), "seq_count")


@query("select sha1(upper(seq)) as hash, min(read_id) as rep_id, count(*) as seq_count from reads group by 1", R)
def unique_by_hash(spark, sf):
    return derep.unique_by_hash(V.reads(spark, sf)).select("hash", "rep_id", "seq_count")


@query("select cast(min(read_id) as varchar) || '|frequency:' || cast(count(*) as varchar) as id from reads group by sample, seq", R)
def unique_deflines(spark, sf):
    return derep.counts(V.reads(spark, sf), ["sample"]).select(derep.defline(F.col("rep_id").cast("string"), F.col("seq_count").cast("string")).alias("id"))


@query("select sample, length(seq) as length, count(*) as reads from reads group by all", R)
def length_histogram(spark, sf):
    return derep.weighted_lengths(V.reads(spark, sf), ["sample"])


@query("select sample, count(*) as reads, min(length(seq)) as min_length, max(length(seq)) as max_length, cast(sum(length(seq)) as double) / count(*) as mean_length, round(stddev_pop(length(seq)), 6) as std_length from reads group by sample", R)
def length_summary(spark, sf):
    return derep.length_summary(V.reads(spark, sf), ["sample"]).withColumn("std_length", F.round("std_length", 6))


# ---- scalar functions


@query("""select read_id, md5(reverse(translate(seq, 'ACGTRYMK', 'TGCAYRKM'))) as rc, md5(translate(seq, 'ACGT', 'TGCA')) as comp,
  md5(translate(reverse(seq), 'ATCGN.', 'TAGCNN')) as strict_rc, md5(replace(seq, 'T', 'U')) as rna, length(seq) - length(replace(seq, 'N', '')) as n_count,
  md5(rtrim(seq, 'N')) as no_trailing_n, not contains(lower(seq), 'u') as dna from reads""", R)
def sequence_functions(spark, sf):
    s = F.col("seq")
    return V.reads(spark, sf).select(
        "read_id", F.md5(S.revcomp(s)).alias("rc"), F.md5(S.complement(s)).alias("comp"), F.md5(S.revcomp_strict(s)).alias("strict_rc"), F.md5(S.to_rna(s)).alias("rna"),
        S.count_of(s).alias("n_count"), F.md5(S.strip_trailing_n(s)).alias("no_trailing_n"), S.is_dna(s).alias("dna"),
    )


@query("""select read_id, split_part(header, ':', 4) as lane, split_part(header, ':', 5) as tile, split_part(split_part(header, ':', 7), ' ', 1) as y,
  cast(split_part(split_part(header, ':', 7), ' ', 2) as bigint) as pair_no, split_part(header, ':', 8) as filter_flag, split_part(header, ':', 10) as index_seq,
  split_part(header, ' ', 1) || ' 2:' || substr(split_part(header, ' ', 2), 3) as mate from reads""", R)
def header_fields(spark, sf):
    h = S.illumina_header(F.col("header"))
    return V.reads(spark, sf).select("read_id", *[h[k].alias(k) for k in ("lane", "tile", "y", "pair_no", "filter_flag", "index_seq")], S.mate_header(F.col("header")).alias("mate"))


@query("""select read_id, substr(seq, 1, 6) || '_' || substr(seq, 1, 5) || '_' || lane as plain_key, substr(seq, 1, 6) || '_NNNN' || substr(seq, 5, 5) || '_1' as inline_key,
  replace(replace(replace(lower(sample), '_', ''), '-', ''), ' ', '') as suite, upper(substr(sample, 1, 1)) || substr(sample, 2) as project from reads""", R)
def demux_keys(spark, sf):
    i, s = F.substring("seq", 1, 6), F.col("seq")
    return V.reads(spark, sf).select("read_id", S.demux_key(i, s, F.col("lane")).alias("plain_key"), S.demux_key(i, s, F.col("lane"), True, True).alias("inline_key"), S.normalize_suite(F.col("sample")).alias("suite"), S.capitalize(F.col("sample")).alias("project"))


@query("""select read_id, case when starts_with(seq, 'TA') then 'TA' when starts_with(seq, 'A') then 'A' when starts_with(seq, 'GT') then 'GT' end as run_key,
  md5(case when starts_with(seq, 'TA') then substr(seq, 3) when starts_with(seq, 'A') then substr(seq, 2) when starts_with(seq, 'GT') then substr(seq, 3) else seq end) as rest from reads""", R)
def run_keys(spark, sf):
    key = S.first_prefix(F.col("seq"), ["TA", "A", "GT"])
    return V.reads(spark, sf).select("read_id", key.alias("run_key"), F.md5(S.without_prefix(F.col("seq"), key)).alias("rest"))


@query("""select read_id, substr(seq, 3, 10) as cut, case when length(seq) > 4 then right(seq, 4) else seq end as tail, contains(seq, 'ACGT') as has,
  md5(case when strpos(seq, 'ACG') > 0 then substr(seq, 1, strpos(seq, 'ACG') - 1) || substr(seq, strpos(seq, 'ACG') + 3) else seq end) as subtracted,
  case when contains(seq, 'ACG') then length(seq) - 3 - strpos(reverse(seq), 'GCA') + 1 else -1 end as last_at from reads""", R)
def slices(spark, sf):
    s = F.col("seq")
    return V.reads(spark, sf).select(
        "read_id", S.cut(s, 2, 12).alias("cut"), S.cut(s, -4).alias("tail"), F.contains(s, F.lit("ACGT")).alias("has"),
        F.md5(S.subtract_first(s, F.lit("ACG"))).alias("subtracted"), S.last_position(s, F.lit("ACG")).alias("last_at"),
    )


@query("""select ref_id, len(string_split(taxonomy, ';')) - 1 as depth, string_split(taxonomy, ';')[2] as phylum,
  array_to_string([coalesce(string_split(taxonomy, ';')[i], ['superkingdom','phylum','class','order','family','genus','species','strain'][i] || '_NA') for i in range(1, 9)], ';') as padded from ref_tax""", T)
def lineages(spark, sf):
    names = S.lineage(F.col("taxonomy"))
    return V.ref_tax(spark, sf).select("ref_id", S.depth(names).alias("depth"), S.rank_of(names, "phylum").alias("phylum"), F.array_join(S.pad_lineage(names), ";").alias("padded"))


@query("""select p_partkey, levenshtein(p_brand, p_type) as edits from part""")
def edit_distances(spark, sf):
    return V.table(spark, sf, "part").select("p_partkey", S.edit_distance(F.col("p_brand"), F.col("p_type")).alias("edits"))


@query("""select o_orderkey, o_orderpriority || '|frequency:' || cast(o_custkey as varchar) as defline, o_orderpriority || ';size=' || cast(o_custkey as varchar) as sized, o_custkey as frequency from orders""")
def deflines(spark, sf):
    d = F.concat("o_orderpriority", F.lit("|frequency:"), F.col("o_custkey").cast("string"))
    return V.table(spark, sf, "orders").select("o_orderkey", d.alias("defline"), S.size_defline(d).alias("sized"), S.frequency(d).alias("frequency"))


# ---- quality


_SCORE = "case c when 'I' then 40 when '5' then 20 when '?' then 30 when '#' then 2 when '!' then 0 end"


@query(f"""select read_id, min(s) as q_min, cast(sum(s) as double) / count(*) as q_mean, round(sqrt(greatest(cast(sum(s * s) as double) / count(*) - (cast(sum(s) as double) / count(*)) * (cast(sum(s) as double) / count(*)), 0.0)), 6) as q_std
  from (select read_id, {_SCORE} as s from (select read_id, unnest(string_split(qual, '')) as c from reads where length(qual) > 0)) group by read_id""", R)
def phred_stats(spark, sf):
    q = Q.scores(F.col("qual"))
    return V.reads(spark, sf).filter("length(qual) > 0").select("read_id", Q.q_min(q).alias("q_min"), Q.q_mean(q).alias("q_mean"), F.round(Q.q_std(q), 6).alias("q_std"))


@query("select read_id, md5(translate(seq, 'ACGTN', 'hT^B@')) as illumina, md5(repeat('~', length(seq))) as fake from reads", R)
def reencoded(spark, sf):
    return V.reads(spark, sf).select("read_id", F.md5(Q.reencode(F.col("qual"), "sanger", "illumina")).alias("illumina"), F.md5(Q.fake_quality(F.col("seq"))).alias("fake"))


@query("""select q as phred, case when q <= 0 then -5 else cast(round(10 * log10(pow(10.0, q / 10.0) - 1)) as bigint) end as to_solexa,
  cast(round(10 * log10(pow(10.0, q / 10.0) + 1)) as bigint) as from_solexa from (select distinct cast(l_quantity as bigint) - 5 as q from lineitem)""")
def solexa_scores(spark, sf):
    q = V.table(spark, sf, "lineitem").select((F.col("l_quantity").cast("long") - 5).alias("phred")).distinct()
    return q.select("phred", Q.phred_to_solexa(F.col("phred")).alias("to_solexa"), Q.solexa_to_phred(F.col("phred")).alias("from_solexa"))


# ---- filters


@query("""select read_id, case when split_part(header, ':', 8) = 'Y' then 'chastity' when length(seq) - length(replace(seq, 'N', '')) >= 1 then 'ambiguous'
  when length(substr(qual, 1, 50)) - length(replace(replace(replace(substr(qual, 1, 50), '5', ''), '#', ''), '!', '')) >= 34 then 'first_50'
  when length(seq) < 75 then 'short' end as fail_reason from reads""", R)
def illumina_filter(spark, sf):
    df = trim.with_scores(V.reads(spark, sf)).withColumn("filter_flag", S.illumina_header(F.col("header"))["filter_flag"])
    return filters.illumina_filter(df).select("read_id", "fail_reason")


@query("""select read_id, case when five > three then '' else substr(seq, five, three - five + 1) end as seq_trimmed from (
  select read_id, seq, case when regexp_matches(qual, '[I?]') then length(regexp_extract(qual, '^[^I?]*')) + 1 else length(qual) + 1 end as five,
  length(seq) - length(regexp_extract(qual, '[^I?]*$')) as three from (select read_id, seq, qual from reads))""", R)
def quality_trimmed(spark, sf):
    df = trim.with_scores(V.reads(spark, sf)).select("read_id", "seq", "scores")
    return filters.trim_ends(df, threshold=30).select("read_id", F.col("seq").alias("seq_trimmed"))


_TALL = f"tall as (select read_id, seq, i, {_SCORE} as s from (select read_id, seq, unnest(string_split(qual, '')) as c, generate_subscripts(string_split(qual, ''), 1) as i from reads where length(qual) > 0))"


@query("""select r.read_id, md5(case when five is null or last is null then '' else substr(r.seq, cast(five as bigint), cast(last - five + 1 as bigint)) end) as kept from reads r left join (
  select read_id, any_value(five) as five, max(i) filter (back >= 28 and i - five >= 4 and (n - i) % 2 = 0) as last from (select *, min(i) filter (ahead >= 28 and i % 2 = 1) over (partition by read_id) as five, max(i) over (partition by read_id) as n from (
    select read_id, i, avg(s) over (partition by read_id order by i rows between current row and 4 following) as ahead, avg(s) over (partition by read_id order by i rows between 4 preceding and current row) as back from tall)) group by read_id) t on t.read_id = r.read_id""", R, _TALL)
def quality_windows(spark, sf):
    df = trim.with_scores(V.reads(spark, sf)).select("read_id", "seq", "scores")
    return filters.trim_ends(df, window=5, step=2, agg="mean", threshold=28).select("read_id", F.md5("seq").alias("kept"))


@query("""select r.read_id, md5(case when five is null or last is null then '' else substr(r.seq, cast(five as bigint), cast(last - five + 1 as bigint)) end) as kept from reads r left join (
  select read_id, any_value(five) as five, max(i) filter (back <= 1 and i - five >= 3) as last from (select *, min(i) filter (ahead <= 1 or n - i < 1) over (partition by read_id) as five from (
    select read_id, i, max(i) over (partition by read_id) as n, count_if(s < 20) over (partition by read_id order by i rows between current row and 3 following) as ahead, count_if(s < 20) over (partition by read_id order by i rows between 3 preceding and current row) as back from tall)) group by read_id) t on t.read_id = r.read_id""", R, _TALL)
def quality_windows_but_one(spark, sf):
    """Windows of four whose lowest score, one place left out, is 20 or more; what is left of a window of one is empty and passes."""
    df = trim.with_scores(V.reads(spark, sf)).select("read_id", "seq", "scores")
    return filters.trim_ends(df, window=4, agg="min", exclude=1, threshold=20).select("read_id", F.md5("seq").alias("kept"))


@query("""select read_id, case when split_part(header, ':', 8) = 'Y' then 'chastity' when n > 1 or (n = 1 and substr(seq, 40, 1) <> 'N') then 'ambiguous' when low >= 34 then 'first_50' when length(seq) < 75 then 'short' end as fail_reason
  from (select *, length(seq) - length(replace(seq, 'N', '')) as n, length(substr(qual, 1, 50)) - length(replace(replace(replace(substr(qual, 1, 50), '5', ''), '#', ''), '!', '')) as low from (
    select read_id, header, overlay as seq, translate(overlay, 'ACGTN', 'I5?#!') as qual from (select *, replace(substr(seq, 1, 39), 'N', 'A') || 'N' || replace(substr(seq, 41), 'N', case when read_id % 2 = 0 then 'C' else 'N' end) as overlay from reads)))""", R)
def illumina_filter_one_n(spark, sf):
    """Reads with an N at place 40, which is allowed, and every second one with more."""
    rest = F.when(F.col("read_id") % 2 == 0, F.replace(F.expr("substring(seq, 41)"), F.lit("N"), F.lit("C"))).otherwise(F.expr("substring(seq, 41)"))
    df = V.reads(spark, sf).withColumn("seq", F.concat(F.replace(F.substring("seq", 1, 39), F.lit("N"), F.lit("A")), F.lit("N"), rest))
    df = trim.with_scores(df.withColumn("qual", F.translate("seq", *V.QUALITY))).withColumn("filter_flag", S.illumina_header(F.col("header"))["filter_flag"])
    return filters.illumina_filter(df, n_at=40).select("read_id", "fail_reason")


@query("""select read_id, md5(case when length(seq) > 3 then substr(seq, 5, greatest(length(seq) - 7, 0)) else substr(seq, 5) end) as clipped from reads""", R)
def clipped(spark, sf):
    return filters.clip(trim.with_scores(V.reads(spark, sf)), 4, 3).select("read_id", F.md5("seq").alias("clipped"))


# ---- primers and trimming

_SUITE = primers.PrimerSuite((("TAAG", "p1"), ("AG", "p2"), ("GT", "p3"), ("A", "p4"), ("C", "p5")), (("TTTCAGG", "d1"), ("GGAAC", "d2")))


def _near(body: str, suite: primers.PrimerSuite = _SUITE) -> str:
    cases = " ".join(f"when strpos({body}, '{s}') in (1, 2) then '{s}'" for s, _ in suite.proximal)
    return f"case {cases} else '' end"


def _far(body: str, suite: primers.PrimerSuite = _SUITE) -> str:
    tries = [s[:k] for s, _ in suite.distal for k in range(len(s), min(len(s), 5) - 1, -1)]
    cases = " ".join(f"when contains({body}, '{t}') then '{t}'" for t in tries)
    return f"case {cases} else '' end"


@query(f"""select read_id, primer, md5(case when primer = '' then seq else substr(seq, strpos(seq, primer) + length(primer)) end) as rest from (select read_id, seq, {_near('seq')} as primer from reads)""", R)
def trim_proximal(spark, sf):
    x = primers.trim_proximal(F.col("seq"), _SUITE.proximal)
    return V.reads(spark, sf).withColumn("x", x).select("read_id", "x.primer", F.md5("x.seq").alias("rest"))


@query(f"""select read_id, primer, md5(case when primer = '' then seq else substr(seq, 1, length(seq) - length(primer) - strpos(reverse(seq), reverse(primer)) + 1) end) as kept
  from (select read_id, seq, {_far('seq')} as primer from reads)""", R)
def trim_distal(spark, sf):
    x = primers.trim_distal(F.col("seq"), _SUITE.distal)
    return V.reads(spark, sf).withColumn("x", x).select("read_id", "x.primer", F.md5("x.seq").alias("kept"))


@query("""select read_id, coalesce(hit.primer, '') as primer, coalesce(hit.place, -1) as "at", hit.edits as edits from (
  select read_id, min(case when d <= 3 then {'edits': d, 'back': -place, 'k': k, 'primer': primer, 'place': place} end) as hit from (
    select read_id, primer, k, place, case when place is not null then levenshtein(substr(seq, place + 1, length(primer)), primer) end as d from (
      select read_id, seq, primer, k, unnest(list_concat([null], list_filter(range(0, length(seq) - length(primer) + 1), lambda i: substr(seq, i + 1, 2) = substr(primer, 1, 2)))) as place
      from reads cross join (values ('TTTCAGG', 0), ('GGAAC', 1)) as p (primer, k)))
  group by read_id)""", R)
def fuzzy_distal(spark, sf):
    x = primers.trim_fuzzy_distal(F.col("seq"), _SUITE.distal)
    return V.reads(spark, sf).withColumn("x", x).select("read_id", "x.primer", "x.at", "x.edits")


@query("select o_orderkey, o_totalprice from (select *, row_number() over (order by o_orderkey) as p from orders) where p between 101 and 900")
def position_range(spark, sf):
    return setops.position_range(V.table(spark, sf, "orders"), 101, 900, "o_orderkey").select("o_orderkey", "o_totalprice")


_KEYS = ("TAA", "GTT", "TA", "A")
_KEY_SQL = "case " + " ".join(f"when starts_with(seq, '{k}') then '{k}'" for k in _KEYS) + " end"


def _trim(spark, sf, suite=_SUITE, direction="F"):
    reads = V.reads(spark, sf)
    keys = F.explode(F.array(*[F.lit(k) for k in _KEYS if k != "GTT"]))
    samples = reads.select("lane").distinct().select("lane", keys.alias("run_key"))
    samples = samples.select("run_key", "lane", F.concat("lane", F.lit("-"), "run_key").alias("sample"), F.when(F.expr(_IS_ODD), "b").otherwise("a").alias("suite"), F.when(F.expr(_IS_ODD), "R").otherwise("F").alias("direction"))
    params = trim.TrimParams(max_length=4000, max_n=20, min_quality=22, run_keys=_KEYS, offset=33)
    return trim.trim_reads(reads.drop("sample"), samples, suite, direction, params)


_CHAIN = f"""chain as (select read_id, lane, run_key, lane || '-' || case when run_key <> 'GTT' then run_key end as sample, trimmed as trimmed_seq, exact_left, exact_right, near, strpos(body, near) as near_at, reason from (
  select *, case when run_key is null then 'Runkey' when run_key = 'GTT' then 'Lanekey' else coalesce(
      case when length(t) = 0 then 'No Insert' when length(t) < 50 then 'Minimum Length' when length(t) > 4000 then 'Maximum Length' end,
      case when not short and far = '' then 'Distal' end, case when short then 'Minimum Length' end, case when near = '' then 'Proximal' end,
      case when length(seq) - length(replace(seq, 'N', '')) > 20 then 'N' end,
      case when (40.0::double * (length(w) - length(replace(w, 'I', ''))) + 20.0 * (length(w) - length(replace(w, '5', ''))) + 30.0 * (length(w) - length(replace(w, '?', ''))) + 2.0 * (length(w) - length(replace(w, '#', '')))) / length(t) < 22 then 'Quality' end) end as reason,
    case when run_key is null or run_key = 'GTT' then seq else t end as trimmed, case when run_key <> 'GTT' then near end as exact_left, case when run_key <> 'GTT' then case when short then '' else far end end as exact_right
  from (select *, substr(qual, strpos(seq, t), length(t)) as w from (select *, case when short or far = '' then one else substr(one, 1, length(one) - length(far) - strpos(reverse(one), reverse(far)) + 1) end as t
    from (select *, @FAR as far, length(one) < 50 as short from (select *, case when near = '' then body else substr(body, strpos(body, near) + length(near)) end as one
      from (select *, @NEAR as near from (select *, coalesce(substr(seq, length(run_key) + 1), seq) as body from (select *, {_KEY_SQL} as run_key from reads)))))))))"""
_PLAIN_CHAIN = _CHAIN.replace("@FAR", _far("one")).replace("@NEAR", _near("body"))


@query("select read_id, run_key, sample, md5(trimmed_seq) as trimmed, exact_left, exact_right, reason is not null as deleted, reason as delete_reason from chain", R, _PLAIN_CHAIN)
def trim_chain(spark, sf):
    return _trim(spark, sf).select("read_id", "run_key", "sample", F.md5("trimmed").alias("trimmed"), "exact_left", "exact_right", "deleted", "delete_reason")


@query("select lane, coalesce(reason, 'passed') as reason, count(*) as reads from chain group by all", R, _PLAIN_CHAIN)
def trim_reasons(spark, sf):
    return trim.reason_counts(_trim(spark, sf), ["lane"])


@query("select lane, run_key, min(read_id) as rep_id, count(*) as reads from chain where reason is null group by lane, run_key, trimmed_seq", R, _PLAIN_CHAIN)
def trim_names(spark, sf):
    found = trim.trim_outputs(_trim(spark, sf), ["lane", "run_key"], only=("names",))["names"]
    return found.groupBy("lane", "run_key", "rep_id").agg(F.sum(F.size("ids")).alias("reads"))


@query("""select counter, reads from (select unnest(['raw', 'passed', 'deleted', 'bases']) as counter, unnest([count(*), count(*) filter (reason is null), count(reason), coalesce(sum(case when reason is null then length(trimmed_seq) end), 0)::bigint]) as reads from chain)
  union all select name, count(reason) from (select unnest(['Runkey', 'Lanekey', 'Proximal', 'Distal', 'N', 'Quality', 'No Insert', 'Minimum Length', 'Maximum Length']) as name) left join chain on reason = name group by name""", R, _PLAIN_CHAIN)
def trim_counters(spark, sf):
    """What is counted while trimmed reads are written: the chain runs once, here, and its totals are the result."""
    found = trim.write_counted(_trim(spark, sf), Workspace(spark, "counted").path("trimmed"))
    return spark.createDataFrame(list(found.items()), "counter string, reads long")


@query("select lane, run_key, count(distinct trimmed_seq) as uniques from chain where reason is null group by lane, run_key", R, _PLAIN_CHAIN)
def trim_uniques(spark, sf):
    return trim.trim_outputs(_trim(spark, sf), ["lane", "run_key"], only=("unique_counts",))["unique_counts"]


@query("""select cast(rep_id as varchar) as rep_id, chunk - min(chunk) over (partition by sample, hash) as block, ids from (select sample, hash, chunk, any_value(rep_id) as rep_id, string_agg(cast(read_id as varchar), ',' order by n) as ids from (
  select sample, sha1(seq) as hash, read_id, row_number() over all_reads as n, (row_number() over all_reads - 1) // 3 as chunk, min(read_id) over (partition by sample, sha1(seq)) as rep_id from reads
  window all_reads as (order by sample nulls first, sha1(seq) nulls first, read_id)) group by all)""", R)
def name_blocks(spark, sf):
    """Names in blocks of three ids at most, written as lines and read back."""
    path = Workspace(spark, "names").path("blocks")
    sinks.write_name_blocks(names.name_blocks(V.reads(spark, sf), ["sample"], size=3), path)
    return tables.read_step_table(spark, path, "name_blocks").select("rep_id", "block", F.array_join("ids", ",").alias("ids"))


@query("""select min(read_id) over (partition by sample, seq) as rep_id, read_id from reads where read_id % 3 <> 0""", R)
def clean_name_blocks(spark, sf):
    """Names in blocks without every third read, a row for each read with its new representative."""
    own = V.reads(spark, sf)
    left = names.clean_blocks(names.name_blocks(own, ["sample"], size=2), own.filter("read_id % 3 = 0"), ["sample"])
    return names.members_of(left, ["sample"]).select("rep_id", "read_id")


@query("select lane, read_id, reason as delete_reason from chain where reason not in ('Runkey', 'Lanekey')", R, _PLAIN_CHAIN)
def trim_deleted(spark, sf):
    return trim.trim_outputs(_trim(spark, sf), ["lane"], only=("deleted",))["deleted"]


_OTHER = primers.PrimerSuite.build([primers.Primer("f", "bacteria", "v6", "F", "RT"), primers.Primer("r", "bacteria", "v6", "R", "CCTWAG")], "R")
_IS_ODD = "lane in ('en', 'fr')"


@query(f"""select read_id, lane || '_' || case when run_key <> 'GTT' then run_key end as idx_key, md5(case when coalesce(run_key, 'GTT') <> 'GTT' and {_IS_ODD} then reverse(translate(trimmed_seq, 'ACGTRYMK', 'TGCAYRKM')) else trimmed_seq end) as trimmed,
  exact_left, exact_right, case when exact_left = '' then '' when exact_left is not null then '+' end as orientation, case when exact_left is null then null when exact_left = '' then '' when near_at = 2 then 'offset ' when {_IS_ODD} then 'r' else map {{'TAAG': 'p1', 'AG': 'p2', 'GT': 'p3', 'A': 'p4', 'C': 'p5'}}[exact_left] end as primer_name, reason as delete_reason from chain""",
  R, _CHAIN.replace("@FAR", f"case when {_IS_ODD} then {_far('one', _OTHER)} else {_far('one')} end").replace("@NEAR", f"case when {_IS_ODD} then {_near('body', _OTHER)} else {_near('body')} end"))
def trim_by_sample(spark, sf):
    """Samples with suites and directions of their own, trimmed in one pass."""
    df = _trim(spark, sf, {"a": _SUITE, "b": _OTHER}, None)
    return df.select("read_id", "idx_key", F.md5("trimmed").alias("trimmed"), "exact_left", "exact_right", "orientation", "primer_name", "delete_reason")


@query("""select read_id, case when place is not null then 'GTAAG' end as sequence, place - 1 as start, place + 4 as "end", length(case when place is null then seq else substr(seq, 1, place + 4) end) as kept
  from (select *, list_filter([41, 42, 40, 43, 39, 44, 38], lambda x: substr(seq, x, 5) = 'GTAAG')[1] as place from reads)""", R)
def anchor_exact(spark, sf):
    found = primers.find_anchor(F.col("seq"), primers.Anchor("a", False, 40, 3, 5, "GTAAG"), fuzzy=False)
    df = V.reads(spark, sf).withColumn("found", found)
    return df.select("read_id", "found.sequence", "found.start", "found.end", F.length(primers.trim_anchor(F.col("seq"), F.col("found"), False)).alias("kept"))


@query("""select read_id, md5(case when place is null then seq else substr(seq, 1, place - 1) end) as kept from (
  select *, coalesce(list_filter(range(9, 14), lambda x: substr(seq, x, 2) = 'GT')[1], list_filter(range(9, 14), lambda x: substr(seq, x, 3) in ('CAA', 'CAG'))[1]) as place from reads)""", R)
def stop_trim(spark, sf):
    kept = primers.trim_stop(F.col("seq"), ("GT", "CAR"), 8, 13)
    return V.reads(spark, sf).select("read_id", F.md5(kept).alias("kept"))


@query("""select read_id, sequence, start, start + 4 as "end", length(case when start is null then seq else substr(seq, greatest(length(seq) + start, 0) + 1) end) as kept from (
  select *, f[1].sequence as sequence, f[1].start as start from (
    select *, list_sort(list_filter(list_transform(range(0, 21), lambda k: {'sequence': substr(seq, greatest(length(seq) - s(k), 0) + 1, greatest(greatest(length(seq) - s(k) + 4, 0) - greatest(length(seq) - s(k), 0), 0)), 'k': k, 'start': -s(k)}),
      lambda x: x.sequence in ('GTAA', 'GTGA'))) as f from reads))""".replace("s(k)", "(30 + (case when k % 2 = 1 then (k + 1) // 2 else -(k // 2) end))"), R)
def anchor_reversed(spark, sf):
    """An anchor whose windows count back from the read's end; the read is kept from the anchor on."""
    anchor = primers.Anchor("a", True, 30, 10, 4, "GTRA")
    df = V.reads(spark, sf).withColumn("found", primers.find_anchor(F.col("seq"), anchor, fuzzy=False))
    return df.select("read_id", "found.sequence", "found.start", "found.end", F.length(primers.trim_anchor(F.col("seq"), F.col("found"), True)).alias("kept"))


@query("""select read_id, coalesce(hit.primer, '') as primer, md5(case when hit is null then seq else substr(seq, 1, length(seq) - length(hit.primer) - instr(reverse(seq), reverse(hit.primer)) + 1) end) as kept from (
  select read_id, seq, min(case when contains(seq, word) then {'k': k, 'less': -length(word), 'primer': word} end) as hit from reads cross join (
    select n_nationkey as k, substr(p, 1, n) as word from (select n_nationkey, p, unnest(range(least(5, length(p)), length(p) + 1)) as n from (
      select n_nationkey, regexp_replace(translate(n_name || r_name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', '', 'g') as p from nation join region on n_regionkey = r_regionkey)))
  group by read_id, seq)""", R)
def primer_panel(spark, sf):
    """Far primers from the names of nations and regions, all in one pass: some hundred words with their prefixes."""
    names = V.table(spark, sf, "nation").join(V.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    bases = F.regexp_replace(F.translate(F.concat("n_name", "r_name"), V.LETTERS.upper(), ("ACGT" * 7)[:26]), "[^ACGT]", "")
    panel = [(r["p"], r["n_name"]) for r in names.select("n_nationkey", "n_name", bases.alias("p")).orderBy("n_nationkey").collect()]  # 25 nations
    x = primers.trim_distal(F.col("seq"), panel)
    return V.reads(spark, sf).withColumn("x", x).select("read_id", "x.primer", F.md5("x.seq").alias("kept"))


@query()
def anchor_trim(spark, sf):
    anchor = primers.Anchor("a", False, 40, 6, 9, "G[T,G]AG.AAGT")
    found = primers.find_anchor(F.col("seq"), anchor, least=0.85)
    df = V.reads(spark, sf).withColumn("found", found)
    return df.select("read_id", "found.sequence", "found.start", "found.end", F.length(primers.trim_anchor(F.col("seq"), F.col("found"), False)).alias("kept"))


@query("select read_id, md5(regexp_replace(seq, '^TAA[AG]T{0,2}', '')) as rest from reads", R)
def inline_primers(spark, sf):
    return V.reads(spark, sf).select("read_id", F.md5(primers.strip_inline(F.col("seq"), "TAA", primers.primer_regex("RT*"))).alias("rest"))


# ---- hits and taxonomy

_TOP = "top as (select *, floor(10 * (100 - pct_id) + 0.5) / 1000 as distance from (select *, rank() over (partition by read_id order by pct_id desc) as place from hits where cast(regexp_extract(cigar, '([0-9]+)D', 1) as int) <= 10) where place = 1)"


@query("select read_id, ref_id, pct_id, distance from top", H, _TOP)
def tophit_ties(spark, sf):
    return hits.top_hits(V.hits(spark, sf)).select("read_id", "ref_id", "pct_id", "distance")


@query("select read_id, ref_id, cigar, cast(regexp_extract(cigar, '([0-9]+)D', 1) as int) > 10 as large_gap from hits", H)
def gap_filter(spark, sf):
    return V.hits(spark, sf).select("read_id", "ref_id", "cigar", hits.has_large_gap(F.col("cigar")).alias("large_gap"))


@query("select o_orderkey as read_id, '0' as ref_id, 1.0::double as distance from orders where o_orderkey not in (select read_id from top)", H, _TOP)
def nonhits(spark, sf):
    names = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("read_id"))
    return hits.without_hits(names, hits.top_hits(V.hits(spark, sf))).select("read_id", "ref_id", "distance")


@query("select read_id, max_by(distance, ref_id) as distance, string_agg(cast(ref_id as varchar), ' ' order by ref_id) as refs from top group by read_id", H, _TOP)
def concat_refs(spark, sf):
    refs = F.array_join(F.transform("ref_ids", lambda x: x.cast("string")), " ")
    return hits.concat_refs(hits.top_hits(V.hits(spark, sf))).select("read_id", "distance", refs.alias("refs"))


_GROUPS = "grp as (select o_custkey, min(o_orderkey) as rep_id, count(*) as n from orders group by o_custkey)"


@query("""select read_id, ref_id, pct_id from hits where read_id in (select rep_id from grp) union all
  select o_orderkey, ref_id, pct_id from hits join grp on read_id = rep_id join orders using (o_custkey) where o_orderkey <> rep_id""", H, _GROUPS)
def hit_expand(spark, sf):
    o = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("read_id"), F.col("o_custkey").alias("seq"))
    names = derep.members(o, [])
    own = V.hits(spark, sf).select("read_id", "ref_id", "pct_id")
    return hits.expand_to_duplicates(own.join(names.select(F.col("rep_id").alias("read_id")).distinct(), "read_id", "left_semi"), names)


@query("select o_orderkey as read_id, ref_id, distance, taxonomy, n from orders left join top on o_orderkey = read_id left join ref_tax using (ref_id)", H, T, _TOP)
def reads_to_references(spark, sf):
    names = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("read_id"))
    return hits.reads_to_references(names, hits.top_hits(V.hits(spark, sf)), V.ref_tax(spark, sf)).select("read_id", "ref_id", "distance", "taxonomy", "n")


_CONSENSUS = """
 l as (select read_id, taxonomy, n from hits join ref_tax using (ref_id)),
 tall as (select read_id, n, lv as level, coalesce(string_split(taxonomy, ';')[lv + 1], 'NA') as name from l, (select unnest(range(0, 7)) as lv)),
 tally as (select read_id, level, name, sum(n) as tally from tall group by all),
 rk as (select read_id, level, sum(tally) as total, coalesce(max(tally) filter (name <> 'NA'), 0) as top,
   arg_max(name, (tally, name)) filter (name <> 'NA') as best, count(*) filter (name <> 'NA') as names, coalesce(sum(tally) filter (name = 'NA'), 0) as na from tally group by all),
 pc as (select *, floor(100 * top / total) as pct, floor(100 * na / total) as na_vote from rk),
 dn as (select *, coalesce(bool_or(pct < 66) over (partition by read_id order by level rows between unbounded preceding and 1 preceding), false) as done from pc)
"""


@query("""select read_id, coalesce(string_agg(case when done then null when pct >= 66 then best when na_vote >= 66 then 'NA' end, ';' order by level), 'Unknown') as taxonomy,
  cast(coalesce(arg_max(pct, level) filter (not done and pct >= 66), 0) as bigint) as vote,
  ['domain', 'phylum', 'class', 'order', 'family', 'genus', 'species'][max(level) filter (names > 0) + 1] as minrank,
  string_agg(cast(names as varchar), ';' order by level) as taxa_counts, string_agg(cast(cast(floor(100 * top / total + 0.5) as bigint) as varchar), ';' order by level) as max_pcts,
  string_agg(cast(cast(floor(100 * na / total + 0.5) as bigint) as varchar), ';' order by level) as na_pcts from dn group by read_id""", H, T, _CONSENSUS)
def consensus_taxonomy(spark, sf):
    rows = V.hits(spark, sf).join(V.ref_tax(spark, sf), "ref_id").select("read_id", "taxonomy", "n")
    return consensus.consensus(rows)


_VOTED = _CONSENSUS.replace("from hits join ref_tax using (ref_id)", "from top join ref_tax using (ref_id)")


@query("""select o_orderkey as read_id, coalesce(v.taxonomy, 'Unknown') as taxonomy, coalesce(v.vote, 0) as vote, coalesce(v.minrank, 'NA') as minrank, coalesce(v.taxa_counts, '0;0;0;0;0;0;0') as taxa_counts,
  coalesce(v.max_pcts, '0;0;0;0;0;0;0') as max_pcts, coalesce(v.na_pcts, '100;100;100;100;100;100;100') as na_pcts, coalesce(r.distance, 1.0) as distance, coalesce(r.n, 0) as refssu_count, coalesce(r.refs, 'NA') as refhvr_ids,
  case when coalesce(v.taxonomy, 'Unknown') = 'Unknown' then 'NA' else ['domain', 'phylum', 'class', 'order', 'family', 'genus', 'species'][len(list_filter(string_split(v.taxonomy, ';'), lambda x: x <> 'NA'))] end as rank
  from orders left join (select read_id, coalesce(string_agg(case when done then null when pct >= 66 then best when na_vote >= 66 then 'NA' end, ';' order by level), 'Unknown') as taxonomy,
  cast(coalesce(arg_max(pct, level) filter (not done and pct >= 66), 0) as bigint) as vote, ['domain', 'phylum', 'class', 'order', 'family', 'genus', 'species'][max(level) filter (names > 0) + 1] as minrank,
  string_agg(cast(names as varchar), ';' order by level) as taxa_counts, string_agg(cast(cast(floor(100 * top / total + 0.5) as bigint) as varchar), ';' order by level) as max_pcts,
  string_agg(cast(cast(floor(100 * na / total + 0.5) as bigint) as varchar), ';' order by level) as na_pcts from dn group by read_id) v on v.read_id = o_orderkey
  left join (select read_id, max(distance) as distance, count(*) as n, array_to_string(list_sort(list(distinct cast(ref_id as varchar))), ',') as refs from top group by read_id) r on r.read_id = o_orderkey""", H, T, _TOP, _VOTED)
def assigned_taxonomy(spark, sf):
    names = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("read_id"))
    return consensus.assign(names, hits.top_hits(V.hits(spark, sf)), V.ref_tax(spark, sf))


# ---- marts

_PADDED = "array_to_string([coalesce(string_split({t}, ';')[i], ['superkingdom','phylum','class','order','family','genus','species','strain'][i] || '_NA') for i in range(1, 9)], ';')"


@query("""select project, dataset, taxonomy, count(*) as knt, count(*) / d.dataset_count as frequency, d.dataset_count, ['domain', 'phylum', 'class', 'orderx', 'family', 'genus', 'species', 'strain'][len(string_split(taxonomy, ';'))] as rank,
  string_split(taxonomy, ';')[2] as phylum, coalesce(string_split(taxonomy, ';')[4], 'order_NA') as orderx, 'strain_NA' as strain, 'GAST' as classifier
  from (select project, dataset, regexp_replace(taxonomy, ';NA$', '') as taxonomy from assigned) join (select project, dataset, count(*) as dataset_count from assigned group by all) d using (project, dataset)
  group by project, dataset, taxonomy, d.dataset_count""", A)
def taxon_cube(spark, sf):
    return rollup.taxon_cube(V.assigned(spark, sf), ["project", "dataset"]).select("project", "dataset", "taxonomy", "knt", "frequency", "dataset_count", "rank", "phylum", "orderx", "strain", "classifier")


_ROLL = f"""base as (select project, dataset, {_PADDED.format(t="regexp_replace(taxonomy, ';NA$', '')")} as t from assigned),
 tot as (select project, dataset, count(*) as dataset_count from base group by all),
 roll as (select project, dataset, lv as rank, array_to_string(string_split(t, ';')[1:lv + 1], ';') as taxonomy, count(*) as sum_tax_counts from base, (select unnest(range(0, 8)) as lv) group by all)"""


@query("select project, dataset, rank, taxonomy, sum_tax_counts, sum_tax_counts / dataset_count as frequency, dataset_count from roll join tot using (project, dataset)", A, _ROLL)
def prefix_rollup(spark, sf):
    cube = rollup.taxon_cube(V.assigned(spark, sf), ["project", "dataset"])
    return rollup.prefix_rollup(cube, ["project", "dataset"]).select("project", "dataset", "rank", "taxonomy", "sum_tax_counts", "frequency", "dataset_count")


@query("select distinct taxonomy as taxon_string, rank, case when rank = 7 or taxonomy like '%\\_NA' escape '\\' then 0 else 1 end as num_kids from roll", A, _ROLL)
def distinct_taxa(spark, sf):
    cube = rollup.taxon_cube(V.assigned(spark, sf), ["project", "dataset"])
    return rollup.distinct_taxa(rollup.prefix_rollup(cube, ["project", "dataset"]))


@query("""select distinct ['domain','phylum','class','order','family','genus','species','strain'][lv] as rank, string_split(taxonomy, ';')[lv] as name from assigned, (select unnest(range(1, 9)) as lv) where lv <= len(string_split(taxonomy, ';'))""", A)
def rank_names(spark, sf):
    return rollup.rank_names(V.assigned(spark, sf))


@query("""select u.sample, md5(u.seq) as seq_md5, coalesce(a.taxonomy, '') as taxonomy, u.n as seq_count, u.n / t.dataset_count as frequency, case when a.taxonomy is null then 1.0 else 0.5 end::double as distance, u.rep_id
  from (select sample, seq, min(read_id) as rep_id, count(*) as n from reads group by all) u left join assigned a on a.read_id = u.rep_id
  join (select sample, count(*) as dataset_count from reads group by all) t using (sample)""", R, A)
def sequence_mart(spark, sf):
    a = V.assigned(spark, sf).select("read_id", "taxonomy", F.lit("0").alias("refhvr_ids"), F.lit("class").alias("rank"), F.lit(0.5).alias("distance"))
    mart = rollup.sequence_mart(derep.counts(V.reads(spark, sf), ["sample"]), a, ["sample"])
    return mart.select("sample", F.md5("seq").alias("seq_md5"), "taxonomy", "seq_count", "frequency", "distance", "rep_id")


@query("""select upper(substr(sample, 1, 1)) || substr(sample, 2) as project, lane as dataset, count(*) as dataset_count, cast(max(case when read_id in (select read_id from assigned) then 1 else 0 end) as bigint) as has_tax, '2024-01-31' as date_trimmed from reads group by sample, lane""", R, A)
def projects_datasets(spark, sf):
    own = V.reads(spark, sf).select("read_id", F.col("sample").alias("project"), F.col("lane").alias("dataset"))
    return rollup.projects_datasets(own, V.assigned(spark, sf), "2024-01-31")


# ---- chimeras

_STATS = """cs as (select *, case when denovo_chimeras = 0 and not nothing then percent_ref when nothing then 0.0 else ref_chimeras / denovo_chimeras end as ratio from (
  select *, case when nothing then 0.0 else ref_chimeras * 100.0::double / all_reads end as percent_ref, case when nothing then 0.0 else denovo_chimeras * 100.0::double / all_reads end as percent_denovo from (
  select *, ref_chimeras = 0 or all_reads = 0 as nothing from (select sample, count(*) filter (source = 'ref') as all_reads, count(*) filter (source = 'ref' and chimeric) as ref_chimeras,
  count(*) filter (source = 'denovo' and chimeric) as denovo_chimeras from checked group by sample))))"""


@query("select sample, all_reads, ref_chimeras, denovo_chimeras, percent_ref::double as percent_ref, percent_denovo::double as percent_denovo, ratio::double as ratio from cs", C, _STATS)
def chimera_stats(spark, sf):
    return chimera.chimera_stats(V.checked(spark, sf), ["sample"])


@query("select distinct sample, read_id from checked join cs using (sample) where chimeric and (source = 'denovo' or ratio <= 3)", C, _STATS)
def chimera_choice(spark, sf):
    return chimera.believed(V.checked(spark, sf), ["sample"])


@query("select c_custkey as read_id from customer where c_custkey not in (select read_id from checked where chimeric)", C)
def without_chimeras(spark, sf):
    names = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("read_id"))
    return chimera.without(names, V.checked(spark, sf).filter("chimeric"), ["read_id"])


@query("""select lane, min(read_id) as rep_id, string_agg(cast(read_id as varchar), ',' order by read_id) as ids from (select *, min(read_id) over (partition by lane, sample) as old from reads)
  where (lane, read_id) not in (select lane, read_id from reads where length(seq) < 600) group by lane, sample, old""", R)
def clean_names(spark, sf):
    own = V.reads(spark, sf).select("read_id", "lane", F.col("sample").alias("seq"), F.length("seq").alias("n"))
    names = derep.dereplicate(own, ["lane"])
    out = chimera.clean_names(names.select("lane", "rep_id", "ids"), own.filter("n < 600"), ["lane"])
    return out.select("lane", "rep_id", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


# ---- set algebra

_SETS = "a as (select c_custkey as id, c_name as v from customer where c_acctbal > 0), b as (select c_custkey as id, c_mktsegment as v from customer where c_nationkey < 12)"


def _sets(spark, sf):
    c = V.table(spark, sf, "customer")
    return c.filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("v")), c.filter("c_nationkey < 12").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))


@query("select * from b union all select * from a where id not in (select id from b)", _SETS)
def fasta_plus(spark, sf):
    return setops.plus(*_sets(spark, sf))


@query("select * from a union all select * from b where id not in (select id from a)", _SETS)
def fasta_either(spark, sf):
    return setops.either(*_sets(spark, sf))


@query("select * from a where id in (select id from b)", _SETS)
def fasta_both(spark, sf):
    return setops.both(*_sets(spark, sf))


@query("select * from a where id not in (select id from b)", _SETS)
def fasta_minus(spark, sf):
    return setops.minus(*_sets(spark, sf))


@query("select o_custkey as id, arg_max(o_totalprice, o_orderkey) as o_totalprice from orders group by o_custkey")
def last_wins(spark, sf):
    o = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_totalprice")
    return setops.last_wins(o, "o_orderkey").select("id", "o_totalprice")


@query("""select id, o_orderkey from (select o_custkey as id, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as k from orders)
  join (select c_nationkey as id, row_number() over (partition by c_nationkey order by c_custkey) as k from customer) using (id, k)""")
def named_access(spark, sf):
    rows = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")
    ask = V.table(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("id"), F.col("c_custkey").alias("o_orderkey"))
    return setops.named_access(rows, ask, "o_orderkey")[0].select("id", "o_orderkey")


@query("select event_type as fate, count(distinct user_id) as reads from events group by 1")
def read_fates(spark, sf):
    return setops.fates(V.table(spark, sf, "events").select(F.col("event_type").alias("fate"), F.col("user_id").alias("read_id")))


# ---- warehouse

_TARGET = "tgt as (select o_orderkey as k, o_custkey as v, o_orderstatus as s from orders where o_totalprice < 250000), src as (select o_orderkey as k, o_custkey + 1 as v, o_orderpriority as s from orders where o_custkey % 3 > 0)"


def _upserts(spark, sf):
    o = V.table(spark, sf, "orders")
    return (
        o.filter("o_totalprice < 250000").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"), F.col("o_orderstatus").alias("s")),
        o.filter("o_custkey % 3 > 0").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") + 1).alias("v"), F.col("o_orderpriority").alias("s")),
    )


@query("select * from src union all select * from tgt where k not in (select k from src)", _TARGET)
def upsert(spark, sf):
    return warehouse.upsert(*_upserts(spark, sf), ["k"])


@query("select * from tgt union all select * from src where k not in (select k from tgt)", _TARGET)
def insert_if_absent(spark, sf):
    return warehouse.insert_if_absent(*_upserts(spark, sf), ["k"])


@query("""select src.k, src.v, case when tgt.v is not distinct from src.v then tgt.s else 'now' end as s from src left join tgt using (k) union all select * from tgt where k not in (select k from src)""", _TARGET)
def update_where_changed(spark, sf):
    t, s = _upserts(spark, sf)
    return warehouse.update_where_changed(t, s, ["k"], "v", F.lit("now"), "s")


@query("select seq, row_number() over (order by seq) as sequence_id from (select distinct substr(md5(seq), 1, 12) as seq from reads)", R)
def surrogate_ids(spark, sf):
    own = V.reads(spark, sf).select(F.substring(F.md5("seq"), 1, 12).alias("seq"))
    return warehouse.with_ids(own, ["seq"], "sequence_id")


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select o_orderkey from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where n_name = 'FRANCE' or c_mktsegment = 'BUILDING')")
def delete_by_join(spark, sf):
    o, c, n, li = (V.table(spark, sf, t) for t in ("orders", "customer", "nation", "lineitem"))
    doomed = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).filter("n_name = 'FRANCE' or c_mktsegment = 'BUILDING'")
    return warehouse.delete_matching(li, doomed.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]).select("l_orderkey", "l_linenumber")


@query("select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_quantity > 45)")
def keep_referenced(spark, sf):
    fact = V.table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return warehouse.keep_referenced(V.table(spark, sf, "part"), fact, ["p_partkey"]).select("p_partkey", "p_name")


@query("select count(*) as facts from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey where o_orderstatus = 'F' and p_size > 10")
def star_count(spark, sf):
    o = V.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    p = V.table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    s = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    return warehouse.star_count(V.table(spark, sf, "lineitem"), (o, "l_orderkey"), (p, "l_partkey"), (s, "l_suppkey"))


@query("select taxonomy, dense_rank() over (order by taxonomy) as taxonomy_id from (select distinct taxonomy from assigned)", A)
def taxonomy_dim(spark, sf):
    return warehouse.taxonomy_dim(V.assigned(spark, sf))


@query("""select taxonomy, d1 as domain_id, d2 as phylum_id, d3 as class_id, d4 as order_id, 1 as family_id, 1 as genus_id, 1 as species_id, 1 as strain_id, row_number() over (order by d1, d2, d3, d4) as silva_taxonomy_id from (
  select taxonomy, dense_rank() over (order by lower(string_split(taxonomy, ';')[1])) as d1, dense_rank() over (order by lower(string_split(taxonomy, ';')[2])) as d2,
  dense_rank() over (order by lower(string_split(taxonomy, ';')[3])) as d3, dense_rank() over (order by lower(string_split(taxonomy, ';')[4])) as d4 from (select distinct taxonomy from assigned))""", A)
def snowflake_ids(spark, sf):
    return warehouse.snowflake(V.assigned(spark, sf))


@query("""select sample, sequence_id, count(*) as seq_count from (select sample, seq from reads) join (select seq, row_number() over (order by seq) as sequence_id from (select distinct seq from reads)) using (seq) group by all""", R)
def pdr_fact(spark, sf):
    reads = V.reads(spark, sf)
    uniques = derep.counts(reads, ["sample"]).withColumnRenamed("sample", "dataset")
    info = reads.select(F.col("sample").alias("dataset"), F.col("sample").alias("run_info_id")).distinct()
    return warehouse.pdr_fact(uniques, warehouse.sequence_dim(uniques), info).select(F.col("run_info_id").alias("sample"), "sequence_id", "seq_count")


@query("""select coalesce(f.k, d.k) as k, coalesce(f.n, 0) as file_count, coalesce(d.n, 0) as db_count, coalesce(f.n, 0) = coalesce(d.n, 0) as agrees from
  (select o_custkey as k, count(*) as n from orders group by 1) f full join (select c_custkey as k, count(*) as n from customer where c_custkey % 2 = 0 group by 1) d on f.k = d.k""")
def reconcile(spark, sf):
    f = V.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    d = V.table(spark, sf, "customer").filter("c_custkey % 2 = 0").groupBy(F.col("c_custkey").alias("k")).agg(F.count("*").alias("n"))
    return warehouse.reconcile(f, d, ["k"])


@query("select user_id, arg_max(event_type, event_id) as status, max(event_id) as at from events group by user_id")
def status_log(spark, sf):
    e = V.table(spark, sf, "events").select("user_id", F.col("event_type").alias("status"), F.col("event_id").alias("at"))
    return warehouse.status_log(e.limit(0), e, ["user_id"])


@query("""select 's' || cast(s_suppkey as varchar) as row_key, c.check, c.value from (select s_suppkey, unnest([
   case when s_name like '%#%' then {'check': 'dataset', 'value': s_name} end, case when len(string_split(p, '_')) <> 3 then {'check': 'project parts', 'value': p} end,
   case when string_split(p, '_')[-1] not in ('Bv6', 'Av4') then {'check': 'project region', 'value': p} end, case when suite = 'odd' then {'check': 'suite unknown', 'value': suite} end,
   case when not contains(replace(replace(suite, ' ', ''), '-', ''), rg) then {'check': 'suite region', 'value': suite} end, case when s_suppkey % 9 = 0 then {'check': 'missing run', 'value': ''} end]) as c
  from (select *, case s_suppkey % 4 when 0 then 'AB_CD_Bv6' when 1 then 'AB_Av4' when 2 then 'X_Y_Zv9' else 'A_B_Av4' end as p, case s_suppkey % 3 when 0 then 'odd' when 1 then 'bacterial v6 suite' else 'archaeal v4-v5 suite' end as suite,
   case when s_suppkey % 2 = 0 then 'v6' else 'v4' end as rg from supplier)) where c is not null""")
def metadata_violations(spark, sf):
    k = F.col("s_suppkey")
    own = V.table(spark, sf, "supplier").select(
        F.when(k % 9 == 0, "").otherwise("r").alias("run"), F.concat(F.lit("s"), k.cast("string")).alias("run_key"), F.col("s_name").alias("dataset"),
        F.when(k % 4 == 0, "AB_CD_Bv6").when(k % 4 == 1, "AB_Av4").when(k % 4 == 2, "X_Y_Zv9").otherwise("A_B_Av4").alias("project"),
        F.when(k % 3 == 0, "odd").when(k % 3 == 1, "bacterial v6 suite").otherwise("archaeal v4-v5 suite").alias("primer_suite"), F.when(k % 2 == 0, "v6").otherwise("v4").alias("dna_region"),
    )
    return validate.violations(own, ["bacterial v6 suite", "archaeal v4-v5 suite"], ["v6", "v4"], ["run"])


# ---- quality control


_SCORES = f"""sc as (select sample, tile, i, {_SCORE} as s from (select sample, split_part(header, ':', 5) as tile, unnest(string_split(qual, '')) as c,
  generate_subscripts(string_split(qual, ''), 1) as i from reads where length(qual) > 0)),
 li as (select sample, i, list(s order by s) as l, count(*) as n, (count(*) - 1) // 2 as h, sum(s) as total from sc group by sample, i),
 qu as (select *, (l[(n - 1) // 2 + 1] + l[n // 2 + 1]) / 2.0::double as med, case when n < 3 then l[1]::double else (l[(h - 1) // 2 + 1] + l[h // 2 + 1]) / 2.0::double end as q1,
   case when n < 3 then l[n]::double else (l[n // 2 + 2 + (h - 1) // 2] + l[n // 2 + 2 + h // 2]) / 2.0::double end as q3 from li)"""


@query("""select sample, i as "column", n as "count", l[1] as "min", l[n] as "max", cast(total as bigint) as "sum", cast(total as double) / n as mean, q1, med, q3, q3 - q1 as iqr,
  list_filter(l, lambda x: x >= q1 - 1.5 * (q3 - q1))[1] as left_whisker, list_filter(l, lambda x: x <= q3 + 1.5 * (q3 - q1))[-1] as right_whisker,
  array_to_string(list_concat(list_sort(list_distinct(list_filter(l, lambda x: x < q1 - 1.5 * (q3 - q1)))), list_reverse_sort(list_distinct(list_filter(l, lambda x: x > q3 + 1.5 * (q3 - q1))))), ',') as outliers from qu""", R, _SCORES)
def column_stats(spark, sf):
    stats = qc.column_stats(trim.with_scores(V.reads(spark, sf)), ["sample"])
    return stats.withColumn("outliers", F.array_join(F.transform("outliers", lambda x: x.cast("string")), ","))


@query("""select i as "column", base, count(*) as reads from (select unnest(string_split(seq, '')) as base, generate_subscripts(string_split(seq, ''), 1) as i from reads where length(seq) > 0) group by all""", R)
def base_counts(spark, sf):
    return qc.base_counts(V.reads(spark, sf))


@query("""select tile, i - 1 as cycle, cast(sum(s) as double) / count(*) as mean, round(stddev_pop(s), 6) as std, count(*) as "count" from sc group by tile, i""", R, _SCORES)
def tile_profile(spark, sf):
    df = trim.with_scores(V.reads(spark, sf)).withColumn("tile", S.illumina_header(F.col("header"))["tile"])
    return qc.tile_profile(df, ["tile"]).withColumn("std", F.round("std", 6))


@query("""select cycle, avg(mean) as mean, cast(sum(n) as bigint) as "count" from (select i - 1 as cycle, cast(sum(s) as double) / count(*) as mean, count(*) as n from sc group by tile, i) group by cycle""", R, _SCORES)
def merged_tiles(spark, sf):
    df = trim.with_scores(V.reads(spark, sf)).withColumn("tile", S.illumina_header(F.col("header"))["tile"])
    return qc.merge_tiles(qc.tile_profile(df, ["tile"]), [])


@query("""select f.format, min(ascii(q)) >= any_value(f.low) and max(ascii(q)) <= any_value(f.high) as fits from (select distinct unnest(string_split(qual, '')) as q from reads where length(qual) > 0),
  (select unnest([{'format': 'sanger', 'low': 33, 'high': 126}, {'format': 'illumina', 'low': 64, 'high': 126}, {'format': 'solexa', 'low': 59, 'high': 126}, {'format': 'cssanger', 'low': 33, 'high': 126}]) as f) group by f.format""", R)
def sniffed_formats(spark, sf):
    return qc.sniff_formats(V.reads(spark, sf))


@query("select sample, count(*) as records from reads group by sample", R)
def record_counts(spark, sf):
    return V.reads(spark, sf).groupBy("sample").agg(F.count("*").alias("records"))


# ---- pairs


@query("""select header, md5(seq) as seq_md5, md5(reverse(seq)) as mate_md5 from reads where read_id % 5 > 0""", R)
def mate_pairs(spark, sf):
    r = V.reads(spark, sf)
    second = r.filter("read_id % 5 > 0").select(S.mate_header(F.col("header")).alias("header"), F.reverse("seq").alias("seq"))
    pairs, _ = mates.pair_up(r.select("header", "seq"), second)
    return pairs.select("header", F.md5("seq").alias("seq_md5"), F.md5("mate_seq").alias("mate_md5"))


@query("""select cast(read_id as varchar) || '/' || cast(k as varchar) as read_id, md5(substr(seq, (length(seq) // 2) * (k - 1) + 1, length(seq) // 2)) as seq_md5 from reads, (select unnest([1, 2]) as k) where length(seq) % 2 = 0""", R)
def split_halves(spark, sf):
    r = V.reads(spark, sf).withColumn("read_id", F.col("read_id").cast("string"))
    return mates.split_halves(r).select("read_id", F.md5("seq").alias("seq_md5"))


@query("""select read_id, substr(seq, 1, 6) || '_' || substr(seq, 1, 5) || '_' || lane as demux_key, coalesce(s.sample, 'unknown') as sample from reads r
  left join (select distinct lane, substr(seq, 1, 6) as i, 's-' || lane as sample from reads where starts_with(seq, 'T')) s using (lane) where s.i is not distinct from substr(seq, 1, 6)
  union all select read_id, substr(seq, 1, 6) || '_NNNN' || substr(seq, 5, 5) || '_' || lane, 'unknown' from reads where not starts_with(seq, 'T')""", R)
def demultiplexed(spark, sf):
    r = V.reads(spark, sf).withColumn("index_seq", F.substring("seq", 1, 6))
    key = S.demux_key(F.col("index_seq"), F.col("seq"), F.col("lane"))
    samples = r.filter(F.col("seq").startswith("T")).select(key.alias("demux_key"), F.concat(F.lit("s-"), "lane").alias("sample")).distinct()
    return mates.demultiplex(r.drop("sample"), samples).select("read_id", "demux_key", "sample")


@query("""select p_partkey, substr(t, 1, 24 - best.k) || substr(t, 25 - best.k, best.k) || substr(rc, best.k + 1) as merged, best.k as overlap, best.d as mismatches from (
  select p_partkey, t, rc, list_sort(list_transform(list_filter(list_transform(range(12, 25), lambda k: {'k': k, 'd': len(list_filter(range(1, k + 1), lambda i: substr(t, 24 - k + i, 1) <> substr(rc, i, 1)))}), lambda x: x.d * 10 <= x.k),
    lambda x: {'share': x.d / x.k, 'size': -x.k, 'k': x.k, 'd': x.d}))[1] as best from (
      select p_partkey, substr(t, 1, 24) as t, substr(t, 9, 24) as rc from (select p_partkey, translate(md5(cast(p_partkey as varchar)), '0123456789abcdef', 'ACGTACGTACGTACGT') as t from part)))
  where best.d <= 3""")
def merged_pairs(spark, sf):
    p = V.table(spark, sf, "part").select("p_partkey", F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("t"))
    pairs = p.select("p_partkey", F.substring("t", 1, 24).alias("seq"), S.revcomp(F.substring("t", 9, 24)).alias("mate_seq"))
    return mates.filter_merged(mates.merge_pairs(pairs, 12)).select("p_partkey", "merged", "overlap", "mismatches")


def read_pairs(spark, sf):
    """Pairs of whole reads: the first three fifths and the reverse complement of the last three fifths, every 37th base of it changed."""
    n = F.length("seq")
    part = F.ceil(n * 3 / 5).cast("int")
    changed = lambda c: F.regexp_replace(c, "(.{36}).", "$1A")
    right, score = F.substring(F.col("seq"), n - part + 1, part), F.substring(F.col("qual"), n - part + 1, part)
    return V.reads(spark, sf).select("read_id", F.substring(F.col("seq"), F.lit(1), part).alias("seq"), F.substring(F.col("qual"), F.lit(1), part).alias("qual"), S.revcomp(changed(right)).alias("mate_seq"), F.reverse(score).alias("mate_qual"))


@query()
def merged_reads(spark, sf):
    """Whole reads merged by both mates' qualities; every overlap of a pair is judged."""
    found = merge.merge_reads(read_pairs(spark, sf))
    return found.select("read_id", "overlap", "mismatches", F.md5("merged").alias("merged"), F.md5("merged_qual").alias("merged_qual"))


@query()
def reference_search(spark, sf):
    """Every fiftieth read against all different reads, whole: the first ten accepted of those that share most words."""
    reads = V.reads(spark, sf)
    refs = reads.groupBy("seq").agg(F.min("read_id").alias("ref_id"))
    return search.search(reads.filter("read_id % 50 = 0"), refs, k=16, least_shared=6, least_share=0.01, first=10, distinct=True)


@query()
def denovo_chimeras(spark, sf):
    """All reads, four copies of each, and as many made of the first half of a read and the second half of the next one, once each."""
    own = V.reads(spark, sf).select("read_id", "seq")
    half = F.floor(F.length("seq") / 2).cast("int")
    left = own.select("read_id", F.substring("seq", F.lit(1), half).alias("left_"))
    right = own.select((F.col("read_id") - 1).alias("read_id"), F.substring("seq", half + 1, F.length("seq")).alias("right_"))
    made = left.join(right, "read_id").select((-F.col("read_id") - 1).alias("read_id"), F.concat("left_", "right_").alias("seq"), F.lit(1).cast("long").alias("seq_count"))
    found = search.find_chimeras_denovo(own.withColumn("seq_count", F.lit(4).cast("long")).unionByName(made), k=16, nearest=1)
    return found.select("read_id", F.round("score", 6).alias("score"), "cut", "chimeric")


from . import file_queries, mart_queries, warehouse_queries  # noqa: E402, F401  they add to the same tables
