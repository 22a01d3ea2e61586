"""Queries of the warehouse's dimensions, facts and deletes, of names tables, and of chimera search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as S
from ..operators import consensus, derep, filters, hits, prefixes, primers, search, trim, validate, warehouse
from ..sources.shared import Workspace
from . import views as V
from .registration import query

R, H, T, A = V.READS, V.HITS, V.REF_TAX, V.ASSIGNED


@query("""select l_orderkey, l_linenumber from lineitem where l_orderkey not in (select o_orderkey from orders join customer on o_custkey = c_custkey
  where c_mktsegment = 'BUILDING' and o_orderstatus = 'F' and o_orderkey % 4 in (0, 1) and o_orderpriority in ('1-URGENT', '5-LOW'))""")
def star_delete(spark, sf):
    """A run has three known projects and one that isn't; two are named."""
    o = V.table(spark, sf, "orders")
    fact = V.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "run_info_id")
    info = o.select(F.col("o_orderkey").alias("run_info_id"), F.col("o_custkey").alias("run_id"), F.col("o_orderstatus").alias("suite_id"), F.col("o_orderpriority").alias("dataset"), (F.col("o_orderkey") % 4).alias("project_id"))
    runs = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("run"))
    suites = o.select(F.col("o_orderstatus").alias("suite_id"), F.col("o_orderstatus").alias("suite")).distinct()
    projects = V.table(spark, sf, "region").filter("r_regionkey < 3").select(F.col("r_regionkey").cast("long").alias("project_id"), F.concat(F.lit("p"), F.col("r_regionkey").cast("string")).alias("project"))
    left = warehouse.star_delete(fact, info, runs, suites, projects, run="BUILDING", suite="F", named=["p0", "p1", "p3"], datasets=["1-URGENT", "5-LOW"])
    return left.select(F.col("run_info_id").alias("l_orderkey"), "l_linenumber")


@query("""select name, row_number() over (order by load, name) as id from (select c_mktsegment || '/' || cast(c_custkey as varchar) as name, case when c_custkey % 2 = 0 then 1 when c_custkey % 3 = 0 then 2 else 3 end as load from customer)""")
def stored_ids(spark, sf):
    """Three loads of a dimension; every one brings keys of the loads before it as well."""
    c = V.table(spark, sf, "customer")
    names = c.select("c_custkey", F.concat("c_mktsegment", F.lit("/"), F.col("c_custkey").cast("string")).alias("name"))
    store = warehouse.StoredIds(spark, Workspace(spark, "dimension").path("names"), ["name"], "id")
    store.load(names.filter("c_custkey % 2 = 0"))
    store.load(names.filter("c_custkey % 6 in (0, 3)"))
    return store.load(names)


_KINDS = "kinds as (select p_type as whole, substr(p_type, 1, 3 + p_partkey % 9) as key, p_partkey % 5 as place from part)"


@query("""select p_partkey, min(case when key is not null then {'place': place, 'key': key} end).key as key from part left join (select key, min(place) as place from kinds group by key) on starts_with(p_type, key) group by p_partkey""", _KINDS)
def prefix_first(spark, sf):
    """Of the keys that a type begins with the first in a list of as many keys as there are parts."""
    p = V.table(spark, sf, "part")
    keys = p.select(F.substring("p_type", F.lit(1), (3 + F.col("p_partkey") % 9).cast("int")).alias("key"), (F.col("p_partkey") % 5).alias("place"))
    return prefixes.prefix_join(p.select("p_partkey", "p_type"), "p_type", keys, "key", "place").select("p_partkey", "key")


@query("""select p_partkey, max(case when key is not null then {'size': length(key), 'key': key} end).key as key from part left join (select distinct key from kinds) on starts_with(p_type, key) group by p_partkey""", _KINDS)
def prefix_longest(spark, sf):
    p = V.table(spark, sf, "part")
    keys = p.select(F.substring("p_type", F.lit(1), (3 + F.col("p_partkey") % 9).cast("int")).alias("key"))
    return prefixes.prefix_join(p.select("p_partkey", "p_type"), "p_type", keys, "key").select("p_partkey", "key")


_PER_SEQUENCE = """seqs as (select seq, min(read_id) as rep_id, row_number() over (order by seq) as sequence_id from reads group by seq),
 tax as (select taxonomy, row_number() over (order by taxonomy) as taxonomy_id from (select distinct taxonomy from assigned)),
 per as (select sequence_id, taxonomy_id, case when taxonomy like '%;NA' then 3 else 4 end as rank_id from assigned join seqs on read_id = rep_id join tax using (taxonomy))"""


def _per_sequence(spark, sf):
    reads = V.reads(spark, sf)
    uniques, a = derep.counts(reads, []), V.assigned(spark, sf)
    ranks = spark.createDataFrame([(r, i + 1) for i, r in enumerate(S.RANKS)], "rank string, rank_id long")
    facts = consensus.with_rank(a).withColumns({"distance": F.lit(0.1), "refssu_count": F.lit(1)})
    return warehouse.per_sequence_taxonomy(facts, uniques, warehouse.sequence_dim(uniques), warehouse.taxonomy_dim(a), ranks)


@query("select sequence_id, taxonomy_id, rank_id, 0.1::double as gast_distance, 1 as refssu_count from per", R, A, _PER_SEQUENCE)
def per_sequence_taxonomy(spark, sf):
    return _per_sequence(spark, sf)


@query("select sequence_id, taxonomy_id, rank_id, 0.1::double as gast_distance, 1 as refssu_count, case when sequence_id % 3 = 0 then 'r' || cast(sequence_id as varchar) else '' end as refhvr_ids from per", R, A, _PER_SEQUENCE)
def uniq_info(spark, sf):
    per = _per_sequence(spark, sf)
    refs = per.filter("sequence_id % 3 = 0").select("sequence_id", F.concat(F.lit("r"), F.col("sequence_id").cast("string")).alias("refhvr_ids"))
    return warehouse.uniq_info(per, refs)


_SAMPLES = """samples as (select 'run' || cast(s_suppkey % 5 as varchar) as run, 'k' || cast(s_suppkey % 8 as varchar) as run_key, 'v' || cast(s_suppkey % 3 + 4 as varchar) as dna_region,
  'p' || cast(s_nationkey as varchar) as project, s_name as dataset, 'miseq' as platform, cast(s_suppkey % 4 + 1 as varchar) as lane, 'suite' || cast(s_suppkey % 2 as varchar) as primer_suite, 'I' || cast(s_suppkey % 6 as varchar) as barcode_index, 'b' as barcode from supplier),
 dims as (select *, dense_rank() over (order by run) as run_id, dense_rank() over (order by run_key) as run_key_id, dense_rank() over (order by dna_region) as dna_region_id, dense_rank() over (order by project) as project_id,
  dense_rank() over (order by dataset, project) as dataset_id, dense_rank() over (order by primer_suite) as primer_suite_id, dense_rank() over (order by barcode_index) as illumina_index_id from samples)"""


def _samples(spark, sf):
    k, text = F.col("s_suppkey"), lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    return V.table(spark, sf, "supplier").select(
        text("run", k % 5).alias("run"), text("k", k % 8).alias("run_key"), text("v", k % 3 + 4).alias("dna_region"), text("p", F.col("s_nationkey")).alias("project"), F.col("s_name").alias("dataset"),
        F.lit("miseq").alias("platform"), text("", k % 4 + 1).alias("lane"), text("suite", k % 2).alias("primer_suite"), text("I", k % 6).alias("barcode_index"), F.lit("b").alias("barcode"),
    )


@query("""select run_info_id, barcode, dataset_id, dna_region_id, illumina_index_id, lane, platform, primer_suite_id, run_id, run_key_id, project_id from (select *, row_number() over (order by barcode, dataset_id, dna_region_id, illumina_index_id, lane, platform, primer_suite_id, run_id, run_key_id, project_id) as run_info_id
  from (select distinct barcode, dataset_id, dna_region_id, illumina_index_id, lane, platform, primer_suite_id, run_id, run_key_id, project_id from dims))""", _SAMPLES)
def run_info(spark, sf):
    own = _samples(spark, sf)
    return warehouse.run_info(own, warehouse.run_tables(own))


@query("select project, row_number() over (order by project) as project_id, reverse(project) as rev_project_name from (select distinct project from samples)", _SAMPLES)
def project_dim(spark, sf):
    return warehouse.run_tables(_samples(spark, sf))["projects"]


@query("select distinct dataset_id, dna_region_id, illumina_index_id, primer_suite_id, run_id, 1 as sequencing_platform_id from dims", _SAMPLES)
def required_metadata(spark, sf):
    own = _samples(spark, sf)
    return warehouse.required_metadata(own, warehouse.run_tables(own))


@query("select distinct c_mktsegment as value from customer where c_mktsegment not in (select c_mktsegment from customer where c_custkey < 4)")
def unknown_values(spark, sf):
    c = V.table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "value")
    return validate.absent(c, c.filter("c_custkey < 4"), "value")


@query("select p_partkey, case when p_type = 'miscellaneous_natural_or_artificial_environment' then 'miscellaneous' else replace(replace(lower(p_type), ' ', '_'), '_', ' ') end as source, row as env_sample_source_id from part left join (select t, row_number() over (order by t) as row from (select distinct lower(p_type) as t from part where p_size > 3)) on t = lower(p_type)")
def env_sources(spark, sf):
    p = V.table(spark, sf, "part")
    source = F.translate(F.lower("p_type"), " ", "_")
    known = warehouse.with_ids(p.filter("p_size > 3").select(F.lower("p_type").alias("env_source_name")), ["env_source_name"], "env_sample_source_id")
    own = p.select("p_partkey", source.alias("env_sample_source"), S.normalize_env_source(source).alias("source"))
    return validate.env_source_ids(own, known)


@query("""select o_orderkey as read_id, n as frequency, taxonomy, distance from orders join (select o_custkey, min(o_orderkey) as rep_id, count(*) as n from orders group by o_custkey) using (o_custkey)
  join (select read_id, max(distance) as distance, cast(max(ref_id) as varchar) as taxonomy from (select *, (100 - pct_id) / 100 as distance from hits) group by read_id) on read_id = rep_id""", H)
def terse_taxonomy(spark, sf):
    """A representative's assignment, for every read that it stands for."""
    names = derep.dereplicate(V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("read_id"), F.col("o_custkey").alias("seq")), [])
    long = V.hits(spark, sf).withColumn("distance", (100 - F.col("pct_id")) / 100).groupBy("read_id").agg(F.max("distance").alias("distance"), F.max("ref_id").cast("string").alias("taxonomy"))
    long = long.withColumns({"rank": F.lit("genus"), "refssu_count": F.lit(1), "refhvr_ids": F.lit("0")})
    return consensus.terse(long, names).select("read_id", "frequency", "taxonomy", "distance")


@query("""select read_id, lane, coalesce((40.0::double * (length(qual) - length(replace(qual, 'I', ''))) + 20.0 * (length(qual) - length(replace(qual, '5', ''))) + 30.0 * (length(qual) - length(replace(qual, '?', ''))) + 2.0 * (length(qual) - length(replace(qual, '#', '')))) / nullif(length(qual), 0) < 25, true) as low from reads where lane in ('en', 'de')""", R)
def quality_gate(spark, sf):
    df = trim.with_scores(V.reads(spark, sf)).filter(filters.in_regions(F.col("lane"), ["en", "de"]))
    return df.select("read_id", "lane", F.coalesce(filters.mean_quality_fails(F.col("scores"), 25), F.lit(True)).alias("low"))


@query("""select read_id, len(list_filter(string_split(head, ''), lambda x: x in ('I', '?'))) >= 0.66 * length(head) as passes from (select read_id, substr(qual, 1, greatest(length(qual) // 2, 1)) as head from reads where length(qual) > 0)""", R)
def q30_heads(spark, sf):
    from ..operators import mates

    df = trim.with_scores(V.reads(spark, sf)).filter("length(qual) > 0")
    return df.select("read_id", mates.q30_passes(F.col("scores")).alias("passes"))


_PATTERNS = ("TCN[CT]A", "AC?G{1,2}", "[A,C]R", "GN*")


@query("""select 'TCN[CT]A' as pattern, 'TC' || a || b || 'A' as seq from (select unnest(['A', 'C', 'G', 'T']) as a), (select unnest(['C', 'T']) as b)
  union all select 'AC?G{1,2}', 'A' || a || b from (select unnest(['', 'C']) as a), (select unnest(['G', 'GG']) as b) union all select '[A,C]R', a || b from (select unnest(['A', 'C']) as a), (select unnest(['A', 'G']) as b)
  union all select 'GN*', 'G' || a || b from (select unnest(['', 'A', 'C', 'G', 'T']) as a), (select unnest(['', 'A', 'C', 'G', 'T']) as b) where a <> '' or b = ''""")
def expanded_primers(spark, sf):
    return spark.createDataFrame([(p, s) for p in _PATTERNS for s in primers.expand(p)], "pattern string, seq string")


@query("""select d, 40 + d as start, 45 + d as "end" from (select unnest([0, 1, -1, 2, -2, 3, -3]) as d)""")
def anchor_places(spark, sf):
    windows = primers.anchor_windows(primers.Anchor("a", False, 40, 3, 5, "GTAAG"))
    return spark.createDataFrame([(a - 40, a, b) for a, b in windows], "d long, start long, end long")


@query("select 'q' || cast(s_suppkey as varchar) as read_id, s_suppkey % 2 = 0 as chimeric from supplier where s_suppkey <= 40")
def chimeras(spark, sf):
    """Every second query is made of two references, one of them a base longer, the others are a reference with a few other bases."""
    letters = ("0123456789abcdef", "ACGTACGTACGTACGT")
    s = V.table(spark, sf, "supplier").filter("s_suppkey <= 40").select("s_suppkey", *(F.translate(F.concat(F.md5(F.concat(F.lit(x), F.col("s_suppkey").cast("string"))), F.md5(F.concat(F.lit(x), F.lit("-"), F.col("s_suppkey").cast("string")))), *letters).alias(x) for x in "lr"))
    refs = s.select(F.concat(F.lit("l"), F.col("s_suppkey").cast("string")).alias("ref_id"), "l").unionAll(s.select(F.concat(F.lit("r"), F.col("s_suppkey").cast("string")), F.concat(F.lit("A"), "r"))).toDF("ref_id", "seq")
    mixed = F.concat(F.substring("l", 1, 32), F.substring("r", 33, 32))
    plain = F.concat(F.substring("l", 1, 20), F.lit("A"), F.substring("l", 22, 50))
    own = s.select(F.concat(F.lit("q"), F.col("s_suppkey").cast("string")).alias("read_id"), F.when(F.col("s_suppkey") % 2 == 0, mixed).otherwise(plain).alias("seq"), F.lit(1).cast("long").alias("seq_count"))
    found = search.search(own, refs, k=8, least_shared=6, min_id=20.0)
    return search.find_chimeras(own, found, refs.withColumn("seq_count", F.lit(None).cast("long"))).select("read_id", "chimeric")
