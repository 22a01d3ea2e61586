"""Reads, hits and reference taxonomy as views over the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: A letter's base goes by its place in the alphabet; three rare letters are unknown bases.
MAPPED = "".join("N" if c in "qxz" else "ACGT"[i % 4] for i, c in enumerate(LETTERS))
#: A base's quality: scores 40, 20, 30, 2 and 0.
QUALITY = ("ACGTN", "I5?#!")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, sample, lane, seq, qual, header: every document's whole text as bases."""
    seq = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), LETTERS + LETTERS.upper(), MAPPED * 2), "[^ACGTN]", "")
    df = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("read_id"), F.col("source").alias("sample"), F.col("lang").alias("lane"), seq.alias("seq"))
    df = df.withColumn("qual", F.translate("seq", *QUALITY))
    tile = (F.col("read_id") % 6 + 1101).cast("string")
    flag = F.when(F.col("read_id") % 7 == 0, "Y").otherwise("N")
    head = F.concat(F.lit("M1:9:"), "sample", F.lit(":"), "lane", F.lit(":"), tile, F.lit(":"), F.col("read_id").cast("string"), F.lit(":5 1:"), flag, F.lit(":0:"), F.substring("seq", 1, 6))
    return df.withColumn("header", head)


READS = f"""reads as (
  select *, translate(seq, '{QUALITY[0]}', '{QUALITY[1]}') as qual,
         'M1:9:' || sample || ':' || lane || ':' || cast(read_id % 6 + 1101 as varchar) || ':' || cast(read_id as varchar)
           || ':5 1:' || (case when read_id % 7 = 0 then 'Y' else 'N' end) || ':0:' || substr(seq, 1, 6) as header
  from (select doc_id as read_id, source as sample, lang as lane,
               regexp_replace(translate(coalesce(text, ''), '{LETTERS}{LETTERS.upper()}', '{MAPPED * 2}'), '[^ACGTN]', '', 'g') as seq
        from documents))"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, ref_id, pct_id, cigar, frequency of every line item."""
    li = table(spark, sf_dir, "lineitem")
    cigar = F.concat(F.lit("100M"), (F.col("l_linenumber") * 3).cast("string"), F.lit("D20M"))
    return li.select(F.col("l_orderkey").alias("read_id"), F.col("l_partkey").alias("ref_id"), (F.lit(50.0) + F.col("l_quantity")).alias("pct_id"), cigar.alias("cigar"), F.lit(1).alias("frequency"))


HITS = """hits as (select l_orderkey as read_id, l_partkey as ref_id, 50.0::double + l_quantity as pct_id,
  '100M' || cast(l_linenumber * 3 as varchar) || 'D20M' as cigar, 1 as frequency from lineitem)"""


def ref_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ref_id, taxonomy, n of every part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ref_id"),
        F.concat_ws(";", F.lit("Bacteria"), F.col("p_type"), F.col("p_brand"), F.concat(F.lit("size"), (F.col("p_size") % 5).cast("string"))).alias("taxonomy"),
        F.col("p_size").alias("n"),
    )


REF_TAX = """ref_tax as (select p_partkey as ref_id, 'Bacteria;' || p_type || ';' || p_brand || ';size' || cast(p_size % 5 as varchar) as taxonomy,
  p_size as n from part)"""


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, project, dataset, taxonomy, rank: customers by region, nation and segment; some without a segment's name."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    last = F.when(F.col("c_custkey") % 5 == 0, F.lit("NA")).otherwise(F.col("c_mktsegment"))
    return j.select(F.col("c_custkey").alias("read_id"), F.col("r_name").alias("project"), F.concat(F.lit("d"), (F.col("c_custkey") % 4).cast("string")).alias("dataset"), F.concat_ws(";", F.lit("Bacteria"), "r_name", "n_name", last).alias("taxonomy"))


ASSIGNED = """assigned as (select c_custkey as read_id, r_name as project, 'd' || cast(c_custkey % 4 as varchar) as dataset,
  'Bacteria;' || r_name || ';' || n_name || ';' || (case when c_custkey % 5 = 0 then 'NA' else c_mktsegment end) as taxonomy
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, read_id, source, chimeric: every event as a chimera check."""
    e = table(spark, sf_dir, "events")
    source = F.when(F.col("event_id") % 3 == 0, "denovo").otherwise("ref")
    return e.select(F.col("event_type").alias("sample"), F.col("user_id").alias("read_id"), source.alias("source"), (F.col("event_id") % 11 < F.length("event_type")).alias("chimeric"))


CHECKED = """checked as (select event_type as sample, user_id as read_id, case when event_id % 3 = 0 then 'denovo' else 'ref' end as source,
  event_id % 11 < length(event_type) as chimeric from events)"""
