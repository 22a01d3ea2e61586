"""Aligner hits: gap filter, best hits with ties, expansion to duplicates, reads without hits, concatenation of references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distance(pct_id: Column) -> Column:
    return F.floor(10.0 * (100.0 - pct_id) + 0.5) / 1000.0


def has_large_gap(cigar: Column, max_gap: int = 10, terminal: str = "") -> Column:
    """Whether a numbered gap exceeds ``max_gap``. ``terminal``: letters ('I' or 'DI') whose runs at either end don't count."""
    if terminal:
        cigar = F.regexp_replace(F.regexp_replace(cigar, f"^[0-9]*[{terminal}]", ""), f"[0-9]*[{terminal}]$", "")
    return F.exists(F.regexp_extract_all(cigar, F.lit("([0-9]+)[DI]"), F.lit(1)), lambda g: g.cast("int") > max_gap)


def top_hits(hits: DataFrame, max_gap: int | None = 10, terminal: str = "") -> DataFrame:
    """Per read all hits at the greatest identity among those that pass the gap filter, with their distance. None: no filter."""
    if max_gap is not None:
        hits = hits.filter(~has_large_gap(F.col("cigar"), max_gap, terminal))
    order = Window.partitionBy("read_id").orderBy(F.desc("pct_id"))
    best = hits.withColumn("place", F.rank().over(order)).filter("place = 1").drop("place")
    return best.withColumn("distance", distance(F.col("pct_id")))


def top_hits_chained(hits: DataFrame, max_gap: int = 10) -> DataFrame:
    """Compatible form for deflines with a frequency: every hit that passes the gap filter, not only the best ones."""
    return hits.filter(~has_large_gap(F.col("cigar"), max_gap)).withColumn("distance", distance(F.col("pct_id")))


def expand_to_duplicates(hits: DataFrame, names: DataFrame) -> DataFrame:
    """The hits of each representative, again for every other read that it stands for. names: rep_id and ids, or a row for each
    rep_id and read_id (as of ``derep.members``)."""
    each = F.explode("ids") if "ids" in names.columns else F.col("read_id")
    others = names.select(F.col("rep_id"), each.alias("duplicate")).withColumnRenamed("rep_id", "read_id").filter("duplicate != read_id")
    return hits.unionByName(hits.join(others, "read_id").drop("read_id").withColumnRenamed("duplicate", "read_id").select(hits.columns))


def without_hits(names: DataFrame, hits: DataFrame) -> DataFrame:
    """Reads of ``names`` (read_id) without a hit, as hit rows: no reference, distance 1, no alignment."""
    lost = names.select("read_id").join(hits.select("read_id").distinct(), "read_id", "left_anti")
    return lost.select("read_id", F.lit("0").alias("ref_id"), F.lit(1.0).alias("distance"), F.lit("0").alias("cigar"), F.lit(0).alias("frequency"))


def concat_refs(hits: DataFrame, order: str = "ref_id") -> DataFrame:
    """Per read its references in order and the distance of the last one."""
    listed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("ref_id").alias("r"))))
    return hits.groupBy("read_id").agg(
        F.max_by("distance", F.struct(order, "ref_id")).alias("distance"), F.transform(listed, lambda x: x["r"]).alias("ref_ids")
    )


def parse_uc(lines: DataFrame) -> DataFrame:
    """Rows of a UC table (tab-separated, column ``value``) as hits: fields 9, 4, 10 and 8."""
    f = F.split("value", "\t")
    return lines.filter(F.col("value").startswith("H\t")).select(
        F.get(f, 8).alias("read_id"), F.get(f, 3).cast("double").alias("pct_id"), F.get(f, 9).alias("ref_id"), F.get(f, 7).alias("cigar")
    )


def reads_to_references(names: DataFrame, hits: DataFrame, ref_tax: DataFrame) -> DataFrame:
    """Every read with its hits, and those with their taxonomies and counts; a read without a hit keeps nulls."""
    return names.select("read_id").join(hits, "read_id", "left").join(ref_tax, "ref_id", "left")
