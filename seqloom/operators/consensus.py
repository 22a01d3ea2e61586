"""Consensus taxonomy: a weighted vote at each rank over the references of a read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as S

#: The votes are dealt out over so many tasks at least.
_TASKS = 256
VOTED = 7  # ranks domain to species; strains aren't voted on


def consensus(lineages: DataFrame, majority: int = 66) -> DataFrame:
    """One row per read: taxonomy, vote, minrank, taxa_counts, max_pcts, na_pcts.

    lineages: read_id, taxonomy, n (copies of the reference, its weight). Each rank is voted on by itself: a name of ``majority``
    percent (truncated) joins the lineage, until a rank whose best name (other than NA) has less. vote is that of the last
    name joined. minrank is the deepest rank with any name. Counts and percents cover all seven ranks. Without a taxonomy or
    weight: Unknown, vote 0, NA.
    """
    # dealt out by read once: every later step groups within a read, and equal lineages are summed before they are split. A number is
    # named, so that small partitions aren't joined: a row here is seven rows in each of the steps that follow in its task
    tasks = max(_TASKS, int(lineages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = F.col("taxonomy").isNotNull() & (F.col("n") > 0)
    voted = lineages.filter(counts).select("read_id", "taxonomy", "n").repartition(tasks, "read_id").groupBy("read_id", "taxonomy").agg(F.sum("n").alias("n"))
    names = S.lineage(F.col("taxonomy"))
    padded = F.transform(F.sequence(F.lit(0), F.lit(VOTED - 1)), lambda i: F.struct(i.alias("level"), F.coalesce(F.get(names, i), F.lit("NA")).alias("name")))
    tall = voted.select("read_id", "n", F.explode(padded).alias("x")).select("read_id", "n", "x.level", "x.name")
    tally = tall.groupBy("read_id", "level", "name").agg(F.sum("n").alias("tally"))
    real = F.col("name") != "NA"
    # one row per read and rank; names are few after the tally, and the winner needs no list of them
    rank = tally.groupBy("read_id", "level").agg(
        F.sum("tally").alias("total"),
        F.coalesce(F.max(F.when(real, F.col("tally"))), F.lit(0)).alias("top"),
        F.max_by("name", F.when(real, F.struct("tally", "name"))).alias("best"),
        F.sum(F.when(real, 1).otherwise(0)).alias("names"),
        F.coalesce(F.sum(F.when(~real, F.col("tally"))), F.lit(0)).alias("na"),
    )
    pct = F.floor(100 * F.col("top") / F.col("total")).cast("int")
    na_pct = F.floor(100 * F.col("na") / F.col("total")).cast("int")
    before = Window.partitionBy("read_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    rank = rank.withColumns({"pct": pct, "na_vote": na_pct}).withColumn("done", F.coalesce(F.max(F.col("pct") < majority).over(before), F.lit(False)))
    chosen = F.when(~F.col("done") & (F.col("pct") >= majority), F.col("best")).when(~F.col("done") & (F.col("na_vote") >= majority), F.lit("NA"))
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("level", c.alias("v")))), lambda x: x["v"].cast("string"))
    joined = F.transform(F.filter(F.sort_array(F.collect_list(F.struct("level", chosen.alias("v")))), lambda x: x["v"].isNotNull()), lambda x: x["v"])
    out = rank.groupBy("read_id").agg(
        F.array_join(joined, ";").alias("lineage"),
        F.coalesce(F.max_by("pct", F.when(~F.col("done") & (F.col("pct") >= majority), F.col("level"))), F.lit(0)).alias("vote"),
        F.max(F.when(F.col("names") > 0, F.col("level"))).alias("deep"),
        F.array_join(listed(F.col("names")), ";").alias("taxa_counts"),
        F.array_join(listed(F.floor(100 * F.col("top") / F.col("total") + 0.5)), ";").alias("max_pcts"),
        F.array_join(listed(F.floor(100 * F.col("na") / F.col("total") + 0.5)), ";").alias("na_pcts"),
    )
    ranks = F.array(*map(F.lit, S.RANKS))
    voted_rows = out.select(
        "read_id",
        F.when(F.col("lineage") == "", "Unknown").otherwise(F.col("lineage")).alias("taxonomy"),
        "vote",
        F.coalesce(F.get(ranks, F.col("deep")), F.lit("NA")).alias("minrank"),
        "taxa_counts",
        "max_pcts",
        "na_pcts",
    )
    zeros, hundreds = ";".join("0" * VOTED), ";".join(["100"] * VOTED)
    rest = lineages.groupBy("read_id").agg(F.max(F.coalesce(counts, F.lit(False))).alias("any_")).filter("not any_")
    unknown = rest.select("read_id", F.lit("Unknown").alias("taxonomy"), F.lit(0).alias("vote"), F.lit("NA").alias("minrank"), F.lit(zeros).alias("taxa_counts"), F.lit(zeros).alias("max_pcts"), F.lit(hundreds).alias("na_pcts"))
    return voted_rows.unionByName(unknown)


def with_rank(assigned: DataFrame) -> DataFrame:
    """Adds rank: the name of the lineage's depth, 'NA' for Unknown."""
    names = S.lineage(F.col("taxonomy"))
    return assigned.withColumn("rank", F.when(F.col("taxonomy") == "Unknown", "NA").otherwise(S.depth_name(names)))


def assign(names: DataFrame, hits: DataFrame, ref_tax: DataFrame, majority: int = 66, max_distance: float | None = None) -> DataFrame:
    """The long table: a read's consensus, distance, rank and references. A hit beyond ``max_distance`` (None: no limit) is left out."""
    if max_distance is not None:
        hits = hits.filter(F.col("distance") <= max_distance)
    rows = names.select("read_id").join(hits, "read_id", "left").join(ref_tax, "ref_id", "left")
    voted = with_rank(consensus(rows.select("read_id", "taxonomy", "n"), majority))
    refs = hits.groupBy("read_id").agg(F.max("distance").alias("distance"), F.count("*").alias("refssu_count"), F.array_join(F.sort_array(F.collect_set(F.col("ref_id").cast("string"))), ",").alias("refhvr_ids"))
    return voted.join(refs, "read_id", "left").withColumns({"distance": F.coalesce("distance", F.lit(1.0)), "refssu_count": F.coalesce("refssu_count", F.lit(0)), "refhvr_ids": F.coalesce("refhvr_ids", F.lit("NA"))})


def terse(long: DataFrame, names: DataFrame) -> DataFrame:
    """One row per read of the set, its representative's assignment repeated. names: rep_id, ids."""
    other = names.select(F.col("rep_id").alias("read_id"), F.size("ids").alias("frequency"), F.explode("ids").alias("member"))
    return long.join(other, "read_id").select(F.col("member").alias("read_id"), "taxonomy", "rank", "refssu_count", "refhvr_ids", "distance", "frequency")
