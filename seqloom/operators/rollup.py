"""Taxon counts, prefix rollups of lineages, and the marts made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S

DOMAINS = ("Archaea", "Bacteria", "Eukarya", "Organelle", "Unknown")


#: The rank columns of marts.
RANK_COLUMNS = tuple("orderx" if r == "order" else r for r in S.RANKS)


def taxon_cube(assigned: DataFrame, keys: list[str], classifier: str = "GAST") -> DataFrame:
    """Per keys and taxonomy: knt, its share of the keys' rows, their number, the last name's rank and eight padded names."""
    rows = assigned.withColumn("taxonomy", S.strip_na(F.col("taxonomy")))
    counted = rows.groupBy(*keys, "taxonomy").agg(F.count("*").alias("knt"))
    total = rows.groupBy(*keys).agg(F.count("*").alias("dataset_count"))
    names = S.lineage(F.col("taxonomy"))
    out = counted.join(total, keys).withColumn("frequency", F.col("knt") / F.col("dataset_count")).withColumn("rank", F.get(F.array(*map(F.lit, RANK_COLUMNS)), F.size(names) - 1)).withColumn("p_", S.pad_lineage(names))
    columns = [f"{r}x" if r == "order" else r for r in S.PADDING]
    return out.select(*keys, "taxonomy", *[F.get("p_", i).alias(c) for i, c in enumerate(columns)], "rank", "knt", "frequency", "dataset_count", F.lit(classifier).alias("classifier"))


def prefix_rollup(counted: DataFrame, keys: list[str], taxonomy: str = "taxonomy", value: str = "knt") -> DataFrame:
    """Sums of each of the eight prefixes of the padded lineage: taxonomy, rank (0 to 7), sum_tax_counts, frequency, dataset_count."""
    padded = S.pad_lineage(S.lineage(F.col(taxonomy)))
    levels = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.struct((i - 1).alias("rank"), F.array_join(F.slice(F.col("p_"), F.lit(1), i), ";").alias("prefix")))
    # lineages are summed first, so each is exploded once
    base = counted.groupBy(*keys, padded.alias("p_")).agg(F.sum(value).alias("v"))
    tall = base.select(*keys, "v", F.explode(levels).alias("x"))
    sums = tall.groupBy(*keys, F.col("x.rank").alias("rank"), F.col("x.prefix").alias("taxonomy")).agg(F.sum("v").alias("sum_tax_counts"))
    total = base.groupBy(*keys).agg(F.sum("v").alias("dataset_count"))
    return sums.join(total, keys).withColumn("frequency", F.col("sum_tax_counts") / F.col("dataset_count"))


def distinct_taxa(summed: DataFrame, domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """taxon_string, rank and num_kids: 0 at the last rank or where the name is a filler, else 1."""
    rows = summed.filter(F.get(F.split("taxonomy", ";"), 0).isin(*domains)).select(F.col("taxonomy").alias("taxon_string"), "rank").distinct()
    return rows.withColumn("num_kids", F.when((F.col("rank") == 7) | F.col("taxon_string").endswith("_NA"), 0).otherwise(1))


def rank_names(assigned: DataFrame) -> DataFrame:
    """Distinct (rank, name) of all lineages."""
    named = F.posexplode(S.lineage(F.col("taxonomy")))
    return assigned.select(named).select(F.get(F.array(*map(F.lit, S.RANKS)), F.col("pos")).alias("rank"), F.col("col").alias("name")).filter("rank is not null").distinct()


def sequence_mart(uniques: DataFrame, assigned: DataFrame, keys: list[str]) -> DataFrame:
    """Unique sequences with their assignment; one without gets no taxonomy, rank NA and distance 1."""
    total = uniques.groupBy(*keys).agg(F.sum("seq_count").alias("dataset_count"))
    a = assigned.select(F.col("read_id").alias("rep_id"), "taxonomy", "refhvr_ids", "rank", "distance")
    out = uniques.join(a, "rep_id", "left").join(total, keys)
    return out.select(
        "seq", *keys, F.coalesce("taxonomy", F.lit("")).alias("taxonomy"), F.coalesce("refhvr_ids", F.lit("0")).alias("refhvr_ids"), F.coalesce("rank", F.lit("NA")).alias("rank"),
        "seq_count", (F.col("seq_count") / F.col("dataset_count")).alias("frequency"), F.coalesce("distance", F.lit(1.0)).alias("distance"), "rep_id",
    )


def projects_datasets(reads: DataFrame, assigned: DataFrame, date_trimmed: str) -> DataFrame:
    """project, dataset, dataset_count, has_tax, date_trimmed; the date is given, never read from the clock."""
    counted = reads.groupBy("project", "dataset").agg(F.count("*").alias("dataset_count"))
    taxed = reads.join(assigned.select("read_id"), "read_id", "left_semi").select("project", "dataset").distinct().withColumn("has_tax", F.lit(1))
    joined = counted.join(taxed, ["project", "dataset"], "left")
    return joined.select(S.capitalize(F.col("project")).alias("project"), "dataset", "dataset_count", F.coalesce("has_tax", F.lit(0)).alias("has_tax"), F.lit(date_trimmed).alias("date_trimmed"))
