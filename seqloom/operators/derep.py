"""Dereplication and abundance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .warehouse import numbered


def dereplicate(reads: DataFrame, keys: list[str], position: str = "read_id", seq: str = "seq") -> DataFrame:
    """One row per (keys, seq): rep_id (the first by ``position``), ids in that order, seq_count."""
    return reads.groupBy(*keys, seq).agg(
        F.min_by("read_id", position).alias("rep_id"),
        F.transform(F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col("read_id").alias("r")))), lambda x: x["r"]).alias("ids"),
        F.count("*").alias("seq_count"),
    )


def counts(reads: DataFrame, keys: list[str], position: str = "read_id", seq: str = "seq") -> DataFrame:
    """As ``dereplicate`` without the ids: aggregated before the shuffle, and bounded per group."""
    return reads.groupBy(*keys, seq).agg(F.min_by("read_id", position).alias("rep_id"), F.count("*").alias("seq_count"))


def unique_by_hash(reads: DataFrame, position: str = "read_id") -> DataFrame:
    """One row per sha1 of the upper-case sequence: the first read's id and sequence as it was, and the count."""
    digest = F.sha1(F.translate("seq", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return reads.groupBy(digest.alias("hash")).agg(
        F.min_by("read_id", position).alias("rep_id"), F.min_by("seq", position).alias("seq"), F.count("*").alias("seq_count")
    )


def defline(rep_id: Column, n: Column) -> Column:
    return F.concat(rep_id, F.lit("|frequency:"), n)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which nulls are equal."""
    right = right.withColumnsRenamed({k: f"{k}_right" for k in keys})
    return left.join(right, [F.col(k).eqNullSafe(F.col(f"{k}_right")) for k in keys])


def abundance_rank(uniques: DataFrame, keys: list[str]) -> DataFrame:
    """Adds abundance_rank: by seq_count, largest first, then by rep_id. No task ranks a whole sample: all samples are numbered
    by ranges, and each subtracts where it begins."""
    every = numbered(uniques.withColumn("less_", -F.col("seq_count")), [*keys, "less_", "rep_id"], "n_").drop("less_")
    if not keys:
        return every.withColumnRenamed("n_", "abundance_rank")
    first = every.groupBy(*keys).agg(F.min("n_").alias("first_"))
    return _joined(every, first, keys).select(*uniques.columns, (F.col("n_") - F.col("first_") + 1).alias("abundance_rank"))


def members(reads: DataFrame, keys: list[str], position: str = "read_id", seq: str = "seq") -> DataFrame:
    """keys, rep_id, read_id: every read with its representative, a row each, however many share a sequence."""
    firsts = counts(reads, keys, position, seq).select(*keys, seq, "rep_id")
    return _joined(reads.select(*keys, seq, "read_id"), firsts, [*keys, seq]).select(*keys, "rep_id", "read_id")


def weighted_lengths(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Length distribution: per keys and length the number of reads."""
    return reads.groupBy(*keys, F.length("seq").alias("length")).agg(F.count("*").alias("reads"))


def length_summary(reads: DataFrame, keys: list[str]) -> DataFrame:
    n = F.length("seq")
    return reads.groupBy(*keys).agg(
        F.count("*").alias("reads"), F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.avg(n).alias("mean_length"), F.stddev_pop(n).alias("std_length")
    )
