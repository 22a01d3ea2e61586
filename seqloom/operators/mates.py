"""Read pairs: demultiplexing, joining, splitting, and merging overlapping mates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as S
from .merge import merge_reads
from .prefixes import begins_any


def demultiplex(reads: DataFrame, samples: DataFrame, nextseq: bool = False) -> DataFrame:
    """Adds demux_key and sample, 'unknown' without one. samples: demux_key, sample.

    A key starts with the index; the run key is tried plain and as NNNN with the bases after it.
    """
    plain, inline = (S.demux_key(F.col("index_seq"), F.col("seq"), F.col("lane"), i, nextseq) for i in (False, True))
    tall = reads.withColumns({"plain_": plain, "inline_": inline})
    a = samples.select(F.col("demux_key").alias("plain_"), F.col("sample").alias("sa_"))
    b = samples.select(F.col("demux_key").alias("inline_"), F.col("sample").alias("sb_"))
    out = tall.join(a, "plain_", "left").join(b, "inline_", "left")
    return out.select(
        *reads.columns,
        F.when(F.col("sa_").isNotNull(), F.col("plain_")).otherwise(F.col("inline_")).alias("demux_key"),
        F.coalesce("sa_", "sb_", F.lit("unknown")).alias("sample"),
    )


def wanted_files(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Files (index, ...) whose index begins a sample's demux_key, whole or in part."""
    return begins_any(files, "index", samples, "demux_key")


def pair_up(first: DataFrame, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, lost): first reads (header, seq, ...) with the second read of their header, and second reads without a first."""
    want = first.withColumn("mate_", S.mate_header(F.col("header")))
    other = second.select(F.col("header").alias("mate_"), *[F.col(c).alias(f"mate_{c}") for c in second.columns if c != "header"])
    pairs = want.join(other, "mate_").drop("mate_")
    lost = second.join(want.select(F.col("mate_").alias("header")), "header", "left_anti")
    return pairs, lost


def split_halves(reads: DataFrame) -> DataFrame:
    """Each read of even length as its two halves, /1 and /2; others are left out."""
    half = (F.length("seq") / 2).cast("int")
    parts = F.array(*[F.struct(F.concat("read_id", F.lit(f"/{k + 1}")).alias("read_id"), *[F.substring(F.col(c), half * k + 1, half).alias(c) for c in ("seq", "qual")]) for k in (0, 1)])
    return reads.filter(F.length("seq") % 2 == 0).select(F.explode(parts).alias("x")).select("x.*")


def join_mates(first: DataFrame, second: DataFrame) -> DataFrame:
    """'/1' reads with their '/2' reads: sequences and qualities one after the other, under the name without the suffix.

    Where ``first`` has a pair's '/2' read and ``second`` its '/1' read the two change places. Pairs that aren't a '/1' and a '/2' read
    are joined as they come.
    """
    key = F.regexp_replace("read_id", "/[12]$", "")
    a = first.select(key.alias("read_id"), F.struct("seq", "qual").alias("a_"), F.col("read_id").endswith("/2").alias("late_"))
    b = second.select(key.alias("read_id"), F.struct("seq", "qual").alias("b_"), F.col("read_id").endswith("/1").alias("early_"))
    turned = F.col("late_") & F.col("early_")
    x, y = (F.when(turned, F.col(p)).otherwise(F.col(q)) for p, q in (("b_", "a_"), ("a_", "b_")))
    return a.join(b, "read_id").select("read_id", *[F.concat(x[c], y[c]).alias(c) for c in ("seq", "qual")])


def merge_pairs(pairs: DataFrame, min_overlap: int = 15, max_mismatches: int | None = None, only_overlap: bool = False) -> DataFrame:
    """Merges first reads with the reverse complement of their mates: adds merged, overlap and mismatches, null without one.

    Of overlaps of ``min_overlap`` or more that one in ten places may differ in, the one with the smallest share of
    differences wins, then the longest. Where mates differ the first read's base stays; ``only_overlap`` keeps nothing else.
    This is ``merge.merge_reads`` without qualities, on batches.
    """
    found = merge_reads(pairs.select(F.struct("*").alias("own_"), "seq", "mate_seq"), min_overlap, max_mismatches, only_overlap, by_quality=False)
    return found.select("own_.*", "overlap", "mismatches", "merged")


def filter_merged(merged: DataFrame, most: int = 3) -> DataFrame:
    return merged.filter((F.col("merged").isNotNull()) & (F.col("mismatches") <= most))


def q30_passes(scores: Column, share: float = 0.66, part: float = 0.5) -> Column:
    """Enough of the first part of the scores are 30 or more."""
    head = F.slice(scores, 1, F.greatest((F.size(scores) * part).cast("int"), F.lit(1)))
    return F.size(F.filter(head, lambda x: x >= 30)) >= share * F.size(head)
