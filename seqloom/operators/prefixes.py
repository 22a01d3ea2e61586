"""Joins on prefixes as equi-joins: one for each length of key, however many keys there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_join(rows: DataFrame, column: str, keys: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``rows`` with the columns of the row of ``keys`` whose ``key`` their ``column`` begins with, null where none does.

    Of several keys the longest wins or, with ``order``, the one with the smallest value there; of equal keys the first by ``order``,
    else the smallest row. A key of each length meets the prefixes of that length; empty and null keys begin nothing. The lengths
    alone come to the driver.
    """
    known = keys.filter(F.length(key) > 0)
    rank = F.col(order) if order else -F.length(key)
    own = F.struct(rank.alias("rank_"), *[F.col(c) for c in keys.columns])
    lengths = sorted(r[0] for r in known.select(F.length(key)).distinct().collect())  # as many as there are lengths
    out, found = rows, []
    for n in lengths:
        some = known.filter(F.length(key) == n).groupBy(F.col(key).alias("key_")).agg(F.min(own).alias(f"found_{n}_"))
        prefix = F.when(F.length(column) >= n, F.substring(column, 1, n))
        out = out.withColumn("prefix_", prefix).join(some, F.col("prefix_") == F.col("key_"), "left").drop("prefix_", "key_")
        found.append(F.col(f"found_{n}_"))
    if not found:
        return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in keys.schema])
    best = F.array_min(F.filter(F.array(*found), lambda x: x.isNotNull()))
    return out.withColumn("best_", best).select(*rows.columns, *[F.col("best_")[c].alias(c) for c in keys.columns])


def begins_any(rows: DataFrame, column: str, words: DataFrame, word: str) -> DataFrame:
    """The rows whose ``column`` is a prefix of some ``word``: words are spelled out prefix by prefix, once each. An empty one begins nothing."""
    ends = F.sequence(F.lit(1), F.length(word))
    prefixes = words.filter(F.length(word) > 0).select(F.explode(F.transform(ends, lambda n: F.substring(F.col(word), F.lit(1), n))).alias("prefix_")).distinct()
    return rows.join(prefixes, F.col(column) == F.col("prefix_"), "left_semi")
