"""Quality control: statistics by column, base counts, encodings, and tile profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import quality as Q


def _counted(df: DataFrame, keys: list[str], column: str, kind: str) -> DataFrame:
    """keys, pos (from 0), value and n: how often a value stands at a place of ``column``, a list or string.

    Batches are counted as a whole before anything is sent, so what is shuffled is a row for each value, not each place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.zeros(len(batch), np.int64)
            for k in keys:
                code = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                group = np.unique(group * (len(batch) + 1) + code, return_inverse=True)[1]
            row = np.zeros(group.max() + 1 if len(group) else 0, np.int64)
            row[group[::-1]] = np.arange(len(batch))[::-1]
            ends, x = (Q.codes if kind == "string" else Q.lists)(batch.column(column))
            low = int(x.min()) if len(x) else 0
            i = 0
            while i < len(batch):  # some megabytes of work at a time
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + (1 << 20), "right")) - 1)
                size = np.diff(ends[i : j + 1])
                value = x[ends[i] : ends[j]].astype(np.int64) - low
                pos = np.arange(ends[j] - ends[i]) - np.repeat(ends[i:j] - ends[i], size)
                wide, deep = int(size.max(initial=0)) + 1, int(value.max(initial=0)) + 1
                seen, n = np.unique((np.repeat(group[i:j], size) * wide + pos) * deep + value, return_counts=True)
                i = j
                at = seen // deep
                own = batch.select(keys).take(pa.array(row[at // wide]))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array((at % wide).astype(np.int32)), pa.array((seen % deep + low).astype(np.int32)), pa.array(n)], [*keys, "pos", "value", "n"])

    fields = [df.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("pos", T.IntegerType()), T.StructField("value", T.IntegerType()), T.StructField("n", T.LongType())])
    found = df.select(*keys, column).mapInArrow(run, schema)
    return found.groupBy(*keys, "pos", "value").agg(F.sum("n").alias("n"))


def column_stats(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per position of ``scores``: count, min, max, sum, mean, q1, med, q3, iqr, whiskers, outliers.

    Quartiles go by index over the sorted scores. med: of n values the middle one, or the mean of the two middle ones. q1 and q3:
    the medians of the floor((n - 1) / 2) values before and after the middle one or two; the first and the last value where there
    are none. They come from counts per score (at most some 100 a column), so no column's values are gathered. Whiskers are the
    extreme scores within 1.5 iqr of the quartiles; outliers are the distinct scores beyond: low ones ascending, then high ones
    descending.
    """
    keys = keys or []
    counts = _counted(reads, keys, "scores", "array").select(*keys, (F.col("pos") + 1).alias("column"), F.col("value").alias("score"), "n")
    by = [*keys, "column"]
    counts = counts.withColumn("upto", F.sum("n").over(Window.partitionBy(*by).orderBy("score")))
    hist = counts.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("upto", "score"))).alias("h"),
        F.sum("n").alias("count"), F.min("score").alias("min"), F.max("score").alias("max"), F.sum(F.col("n") * F.col("score")).alias("sum"),
    )

    def value_at(i: Column) -> Column:
        return F.get(F.filter("h", lambda x: x["upto"] > i), 0)["score"].cast("double")

    def median(first: Column, size: Column) -> Column:
        return (value_at(first + F.floor((size - 1) / 2)) + value_at(first + F.floor(size / 2))) / 2.0

    n, side = F.col("count"), F.floor((F.col("count") - 1) / 2)
    few = F.col("count") < 3
    out = hist.withColumns({
        "mean": F.col("sum") / n,
        "med": median(F.lit(0), n),
        "q1": F.when(few, F.col("min").cast("double")).otherwise(median(F.lit(0), side)),
        "q3": F.when(few, F.col("max").cast("double")).otherwise(median(F.floor(n / 2) + 1, side)),
    })
    out = out.withColumn("iqr", F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    score = lambda test: F.transform(F.filter("h", test), lambda x: x["score"])
    out = out.withColumns({
        "left_whisker": F.get(score(lambda x: x["score"] >= low), 0),
        "right_whisker": F.element_at(score(lambda x: x["score"] <= high), -1),
        "outliers": F.concat(score(lambda x: x["score"] < low), F.reverse(score(lambda x: x["score"] > high))),
    })
    return out.drop("h")


def base_counts(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per position and base the number of reads."""
    keys = keys or []
    return _counted(reads, keys, "seq", "string").select(*keys, (F.col("pos") + 1).alias("column"), F.char("value").alias("base"), F.col("n").alias("reads"))


def ascii_range(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Smallest and largest character code of ``qual``."""

    @F.arrow_udf("lo int, hi int")
    def ends(text: pa.Array) -> pa.Array:
        at, x = Q.codes(text)
        x, full = x.astype(np.int32), np.diff(at) > 0
        lo, hi = np.zeros(len(full), np.int32), np.zeros(len(full), np.int32)
        if full.any():
            lo[full], hi[full] = (f.reduceat(x, at[:-1][full]) for f in (np.minimum, np.maximum))
        return pa.StructArray.from_arrays([pa.array(lo, mask=~full), pa.array(hi, mask=~full)], ["lo", "hi"])

    own = reads.select(*(keys or []), ends("qual").alias("x"))
    return own.groupBy(*(keys or [])).agg(F.min("x.lo").alias("low"), F.max("x.hi").alias("high")).filter("low is not null")


def sniff_formats(reads: DataFrame) -> DataFrame:
    """(format, fits): whether all codes lie in a format's range."""
    r = ascii_range(reads)
    rows = [F.struct(F.lit(n).alias("format"), ((F.col("low") >= f.low + f.offset) & (F.col("high") <= f.high + f.offset)).alias("fits")) for n, f in Q.FORMATS.items()]
    return r.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def tile_profile(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys (type, pair, tile) and cycle: mean, population deviation and count of the scores."""
    counts = _counted(reads, keys, "scores", "array").withColumnRenamed("pos", "cycle")
    n, x = F.col("n"), F.col("value").cast("double")
    sums = counts.groupBy(*keys, "cycle").agg(F.sum("n").alias("count"), F.sum(n * x).alias("x_"), F.sum(n * x * x).alias("xx_"))
    mean = F.col("x_") / F.col("count")
    return sums.select(*keys, "cycle", mean.alias("mean"), F.sqrt(F.greatest(F.col("xx_") / F.col("count") - mean * mean, F.lit(0.0))).alias("std"), "count")


def merge_tiles(profile: DataFrame, keys: list[str]) -> DataFrame:
    """All tiles of a cycle: the mean of their means and the sum of their counts."""
    return profile.groupBy(*keys, "cycle").agg(F.avg("mean").alias("mean"), F.sum("count").alias("count"))
