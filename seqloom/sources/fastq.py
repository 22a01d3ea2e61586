"""FASTQ scans. A quality line may begin with @, so records are found by line number, not by their first letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as S
from .ranges import FastqFiles, FastqRanges


def _numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, path and line (from 0 within its file), split files included: each block's lines are counted, then summed."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    blocks = raw.groupBy("path", "block").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = F.coalesce(F.expr("sum(n) over (partition by path order by block rows between unbounded preceding and 1 preceding)"), F.lit(0))
    starts = blocks.select("path", "block", (earlier - F.col("first")).alias("shift"))
    return raw.join(starts, ["path", "block"]).select("value", "path", (F.col("row") + F.col("shift")).alias("line"))


def read_fastq(spark: SparkSession, path: str | list[str], trim_from: int = 0, trim_to: int | None = None, strict: bool = True) -> DataFrame:
    """Four-line records, gzip or plain: header, seq, qual, the ten header fields, path, record, and error.

    error says what is wrong with a record: no '@', no '+', or lengths that differ. strict: such a record fails the query, with
    its file and lines. A header without ten fields leaves the fields null.
    """
    lines = _numbered_lines(spark, path)
    rows = lines.groupBy("path", F.floor(F.col("line") / 4).alias("record")).agg(
        *[F.max(F.when(F.col("line") % 4 == k, F.regexp_replace("value", "\r$", ""))).alias(n) for k, n in enumerate(("head", "seq", "plus", "qual"))]
    )
    rows = rows.filter("not (coalesce(head, '') = '' and coalesce(seq, '') = '' and coalesce(plus, '') = '')")
    where = F.concat(F.lit(" in "), "path", F.lit(", lines "), F.col("record") * 4 + 1, F.lit(" to "), F.col("record") * 4 + 4)
    error = (
        F.when(~F.coalesce(F.col("head"), F.lit("")).startswith("@"), F.concat(F.lit("no @"), where))
        .when(~F.coalesce(F.col("plus"), F.lit("")).startswith("+"), F.concat(F.lit("no +"), where))
        .when(F.length(F.coalesce("seq", F.lit(""))) != F.length(F.coalesce("qual", F.lit(""))), F.concat(F.lit("lengths differ"), where))
    )
    return _with_fields(rows.withColumn("error", error), trim_from, trim_to, strict, F.regexp_replace("head", "^@", ""), "path", "record")


def _with_fields(rows: DataFrame, trim_from: int, trim_to: int | None, strict: bool, header: Column, *more: str) -> DataFrame:
    if strict:
        rows = rows.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.lit(None).cast("string")))
    full = F.size(F.split(header, ":")) == 10
    fields = {n: F.when(full, c) for n, c in S.illumina_header(header).items()}
    cut = lambda c: S.cut(F.coalesce(F.col(c), F.lit("")), trim_from, trim_to)
    return rows.select(header.alias("header"), cut("seq").alias("seq"), cut("qual").alias("qual"), *[c.alias(n) for n, c in fields.items()], *more, "error")


def scan_fastq(spark: SparkSession, path: str | list[str], trim_from: int = 0, trim_to: int | None = None, strict: bool = True, range_bytes: int = 64 << 20) -> DataFrame:
    """What ``read_fastq`` gives, in one scan of byte ranges and without a shuffle: start and end, a record's bytes, instead of its number.

    For files that Arrow's file systems reach; gzip files are a range each. A record that can't be read is told with its bytes up
    to the next one that can; not ``strict``, the records after it are there. Lines of a blank stand between records.
    """
    spark.dataSource.register(FastqRanges)
    rows = spark.read.format("fastq_ranges").option("rangeBytes", range_bytes).load("\n".join([path] if isinstance(path, str) else path))
    return _with_fields(rows, trim_from, trim_to, strict, F.col("header"), "path", "start", "end")


def read_multiline_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records whose sequence and quality go over several lines: header, seq, qual, path, record, error. A file is read by one task,
    line by line, so that it needs memory for some records only, whatever the file's size.

    Blank lines before a header are skipped; a '+' line is bare or repeats the header; quality is read up to the sequence's length.
    """
    spark.dataSource.register(FastqFiles)
    return spark.read.format("fastq_files").load("\n".join([path] if isinstance(path, str) else path))
