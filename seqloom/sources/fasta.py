"""FASTA and QUAL scans. Files are read by Spark's text source, so any store it reaches works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str | list[str], comments: bool = False) -> DataFrame:
    """defline, body (lines, not joined), path, pos (in file order, ascending). comments: lines that begin with # are skipped."""
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("pos"))
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    if comments:
        lines = F.filter(lines, lambda x: ~x.startswith("#"))
    lines = F.filter(lines, lambda x: F.trim(x) != "")
    head = F.regexp_replace(F.get(lines, 0), "^\\s*>", "")
    return raw.select(F.trim(head).alias("defline"), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("body"), "path", "pos").filter("defline is not null")


def read_fasta(spark: SparkSession, path: str | list[str], comments: bool = False) -> DataFrame:
    """id (the whole defline), seq (lines joined), path, pos."""
    return read_records(spark, path, comments).select(F.col("defline").alias("id"), F.array_join("body", "").alias("seq"), "path", "pos")


def with_comment(fasta: DataFrame) -> DataFrame:
    """id up to the first space and comment after it."""
    return fasta.withColumns({"comment": F.regexp_extract("id", "^\\S*\\s+(.*)$", 1), "id": F.regexp_extract("id", "^(\\S*)", 1)})


def read_decimal_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """For score files: lines with spaces are joined with spaces."""
    body = F.when(F.exists("body", lambda x: x.contains(" ")), F.array_join("body", " ")).otherwise(F.array_join("body", ""))
    return read_records(spark, path, comments=True).select(F.col("defline").alias("id"), body.alias("seq"), "path", "pos")


def read_qual(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """id, quals (integers), path, pos."""
    numbers = F.transform(F.filter(F.split(F.array_join("body", " "), "\\s+"), lambda x: x != ""), lambda x: x.cast("int"))
    return read_records(spark, path).select(F.regexp_extract("defline", "^(\\S*)", 1).alias("id"), numbers.alias("quals"), "path", "pos")


def mbl_header(defline: Column) -> dict[str, Column]:
    """id and lane of a space-separated description."""
    parts = F.split(defline, " ")
    return {"read_id": F.get(parts, 0), "lane": F.get(parts, 2)}


def attach_quality(reads: DataFrame, quals: DataFrame) -> DataFrame:
    """reads (read_id, ...) with scores of the QUAL record of the same id."""
    return reads.join(quals.select(F.col("id").alias("read_id"), F.col("quals").alias("scores")), "read_id", "left")


def combine_fastq(fasta: DataFrame, quals: DataFrame, offset: int = 33) -> DataFrame:
    """id, seq, qual of FASTA records with a QUAL record."""
    text = F.array_join(F.transform("quals", lambda x: F.char(x + offset)), "")
    return fasta.join(quals.select("id", text.alias("qual")), "id").select("id", "seq", "qual")


def count_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records per file, by counting deflines."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    return lines.groupBy("path").agg(F.count(F.when(F.col("value").startswith(">"), 1)).alias("records"))


def file_names(df: DataFrame) -> DataFrame:
    """Adds file_base, read_pair (1 or 2, by _R1 or _R2) and index (the second '_' token after an IDX prefix, else the first)."""
    base = F.regexp_extract("path", "([^/]+)$", 1)
    parts = F.split(base, "_")
    return df.withColumns({
        "file_base": F.regexp_replace(base, "[.](fa|fasta|fastq|fq|qual)([.]gz)?$", ""),
        "read_pair": F.regexp_extract(base, "_R([12])", 1).try_cast("int"),
        "index": F.when(base.startswith("IDX"), F.get(parts, 1)).otherwise(F.get(parts, 0)),
    })


def find_files(spark: SparkSession, folder: str, extension: str = "") -> DataFrame:
    """path, size and change time of the files below a folder, those of one extension if it is given. Contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{extension}").load(folder)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))
