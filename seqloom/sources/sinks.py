"""Writers. Lines are made by expressions and written by Spark, one file a partition; existing output is an error unless asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quality as Q


def fasta_lines(name: Column, seq: Column, wrap: int = 0, case: str = "", star: bool = False) -> Column:
    """A record's text. wrap: columns a line; case: 'upper' or 'lower'; star: '*' after the sequence."""
    body = {"upper": F.upper, "lower": F.lower}.get(case, lambda s: s)(seq)
    body = F.concat(body, F.lit("*")) if star else body
    if wrap:
        body = F.rtrim(F.regexp_replace(body, f"(.{{{wrap}}})", "$1\n"), F.lit("\n"))
    return F.concat(F.lit(">"), name, F.lit("\n"), body)


def write_fasta(df: DataFrame, path: str, name: str = "id", wrap: int = 0, mode: str = "errorifexists", **options) -> None:
    df.select(fasta_lines(F.col(name), F.col("seq"), wrap, **options).alias("value")).write.mode(mode).text(path)


def write_fastq(df: DataFrame, path: str, compress: bool = False, mode: str = "errorifexists") -> None:
    """df: header, seq, qual."""
    text = F.concat(F.lit("@"), "header", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    df.select(text.alias("value")).write.mode(mode).option("compression", "gzip" if compress else "none").text(path)


def write_fastq_as(df: DataFrame, path: str, source: str, target: str, **options) -> None:
    """Writes FASTQ with qualities of one format as those of another."""
    write_fastq(df.withColumn("qual", Q.reencode(F.col("qual"), source, target)), path, **options)


def write_demultiplexed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """FASTQ below sample=.../pair=...; reads without a sample go to 'unknown'."""
    text = F.concat(F.lit("@"), "header", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    rows = df.select(text.alias("value"), F.coalesce("sample", F.lit("unknown")).alias("sample"), "pair")
    rows.write.mode(mode).partitionBy("sample", "pair").text(path)


def write_tables(tables: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """Named tables as Parquet below a folder: trim outputs, marts, the warehouse."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")


def write_mart_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated with a header row; each line begins with an empty cell, headed HEADER."""
    df.select(F.lit("").alias("HEADER"), *df.columns).write.mode(mode).option("header", True).option("sep", "\t").option("quote", "").csv(path)


def write_names(names: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """rep_id and its ids, comma-separated."""
    names.select(F.concat_ws("\t", "rep_id", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("value")).write.mode(mode).text(path)


def write_name_blocks(names: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A line for each block of ``names.name_blocks``: rep_id, the block's number and its ids, comma-separated."""
    ids = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    names.select(F.concat_ws("\t", "rep_id", "block", ids).alias("value")).write.mode(mode).text(path)
