"""Reads of any supported input format as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fasta import mbl_header, read_fasta
from .fastq import read_fastq

# Which parser reads an input format; others are parsed by their own name.
PARSERS = {"fastq-illumina": "fastq", "fastq-sanger": "fastq", "fasta-mbl": "fasta", "sff": "sff-trim"}


def parser_of(kind: str) -> str:
    return PARSERS.get(kind, kind)


def read_reads(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """FASTQ kinds as of ``read_fastq``; FASTA as of ``read_fasta``, with read_id and lane of its header for fasta-mbl.

    Binary SFF has no reader here: convert it to FASTQ first.
    """
    parser = parser_of(kind)
    if parser == "fastq":
        return read_fastq(spark, path)
    if parser == "fasta":
        df = read_fasta(spark, path)
        return df.withColumns(mbl_header(F.col("id"))) if kind == "fasta-mbl" else df
    raise NotImplementedError(f"no reader for {kind}")
