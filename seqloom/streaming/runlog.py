"""Incremental ingestion: new read files are counted and dereplicated as they arrive, with the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.derep import counts


def running_counts(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Streaming counts of unique sequences per keys: state is one row per keys and sequence."""
    return reads.groupBy(*keys, "seq").agg(F.count("*").alias("seq_count"))


def ingest(reads: DataFrame, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch's counts to a Parquet folder, a batch_id with each row, so that a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts(batch, keys).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return reads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
