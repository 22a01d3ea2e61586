"""Names lists in numbered blocks: however many reads share a sequence, no row holds more than a block of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .derep import _joined
from .warehouse import numbered


def _ids(position: str) -> F.Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col("read_id").alias("r")))), lambda x: x["r"])


def name_blocks(reads: DataFrame, keys: list[str], position: str = "read_id", seq: str = "seq", size: int = 10_000) -> DataFrame:
    """keys, rep_id, block, ids: the reads of each (keys, sequence), in blocks of at most ``size`` ids.

    Blocks go from 0 in the order of ``position``, ids within them too; rep_id is the first read of all, in every block. A group's first
    block may be shorter than others. Reads are numbered over all groups by ranges, and a block is what falls between two multiples
    of ``size``, so neither a task nor a row sees a whole group. Sequences are told apart by sha1; reads without one are a group.
    """
    own = reads.select(*keys, F.unhex(F.sha1(seq)).alias("hash_"), F.col(position).alias("at_"), "read_id")
    group = [*keys, "hash_"]
    placed = numbered(own, [*group, "at_", "read_id"], "n_").withColumn("chunk_", F.floor((F.col("n_") - 1) / size))
    chunks = placed.groupBy(*group, "chunk_").agg(_ids("n_").alias("ids"))
    firsts = chunks.groupBy(*group).agg(F.min_by(F.get("ids", 0), "chunk_").alias("rep_id"), F.min("chunk_").alias("least_"))
    return _joined(chunks, firsts, group).select(*keys, "rep_id", (F.col("chunk_") - F.col("least_")).alias("block"), "ids")


def clean_blocks(names: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """name_blocks without the reads ``gone`` (keys, read_id); the next read of a group stands in for a lost one.

    Blocks are numbered anew without those that lose all their reads; a group that loses all is dropped. A null key is a value here
    as elsewhere in names.
    """
    members = names.select(*keys, "rep_id", "block", F.posexplode("ids").alias("pos", "read_id"))
    lost = gone.select(*keys, "read_id").distinct().withColumnsRenamed({c: f"{c}_gone" for c in [*keys, "read_id"]})
    left = members.join(lost, [F.col(c).eqNullSafe(F.col(f"{c}_gone")) for c in [*keys, "read_id"]], "left_anti")
    kept = left.groupBy(*keys, "rep_id", "block").agg(_ids("pos").alias("ids"))
    order = Window.partitionBy(*keys, "rep_id").orderBy("block")  # a row for each block, not for each read
    again = kept.withColumns({"first_": F.first(F.get("ids", 0)).over(order), "block_": F.row_number().over(order) - 1})
    return again.select(*keys, F.col("first_").alias("rep_id"), F.col("block_").cast("long").alias("block"), "ids")


def members_of(names: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rep_id, read_id: a row for each read of names, in blocks or whole."""
    return names.select(*keys, "rep_id", F.explode("ids").alias("read_id"))
