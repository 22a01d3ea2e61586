"""Small helpers all operators use, and the shared folder's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import Workspace, scratch, shared_dir  # noqa: F401


def text_of(col: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key written as text, modulo n. Null keys count as the text 'null'."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null"))) % n


def bounded_sample(rows: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """Of each ``key`` the ``most`` rows of smallest hash of ``by``.

    A key's hashes are cut at a share of its count that leaves about twice as many, so ranking them is small work for any count.
    """
    hashed = rows.withColumn("hash_", F.shiftrightunsigned(F.xxhash64(by), 1))
    counts = rows.groupBy(key).agg(F.count("*").alias("all_"))
    near = hashed.join(counts, key).filter(F.col("hash_") <= F.lit(2.0**63 * (2 * most + 100)) / F.col("all_"))
    order = Window.partitionBy(key).orderBy("hash_", by)
    return near.withColumn("place_", F.row_number().over(order)).filter(F.col("place_") <= most).select(rows.columns)


def one_of_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with one row of each doc_id: the longest, then the greatest text. ``ids`` has the doc_id of every row of docs.

    Only rows whose doc_id stands twice in ``ids`` are moved and ranked. Rows without a doc_id all stay.
    """
    ws = Workspace(docs.sparkSession, "one")
    twice = ws.save(ids.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n_")).filter("n_ > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return docs
    order = Window.partitionBy("doc_id").orderBy(F.desc(F.length(text_of())), F.desc(text_of()))
    several = docs.join(twice, "doc_id", "left_semi").withColumn("place_", F.row_number().over(order)).filter("place_ = 1")
    return docs.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(several.select(docs.columns))
