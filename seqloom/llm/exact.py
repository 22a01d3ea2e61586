"""Exact dedup by a heavy-hitter split, in DataFrame operations alone.

A Misra-Gries family sketch (Spark's ``approx_top_k``, a frequent-items sketch with bounded counters) names digests that may
hold a large share of the rows. Winners are computed exactly by aggregation, which shrinks a digest to one row per task before
the shuffle, so no group of copies is gathered. Those of the named digests, ``heavy`` at most, are broadcast: their rows find
the winner without a shuffle. The others' rows, none of whose digests is frequent, meet their winners by an ordinary join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Workspace, text_of


def strip_space(text: Column) -> Column:
    """Deletes every character of [\\x20\\x09-\\x0D]."""
    for c in " \t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def exact_groups(docs: DataFrame, heavy: int = 256, counters: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; a null text is an empty one, and all empty texts are equal.
    Of equal texts the one with the most code points stays, then the smallest doc_id (a null doc_id sorts first and equals
    itself). Rows that repeat a doc_id and text are all returned, and all kept if that doc_id is. Other columns are ignored.
    Empty texts are one group, a very long text is hashed whole, and an empty table gives an empty one. ``heavy`` bounds what
    is broadcast and ``counters`` the sketch; neither changes the result.
    """
    ws = Workspace(docs.sparkSession, "exact")
    digests = ws.save(
        docs.select("doc_id", F.length(text_of()).alias("size"), F.sha2(strip_space(text_of()), 256).alias("sha")), "digests"
    )
    frequent = (
        digests.agg(F.expr(f"approx_top_k(sha, {heavy}, {counters})").alias("top"))
        .select(F.explode("top").alias("t"))
        .select(F.col("t.item").alias("sha"))
    )

    def winners(rows: DataFrame) -> DataFrame:
        best = F.max_by(F.struct("doc_id"), F.struct("size", F.isnull("doc_id"), -F.col("doc_id")))["doc_id"]
        return rows.groupBy("sha").agg(best.alias("keep_id"), F.count("*").alias("group_size"))

    broadcast = ws.save(winners(digests.join(F.broadcast(frequent), "sha", "left_semi")), "winners")
    split = digests.join(F.broadcast(broadcast), "sha", "left")
    light = split.filter("group_size is null").select("doc_id", "size", "sha")
    return (
        split.filter("group_size is not null")
        .drop("size")
        .unionByName(light.drop("size").join(winners(light), "sha"))
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
    )


def drop_exact(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of equal texts, with all their columns.

    A doc_id that stands in one row goes or stays by that id. Rows that repeat a doc_id, or have none, go or stay by their text:
    of a group whose winner is such an id, its longest row stays, then the greatest text.
    """
    ws = Workspace(docs.sparkSession, "exact")
    groups = ws.save(exact_groups(docs, **options), "groups")
    several = ws.save(groups.groupBy("doc_id").agg(F.count("*").alias("n_")).filter("n_ > 1 or doc_id is null").select("doc_id"), "several")
    gone = groups.filter("not kept and doc_id is not null").select("doc_id")
    if several.isEmpty():  # every doc_id names one row
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    own = docs.join(gone, "doc_id", "left_anti").join(several, "doc_id", "left_anti").filter("doc_id is not null").select(docs.columns)
    # by text: only these few rows are hashed again and moved
    same = F.col("doc_id").eqNullSafe(F.col("id_"))
    odd = docs.join(several.withColumnRenamed("doc_id", "id_"), same, "left_semi").withColumn("sha_", F.sha2(strip_space(text_of()), 256))
    stay = groups.filter("kept").join(several.withColumnRenamed("doc_id", "id_"), same, "left_semi").select(F.col("text_sha256").alias("sha_"), F.col("doc_id").alias("id_")).distinct()
    order = Window.partitionBy("sha_").orderBy(F.desc(F.length(text_of())), F.desc_nulls_last("text"))
    rest = odd.join(stay, (odd["sha_"] == stay["sha_"]) & same, "left_semi").withColumn("place_", F.row_number().over(order)).filter("place_ = 1")
    return own.unionByName(rest.select(docs.columns))
