"""Set algebra of sequence sets, keyed by id, and multiset helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .warehouse import numbered


def plus(a: DataFrame, b: DataFrame, on: str = "id") -> DataFrame:
    """All rows; of an id in both, the right one."""
    return b.unionByName(a.join(b, on, "left_anti"))


def either(a: DataFrame, b: DataFrame, on: str = "id") -> DataFrame:
    """All rows; of an id in both, the left one."""
    return a.unionByName(b.join(a, on, "left_anti"))


def both(a: DataFrame, b: DataFrame, on: str = "id") -> DataFrame:
    """Left rows whose id is in both."""
    return a.join(b, on, "left_semi")


def minus(a: DataFrame, b: DataFrame, on: str = "id", strict: bool = False) -> DataFrame:
    """Left rows whose id isn't in ``b``; strict: an id of ``b`` that ``a`` lacks is an error."""
    if strict and not b.join(a, on, "left_anti").isEmpty():
        raise KeyError("the right set isn't within the left one")
    return a.join(b, on, "left_anti")


def same_ids(a: DataFrame, b: DataFrame, on: str = "id") -> bool:
    return a.join(b, on, "left_anti").isEmpty() and b.join(a, on, "left_anti").isEmpty()


def contains_all(a: DataFrame, b: DataFrame, on: str = "id") -> bool:
    return b.join(a, on, "left_anti").isEmpty()


def last_wins(rows: DataFrame, position: str, on: str = "id") -> DataFrame:
    """Of rows that repeat an id the last by position."""
    others = [c for c in rows.columns if c not in (on, position)]
    return rows.groupBy(on).agg(F.max_by(F.struct(*others), position).alias("x")).select(on, "x.*")


def occurrence(rows: DataFrame, position: str, on: str = "id") -> DataFrame:
    """Adds occurrence, the number of an id's row in order: the k-th request for an id meets its k-th row by a join on both."""
    return rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(on).orderBy(position)))


def named_access(rows: DataFrame, requests: DataFrame, position: str, on: str = "id") -> tuple[DataFrame, DataFrame]:
    """(found, unread): rows met by requests (id, position), and rows that none asked for."""
    have, want = occurrence(rows, position, on), occurrence(requests.select(on, position), position, on).drop(position)
    return have.join(want, [on, "occurrence"]), have.join(want, [on, "occurrence"], "left_anti")


def set_value(rows: DataFrame, key: str, value: str, on: str = "id") -> DataFrame:
    return rows.filter(F.col(on) != key).unionByName(rows.sparkSession.createDataFrame([(key, value)], f"{on} string, seq string"))


def position_range(rows: DataFrame, start: int, end: int, position: str) -> DataFrame:
    """Rows start..end (from 1, both in) by position."""
    return numbered(rows, [position], "p_").filter(F.col("p_").between(start, end)).drop("p_")


def fates(reads: DataFrame) -> DataFrame:
    """Per fate the number of reads. reads: read_id, fate."""
    return reads.groupBy("fate").agg(F.countDistinct("read_id").alias("reads"))
