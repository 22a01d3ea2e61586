"""Queries by name, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What Python is handed at a time. Reads of thousands of bases, by 10,000 or 64 MB, become gigabytes of scores in a task's Python.
BATCH = "4m"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str):
    """Registers a function as a query; whole numbers come out as bigint."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
            df = f(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("long") for c, k in df.dtypes if k in ("int", "smallint", "tinyint")})

        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = (f"with {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add
