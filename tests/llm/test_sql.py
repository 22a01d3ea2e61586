"""The operators' queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from seqloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, df.select(columns).collect())) == sorted(map(str, _rows(df, want, columns)))


def _rows(df, want, columns):
    from pyspark.sql import Row

    make = Row(*columns)
    places = [want.columns.index(c) for c in columns]
    return [make(*[r[i] for i in places]) for r in want.fetchall()]
