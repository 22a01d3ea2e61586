"""Every query with SQL gives DuckDB's rows on the smallest tables; every other one runs."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from seqloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sql, name):
    df = registry.QUERIES[name](spark, SF)
    got = df.collect()
    if name in registry.ORACLE:
        want = sql.sql(registry.ORACLE[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert rows(df.columns, got) == rows(want.columns, want.fetchall())
    assert got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_optional_part_is_guarded_in_one_place():
    root = Path(__spark_entry__.__file__).parent
    assert not [p for p in (root / "seqloom").rglob("*.py") if "except ImportError" in p.read_text()]
