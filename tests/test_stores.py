"""Ids that stay, prefixes, deletes by project, and mates that change places."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import mates, prefixes, primers, trim, warehouse


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ids_stay_from_load_to_load(spark, tmp_path):
    store = warehouse.StoredIds(spark, f"file://{tmp_path}/dim", ["a", "b"], "id")
    make = lambda *x: spark.createDataFrame(list(x), "a string, b long")
    assert store.current() is None
    first = {r[1:]: r[0] for r in rows(store.load(make(("x", 1), ("b", 2), (None, 1), ("x", 1))))}
    assert sorted(first.values()) == [1, 2, 3]
    second = {r[1:]: r[0] for r in rows(store.load(make(("a", 1), ("b", 2), (None, None), (None, 1))))}
    assert first.items() <= second.items() and sorted(second.values()) == [1, 2, 3, 4, 5]
    assert {r[1:]: r[0] for r in rows(store.load(make(("a", 1))))} == second == {r[1:]: r[0] for r in rows(store.load(make()))}
    # a load that broke off left a folder behind: it isn't read
    store.spark.range(3).write.parquet(f"file://{tmp_path}/dim/aside-broken")
    assert {r[1:]: r[0] for r in rows(store.current())} == second
    other = warehouse.StoredIds(spark, f"file://{tmp_path}/dim", ["a", "b"], "id")
    assert {r[1:]: r[0] for r in rows(other.load(make(("z", 9), ("x", 1))))} == second | {("z", 9): 6}


def test_a_load_that_lost_its_number_is_made_again(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/dim"
    mine, other = (warehouse.StoredIds(spark, folder, ["a"], "id") for _ in range(2))
    real, beaten = warehouse.move, []

    def late(spark_, source, target, again=False):
        if not beaten:
            beaten.append(1)
            other.load(spark.createDataFrame([("m",), ("o",)], "a string"))
        return real(spark_, source, target, again)

    monkeypatch.setattr(warehouse, "move", late)
    got = {r["a"]: r["id"] for r in mine.load(spark.createDataFrame([("a",), ("m",)], "a string")).collect()}
    assert got == {"m": 1, "o": 2, "a": 3}


def test_prefixes(spark):
    df = spark.createDataFrame([(1, "ACGT"), (2, "AC"), (3, "TTT"), (4, ""), (5, None), (6, "A")], "i int, s string")
    keys = spark.createDataFrame([("A", 3, "one"), ("ACG", 2, "three"), ("AC", 1, "two"), ("AC", 9, "again"), ("", 0, "empty"), (None, 0, "null")], "key string, place int, name string")
    by_length = {r["i"]: r["name"] for r in prefixes.prefix_join(df, "s", keys, "key").collect()}
    assert by_length == {1: "three", 2: "two", 3: None, 4: None, 5: None, 6: "one"}
    by_place = {r["i"]: r["name"] for r in prefixes.prefix_join(df, "s", keys, "key", "place").collect()}
    assert by_place == {1: "two", 2: "two", 3: None, 4: None, 5: None, 6: "one"}
    none = prefixes.prefix_join(df, "s", keys.limit(0), "key")
    assert none.columns == ["i", "s", "key", "place", "name"] and none.filter("key is null").count() == 6
    assert [r["i"] for r in prefixes.begins_any(df, "s", spark.createDataFrame([("ACGTA",), ("TX",), (None,)], "w string"), "w").orderBy("i").collect()] == [1, 2, 4, 6]
    files = spark.createDataFrame([("ACGTAC",), ("ACG",), ("GG",)], "index string")
    samples = spark.createDataFrame([("ACGTAC_NNNNTTTTT_1",)], "demux_key string")
    assert rows(mates.wanted_files(files, samples)) == [("ACG",), ("ACGTAC",)]


def test_run_keys_of_a_table(spark):
    reads = spark.createDataFrame([("a", "l", "TAC" + "A" * 60), ("b", "l", "TA" + "C" * 60), ("c", "l", "GG" + "C" * 60)], "read_id string, lane string, seq string")
    samples = spark.createDataFrame([("TA", "l", "s"), ("TAC", "l", "t")], "run_key string, lane string, sample string")
    for keys in (["TA", "TAC"], ["TAC", "TA"]):
        table = spark.createDataFrame(list(enumerate(keys)), "place int, run_key string")
        got = [rows(trim.trim_reads(reads, samples, primers.PrimerSuite((), ()), "F", trim.TrimParams(run_keys=k, require_distal=False))) for k in (tuple(keys), table)]
        assert got[0] == got[1]


def test_delete_by_project(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "run_info_id int, x string")
    info = spark.createDataFrame([(1, 1, 1, 1, "d1"), (2, 1, 1, 2, "d2"), (3, 1, 1, 9, "d1"), (4, 2, 1, 1, "d1")], "run_info_id int, run_id int, suite_id int, project_id int, dataset string")
    runs, suites = spark.createDataFrame([(1, "r"), (2, "q")], "run_id int, run string"), spark.createDataFrame([(1, "s")], "suite_id int, suite string")
    projects = spark.createDataFrame([(1, "p"), (2, "o")], "project_id int, project string")
    left = lambda **x: [r["run_info_id"] for r in warehouse.star_delete(fact, info, runs, suites, projects, run="r", suite="s", **x).orderBy("run_info_id").collect()]
    assert left(named=["p"]) == [2, 3, 4] and left() == [3, 4] and left(named=["o"], datasets=["d1"]) == [1, 2, 3, 4] and left(datasets=["d1"]) == [2, 3, 4]


def test_mates_change_places(spark):
    a = spark.createDataFrame([("x/1", "AA", "11"), ("y/2", "CC", "22"), ("z", "G", "3")], "read_id string, seq string, qual string")
    b = spark.createDataFrame([("x/2", "TT", "44"), ("y/1", "GG", "55"), ("z", "T", "6")], "read_id string, seq string, qual string")
    assert rows(mates.join_mates(a, b)) == [("x", "AATT", "1144"), ("y", "GGCC", "5522"), ("z", "GT", "36")]
    assert mates.join_mates(a, b).select(F.length("seq")).count() == 3
