"""Loads of the mart store: what is stored stays, tables become visible together, has_tax follows what was committed."""

from __future__ import annotations

from seqloom.operators import marts
from seqloom.sources.shared import folders, move

READS = "project string, dataset string, read_id string, seq string"
ASSIGNED = "read_id string, taxonomy string, refhvr_ids string, rank string, distance double"
INFO = "project string, title string, description string, contact string, email string, institution string, user string, env_source_id int"


def info(spark, *projects):
    return spark.createDataFrame([(p, f"title {p}", "d", "c", "e", "i", "u", 100) for p in projects], INFO)


def test_a_later_load_turns_has_tax_on(spark, tmp_path):
    store = marts.MartStore(spark, f"file://{tmp_path}/store")
    assert store.read("users") is None
    reads = spark.createDataFrame([("p", "a", "r1", "ACGT"), ("p", "a", "r2", "ACGT"), ("q", "a", "r3", "AC"), (None, "a", "r4", "AC")], READS)
    none = spark.createDataFrame([], ASSIGNED)
    assert store.load(marts.build(reads, none, info(spark, "p", "q"), "d")) == 1
    assert {(r["project"], r["has_tax"]) for r in store.read("projects_datasets").filter("project is not null").collect()} == {("P", 0), ("Q", 0)}
    assert store.read("data_cube").count() == 0 and store.read("sequences").filter("rank = 'NA' and distance = 1").count() == 2
    told = spark.createDataFrame([("r9", "Bacteria;X;NA", "v1", "phylum", 0.1)], ASSIGNED)
    more = reads.unionByName(spark.createDataFrame([("p", "b", "r9", "TT")], READS))
    assert store.load(marts.build(more, told, info(spark, "p", "q", "r"), "later")) == 2
    rows = {(r["project"], r["dataset"]): r for r in store.read("projects_datasets").filter("project is not null").collect()}
    assert {k: r["has_tax"] for k, r in rows.items()} == {("P", "a"): 1, ("P", "b"): 1, ("Q", "a"): 0}
    assert rows["P", "a"]["date_trimmed"] == "d" and rows["P", "b"]["date_trimmed"] == "later"  # a stored row stays as it is
    assert {(r["project"], r["has_tax"]) for r in store.read("project_info").collect()} == {("P", 1), ("Q", 0), ("R", 0)}
    assert store.read("users").count() == 3 and store.read("exports").count() == 1
    before = {name: store.read(name).count() for name in marts.KEYS}
    store.load(marts.build(more, told, info(spark, "p", "q", "r"), "again"))
    assert {name: store.read(name).count() for name in marts.KEYS} == before
    assert [r["taxonomy"] for r in store.read("data_cube").collect()] == ["Bacteria;X"]


def test_a_load_that_breaks_off_is_not_read_and_a_taken_number_is_left(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/store"
    store = marts.MartStore(spark, root)
    users = spark.createDataFrame([("P", "u"), ("P", "u"), ("P", None)], "project string, user string")
    users.write.parquet(f"{root}/aside-broken/users")
    assert store.read("users") is None
    other = spark.createDataFrame([("P", "u")], "project string, user string")
    raced = []

    def beaten(*args, **options):
        if not raced:
            raced.append(1)
            other.write.parquet(f"{root}/load=1/users")
        return move(*args, **options)

    monkeypatch.setattr(marts, "move", beaten)
    assert store.load({"users": users}) == 2
    assert sorted((r["project"], r["user"] or "") for r in store.read("users").collect()) == [("P", ""), ("P", "u")]
    assert sorted(folders(spark, root)) == ["aside-broken", "load=1", "load=2"]


def test_of_rows_with_one_key_the_least_is_stored(spark, tmp_path):
    store = marts.MartStore(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([("T", 1, 1), ("T", 1, 0), ("T", 2, 1)], "taxon_string string, rank int, num_kids int")
    store.load({"taxonomy": rows})
    assert sorted(map(tuple, store.read("taxonomy").collect())) == [("T", 1, 0), ("T", 2, 1)]
