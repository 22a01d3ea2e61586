"""Names in blocks and counters of a trimming run, on rows with nulls, ties and repeats."""

from __future__ import annotations

from collections import defaultdict

from seqloom.operators import names, trim

COLUMNS = "sample string, read_id string, at long, seq string"


def test_blocks_hold_every_read_in_order(spark):
    rows = [("s" if i % 4 else None, f"r{i}", (i * 7) % 50, ["ACGT", "AC", None, ""][i % 3 if i % 5 else 3]) for i in range(200)] + [("s", "r1", 7, "AC")] * 2
    df = spark.createDataFrame(rows, COLUMNS)
    blocks = names.name_blocks(df, ["sample"], position="at", size=7)
    want = defaultdict(list)
    for sample, read_id, at, seq in rows:
        want[sample, seq].append((at, read_id))
    got, first = defaultdict(list), set()
    for r in sorted(blocks.collect(), key=lambda r: r["block"]):
        assert 0 < len(r["ids"]) <= 7
        key = r["sample"], r["rep_id"]
        assert r["block"] == len(got[key])
        got[key].append(r["ids"])
        first.add(key)
    assert sorted([x for b in v for x in b] for v in got.values()) == sorted([r for _, r in sorted(v)] for v in want.values())
    assert all(v[0][0] == rep for (_, rep), v in got.items()) and len(first) == len(want)
    gone = df.filter("at % 2 = 0").unionByName(df.filter("seq = ''"))
    left = defaultdict(list)
    for r in sorted(names.clean_blocks(blocks, gone, ["sample"]).collect(), key=lambda r: r["block"]):
        assert r["block"] == len(left[r["sample"], r["rep_id"]])
        left[r["sample"], r["rep_id"]].append(r["ids"])
    lost = {(r["sample"], r["read_id"]) for r in gone.collect()}
    kept = [[r for _, r in sorted(v) if (s, r) not in lost] for (s, _), v in want.items()]
    assert sorted([x for b in v for x in b] for v in left.values()) == sorted(v for v in kept if v)
    assert all(v[0][0] == rep for (_, rep), v in left.items())
    assert names.name_blocks(df.filter("false"), ["sample"]).count() == 0


def test_counters_are_those_of_the_rows(spark, tmp_path):
    rows = [(f"r{i}", "ACGT"[: i % 5] or None, i % 3 == 0, trim.REASONS[i % len(trim.REASONS)] if i % 3 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "read_id string, trimmed string, deleted boolean, delete_reason string").repartition(3)
    found = trim.write_counted(df, f"file://{tmp_path}/t")
    assert spark.read.parquet(f"file://{tmp_path}/t").count() == found["raw"] == 60
    assert found["deleted"] == 20 == sum(found[r] for r in trim.REASONS) and found["passed"] == 40
    assert found["bases"] == sum(len(r[1] or "") for r in rows if not r[2])
    empty = trim.write_counted(df.filter("false"), f"file://{tmp_path}/e")
    assert set(empty.values()) == {0}
