"""The change applier against a row-by-row version of what it promises."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from seqloom.llm import queries, sequenced

SF = "/root/testdata/sf0.001"
CHANGES = "change_id long, client_id long, seq long, op string, city string, balance double, day int, batch int"


def applied(rows, batches, wait):
    """rows: dicts of CHANGES. One row at a time, as the rules are told."""
    by_client = defaultdict(set)
    for r in rows:
        by_client[r["client_id"]].add((r["seq"] is not None, r["seq"] or 0))
    rank = {c: {s: i + 1 for i, s in enumerate(sorted(own))} for c, own in by_client.items()}
    kept = [r | {"n": rank[r["client_id"]][(r["seq"] is not None, r["seq"] or 0)]} for r in rows if r["day"] is not None]
    state = defaultdict(lambda: {"next": 1, "held": {}, "city": None, "balance": None, "last": None})
    out, largest = {}, None

    def put(c, batch, missed=0):
        s = state[c]
        while (r := s["held"].pop(s["next"], None)) is not None:
            if r["op"] in ("I", "D") or r["op"] == "U" and r["city"] is not None:
                s["city"] = None if r["op"] == "D" else r["city"]
            if r["op"] in ("I", "D") or r["op"] == "U" and r["balance"] is not None:
                s["balance"] = None if r["op"] == "D" else r["balance"]
            s["last"] = (id(r), r["op"])
            out[id(r)] = (r["change_id"], c, "applied", batch, missed, s["city"], s["balance"])
            s["next"], missed = s["next"] + 1, 0

    for batch in range(1, batches + 2):
        for c, s in list(state.items()):
            while s["held"] and (batch > batches or min(r["day"] for r in s["held"].values()) + wait <= largest):
                to = min(s["held"])
                missed, s["next"] = to - s["next"], to
                put(c, batch, missed)
        new = sorted((r for r in kept if r["batch"] == batch), key=lambda r: (r["day"], r["change_id"]))
        for r in new:
            s = state[r["client_id"]]
            if r["n"] in s["held"] or r["n"] < s["next"]:
                out[id(r)] = (r["change_id"], r["client_id"], "rejected", batch, 0, None, None)
            else:
                s["held"][r["n"]] = r
                put(r["client_id"], batch)
        largest = max([r["day"] for r in new] + ([largest] if largest is not None else []), default=None)
    current = {s["last"][0] for s in state.values() if s["last"] and s["last"][1] != "D"}
    return sorted((*v, k in current) for k, v in out.items())


def compared(spark, rows, batches=3, wait=5, **more):
    frame = spark.createDataFrame([tuple(r[c.split()[0]] for c in CHANGES.split(", ")) for r in rows], CHANGES)
    got = [tuple(r) for r in sequenced.apply_changes(frame, batches, wait, **more).collect()]
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(got, key=key) == sorted(applied(rows, batches, wait), key=key)
    return got


def row(change_id, client_id, seq, day, op="U", city=None, balance=None, batch=None):
    return {"change_id": change_id, "client_id": client_id, "seq": seq, "op": op, "city": city, "balance": balance, "day": day, "batch": batch if batch is not None else None if day is None else 1 + day // 10}


def test_gaps_late_rows_and_waiting(spark):
    rows = [
        row(1, 1, 10, 0, "I", "A", 1.0), row(2, 1, 30, 1, "U", None, 3.0), row(3, 1, 20, 2, "U", "B", None),  # in order after one wait
        row(4, 2, 1, 0, "I", "A", 1.0), row(5, 2, 2, None), row(6, 2, 3, 3, "U", "C", None), row(7, 2, 4, 12, "D"), row(8, 2, 2, 14, "U", "late", 9.0),
        row(9, 3, 5, 1, "I", "A", 2.0), row(10, 3, 5, 2, "I", "again", 2.0), row(11, 3, 6, 25, "X", "broken", 5.0), row(12, 3, 5, 25, "U", "third", 2.0),
        row(13, None, None, 4, "I", "null client", None), row(14, None, 1, 5, "U", None, 7.0), row(15, 4, 1, None), row(16, 4, 2, 2, "I", "jumped", 1.0),
        row(17, 4, 3, 3, None, "no op", 1.0), row(18, 5, 1, None), row(19, 5, 2, 8, "I", "waits", 0.0), row(20, 5, 3, 28, "D"),
    ]
    got = {r[0]: r for r in compared(spark, rows)}
    assert got[6][2:5] == ("applied", 2, 1) and got[8][2] == "rejected" and not got[7][7]
    assert got[16][3:6] == (2, 1, "jumped") and got[19][3:5] == (3, 1) and got[13][5] == "null client"


def test_empty_batches_tick_and_equal_rows_stand_apart(spark):
    rows = [row(1, 1, 1, None), row(2, 1, 2, 1, "I", "A", 1.0, batch=1), row(3, 2, 1, 8, "I", "B", 1.0, batch=1), row(4, 2, 1, 8, "I", "B", 1.0, batch=1), row(4, 2, 1, 8, "I", "B", 1.0, batch=1)]
    got = compared(spark, rows, batches=4)
    assert {r[0]: r[3] for r in got}[2] == 2 and sorted(r[2] for r in got if r[1] == 2) == ["applied", "rejected", "rejected"]
    none = compared(spark, [row(1, 1, 1, None)], batches=2)
    assert none == []
    empty = spark.createDataFrame([], CHANGES)
    assert sequenced.apply_changes(empty, 2).count() == 0


def test_random_changes_with_a_client_of_a_third_of_all_rows(spark):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(1500):
        client = 0 if i % 3 == 0 else rng.randrange(40)
        seq = i // 3 + rng.randrange(-4, 5) if client == 0 else rng.randrange(30)
        day = rng.choice([None, *[min(39, i // 40 + rng.randrange(0, 12))] * 9])
        rows.append(row(i, client, seq, day, rng.choice("IUUUUD"), rng.choice([None, "x" * rng.randrange(1, 4)]), rng.choice([None, rng.randrange(99) / 4])))
    got = compared(spark, rows, batches=4, block=16, buckets=7)
    assert {r[2] for r in got} == {"applied", "rejected"} and max(r[4] for r in got) > 1 and {r[3] for r in got} == {1, 2, 3, 4, 5}


def test_very_long_values_and_clashing_columns(spark):
    rows = [row(1, 1, 1, 0, "I", "x" * 300_000, 1.0), row(2, 1, 2, 1, "U", None, 2.0)]
    frame = spark.createDataFrame([tuple(r[c.split()[0]] for c in CHANGES.split(", ")) for r in rows], CHANGES)
    clash = frame.withColumns({c: F.lit(None).cast("string") for c in ("n", "bucket", "tick", "fragment", "first", "last", "earliest", "status", "missed", "current", "tie_", "first_", "part_")})
    got = sorted(map(tuple, sequenced.apply_changes(clash, 1).collect()))
    assert got == [(1, 1, "applied", 1, 0, "x" * 300_000, 1.0, False), (2, 1, "applied", 1, 0, "x" * 300_000, 2.0, True)]


@pytest.mark.parametrize("sf", [SF])
def test_query(spark, sf):
    raw = {tuple(r) for r in spark.read.parquet(f"{sf}/client_changes.parquet").collect()}
    rows = []
    for change_id, client_id, seq, op, valid_at, _, _, city, balance in raw:
        h = zlib.crc32(str(change_id).encode())
        day = None if valid_at is None or h % 11 == 0 else (valid_at - datetime(1970, 1, 1)).days + 2 * (h % 4)
        rows.append(row(change_id, client_id, seq, day, op, city, balance, 0 if day is None else min(8, 1 + (day - 19723) * 8 // 160)))
    want = [(*r[:6], None if r[6] is None else math.floor(100 * r[6] + 0.5), r[7]) for r in applied(rows, 8, 5)]
    got = [tuple(r) for r in queries.op11_sequenced_changes(spark, sf).collect()]
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert date(1970, 1, 1).toordinal() + 19723 == date(2024, 1, 1).toordinal()
