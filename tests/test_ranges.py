"""FASTQ byte ranges: every record once, wherever files are cut, and what is wrong with which bytes."""

from __future__ import annotations

import gzip
import random

import pytest

from seqloom.sources import fastq


def records(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.randrange(0, 40)
        out.append((f"@M:1:F:1:1101:{i}:7 1:N:0:ACG", "".join(rng.choice("ACGT") for _ in range(size)), "+", "".join(rng.choice("@+I5") for _ in range(size))))
    return out


def test_every_cut_gives_the_same_records(spark, tmp_path):
    own = records(60)
    (tmp_path / "a.fq").write_text("\n".join("\n".join(r) for r in own) + "\n")
    (tmp_path / "_hidden").write_text("@x")
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write("\r\n".join("\r\n".join(r) for r in own))  # no line end after the last one
    for size in (1 << 20, 700, 97, 31):
        got = fastq.scan_fastq(spark, str(tmp_path), range_bytes=size)
        for name in ("a.fq", "b.fq.gz"):
            rows = [r for r in got.collect() if r["path"].endswith(name)]
            assert sorted((r["header"], r["seq"], r["qual"]) for r in rows) == sorted((r[0][1:], r[1], r[3]) for r in own)
            places = sorted((r["start"], r["end"]) for r in rows)
            assert all(a[1] == b[0] for a, b in zip(places, places[1:], strict=False)) and places[0][0] == 0
    slow = fastq.read_fastq(spark, str(tmp_path / "a.fq"), trim_from=1, trim_to=9)
    fast = fastq.scan_fastq(spark, f"file://{tmp_path}/a.f*", trim_from=1, trim_to=9, range_bytes=300)
    columns = [c for c in slow.columns if c not in ("path", "record")]
    assert sorted(map(str, slow.select(columns).collect())) == sorted(map(str, fast.select(columns).collect()))
    assert "Exchange" not in fast._jdf.queryExecution().toString()


def test_bad_records_are_told_with_their_bytes(spark, tmp_path):
    good = ["\n".join(r) + "\n" for r in records(9, 2)]
    bad = {2: "@short\nACGT\n+\nIII\n", 4: "no at\nAC\n+\nII\n", 6: "@cut\nACGT\n"}
    parts = [x for i, g in enumerate(good) for x in ([bad[i]] if i in bad else []) + [g]]
    text = "".join(parts[:3]) + "\n" + "".join(parts[3:]) + "@end\nAC\n+\nI"
    (tmp_path / "x.fq").write_text(text)
    got = fastq.scan_fastq(spark, str(tmp_path / "x.fq"), strict=False).orderBy("start").collect()
    assert sorted(r["header"] for r in got if r["error"] is None) == sorted(g.split("\n")[0][1:] for g in good)
    wrong = [(r["error"].split(" in ")[0], text[r["start"] : r["end"]]) for r in got if r["error"]]
    assert wrong == [("lengths differ", bad[2]), ("no @", bad[4]), ("no +", bad[6]), ("lengths differ", "@end\nAC\n+\nI")]
    with pytest.raises(Exception, match="lengths differ in .*bytes"):
        fastq.scan_fastq(spark, str(tmp_path / "x.fq")).collect()
    (tmp_path / "empty.fq").write_text("")
    assert fastq.scan_fastq(spark, str(tmp_path / "empty.fq")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        fastq.scan_fastq(spark, str(tmp_path / "nowhere")).count()
