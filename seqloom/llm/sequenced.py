"""Changes applied in the order of their sequence numbers: a stateful stream holds what came too early and gives up on gaps in time.

A client's rows are applied by number, 1, 2, 3 ...; a row that comes too early is held. Holding ends when the missing number comes,
or when the client's earliest held row has waited long enough: then the numbers in between are given up.

The stream's state is keyed by bucket of clients. A bucket has a timing wheel: expiry day -> the clients whose earliest held row
expires then. A tick visits the due slots only, jumps their clients over their gaps and puts them into the slot of their new earliest
day. What enters the state are fragments: runs of consecutive numbers that came in one batch, with the first and last number, the
earliest day and what applying them all sets. A fragment is applied or turned down as a whole, for the number before the next
expected one has always been applied. So a client with a third of all rows sends its gaps through one task, not its rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.warehouse import numbered
from ..sources.shared import move
from ._shared import Workspace

#: Ticks before all days and after them.
_NEVER, _ALL = -(1 << 31), (1 << 31) - 1

_FEED = """bucket long, tick int, batch int, change_id long, client_id long, first boolean, n long, fragment long, last boolean,
  earliest int, op string, city struct<value: string>, balance struct<value: double>"""
_MOVED = "client_id long, fragment long, batch int, missed long, city string, balance double, final boolean"
_STATE = """ids array<bigint>, expected array<bigint>, newest array<bigint>, city array<string>, balance array<double>,
  held_by array<int>, held_from array<bigint>, held_to array<bigint>, held_day array<int>, held_sets array<int>, held_city array<string>,
  held_balance array<double>, wheel_day array<int>, wheel_id array<bigint>"""


class Client:
    """Of one client: the number expected next, the values so far, the fragment applied last, and what is held."""

    __slots__ = ("expected", "newest", "city", "balance", "held", "days", "slot")

    def __init__(self, expected: int = 1, newest: int | None = None, city: str | None = None, balance: float | None = None):
        self.expected, self.newest, self.city, self.balance = expected, newest, city, balance
        self.held: list[tuple] = []  # a heap of (first number, last number, earliest day, what is set, city, balance)
        self.days: list[tuple[int, int]] = []  # a heap of (earliest day, first number); applied fragments leave it when they surface
        self.slot: int | None = None

    def hold(self, fragment: tuple) -> None:
        heapq.heappush(self.held, fragment)
        heapq.heappush(self.days, (fragment[2], fragment[0]))

    def earliest(self) -> int | None:
        while self.days and self.days[0][1] < self.expected:
            heapq.heappop(self.days)
        return self.days[0][0] if self.days else None

    def advance(self, missed: int = 0) -> Iterator[tuple]:
        """Applies what is expected, as far as it goes: (first number, numbers missed before it, city and balance before it)."""
        while self.held and self.held[0][0] == self.expected:
            first, last, _, sets, city, balance = heapq.heappop(self.held)
            yield first, missed, self.city, self.balance
            self.city, self.balance = city if sets & 1 else self.city, balance if sets & 2 else self.balance
            self.newest, self.expected, missed = first, last + 1, 0


class Bucket:
    """Clients and their timing wheel."""

    def __init__(self, wait: int):
        self.wait = wait
        self.clients: dict[int | None, Client] = {}
        self.wheel: dict[int, set] = {}

    def schedule(self, key: int | None) -> None:
        client = self.clients[key]
        day = client.earliest()
        slot = None if day is None else day + self.wait
        if slot != client.slot:
            if client.slot is not None and key in self.wheel.get(client.slot, ()):
                self.wheel[client.slot].discard(key)
            if slot is not None:
                self.wheel.setdefault(slot, set()).add(key)
            client.slot = slot

    def tick(self, today: int) -> Iterator[tuple]:
        for slot in sorted(s for s in self.wheel if s <= today):
            for key in self.wheel.pop(slot):
                client = self.clients[key]
                client.slot = None
                while (day := client.earliest()) is not None and day + self.wait <= today:
                    missed, client.expected = client.held[0][0] - client.expected, client.held[0][0]
                    for x in client.advance(missed):
                        yield key, *x
                self.schedule(key)

    def take(self, arrived: list[tuple]) -> Iterator[tuple]:
        """(client, fragment) pairs of one batch, in any order."""
        touched = set()
        for key, fragment in arrived:
            client = self.clients.setdefault(key, Client())
            if fragment[0] >= client.expected:
                client.hold(fragment)
                touched.add(key)
        for key in touched:
            for x in self.clients[key].advance():
                yield key, *x
            self.schedule(key)

    @classmethod
    def load(cls, wait: int, state: tuple) -> Bucket:
        out = cls(wait)
        ids, expected, newest, city, balance, by, *held, days, of = state
        clients = [Client(*x) for x in zip(expected, newest, city, balance, strict=True)]
        out.clients = dict(zip(ids, clients, strict=True))
        for k, *fragment in zip(by, *held, strict=True):
            clients[k].held.append(tuple(fragment))
        for client in clients:
            heapq.heapify(client.held)
            client.days = [(f[2], f[0]) for f in client.held]
            heapq.heapify(client.days)
        for day, key in zip(days, of, strict=True):
            out.wheel.setdefault(day, set()).add(key)
            out.clients[key].slot = day
        return out

    def dump(self) -> tuple:
        own = list(self.clients.values())
        held = [(k, *f) for k, c in enumerate(own) for f in c.held]
        slots = [(day, key) for day, keys in self.wheel.items() for key in keys]
        return (
            list(self.clients),
            *([getattr(c, name) for c in own] for name in ("expected", "newest", "city", "balance")),
            *([f[i] for f in held] for i in range(7)),
            *([s[i] for s in slots] for i in range(2)),
        )


def _turn(wait: int):
    """The stream's step for a bucket: its tick first, then what has come."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        today, batch, arrived = _NEVER, 0, []
        for f in frames:
            for tick, number in f.loc[f["tick"].notna(), ["tick", "batch"]].itertuples(index=False):
                today, batch = int(tick), int(number)
            came = f[f["tick"].isna()]
            none = lambda x: None if pd.isna(x) else x
            for client, first, last, day, sets, city, balance in zip(*(came[c] for c in ("client_id", "fragment", "n", "earliest", "sets", "new_city", "new_balance")), strict=True):
                arrived.append((None if pd.isna(client) else int(client), (int(first), int(last), int(day), int(sets), none(city), none(balance))))
        bucket = Bucket.load(wait, state.get) if state.exists else Bucket(wait)
        moved = [(k, first, batch, missed, city, balance, False) for k, first, missed, city, balance in (*bucket.tick(today), *bucket.take(arrived))]
        if today == _ALL:
            moved += [(k, c.newest, batch, 0, None, None, True) for k, c in bucket.clients.items() if c.newest is not None]
        state.update(bucket.dump())
        out = pd.DataFrame(moved, columns=["client_id", "fragment", "batch", "missed", "city", "balance", "final"])
        yield out.astype({"client_id": "Int64", "fragment": "Int64", "batch": "Int32", "missed": "Int64", "city": object, "balance": "Float64", "final": bool})

    return run


def with_numbers(changes: DataFrame) -> DataFrame:
    """(client_id, seq, n, and of the row to apply: first_): n is the dense rank of seq in its client, null ones first.

    Of the rows of one client and seq, the first by batch, day and change_id can be applied; rows without a day take part in the
    rank alone. Ranks come from range partitions of (client_id, seq), so a client with most of the rows is numbered by many tasks.
    """
    ws = Workspace(changes.sparkSession, "numbers")
    own = F.struct("batch", "day", "change_id", "tie_", "op", "city", "balance")
    pairs = changes.groupBy("client_id", "seq").agg(F.min(F.when(F.col("day").isNotNull(), own)).alias("first_"))
    placed = ws.save(numbered(pairs, ["client_id", "seq"], "place_"), "placed")
    starts = ws.save(placed.groupBy(F.col("client_id").alias("c_")).agg(F.min("place_").alias("start_")), "starts")
    return placed.join(starts, F.col("client_id").eqNullSafe(F.col("c_"))).select("client_id", "seq", "first_", (F.col("place_") - F.col("start_") + 1).alias("n"))


def fragments(pairs: DataFrame, block: int = 4096) -> DataFrame:
    """The rows to apply with their fragment (its first number), whether they are its last, its earliest day so far and what it sets.

    A fragment doesn't go beyond ``block`` numbers, so no task sees all rows of a client. city and balance are structs, null as long
    as the fragment sets nothing.
    """
    rows = pairs.filter("first_ is not null").select("client_id", "seq", "n", "first_.*").withColumn("block_", F.floor((F.col("n") - 1) / block))
    w = Window.partitionBy("client_id", "block_").orderBy("n")
    goes_on = (F.lag("n").over(w) == F.col("n") - 1) & (F.lag("batch").over(w) == F.col("batch"))
    rows = rows.withColumn("cut_", F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("n")))
    rows = rows.withColumn("fragment", F.max("cut_").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    own = Window.partitionBy("client_id", "block_", "fragment").orderBy("n")
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def set_to(value: str) -> Column:
        kept = F.when(F.col("op") != "D", F.col(value))
        return F.last(F.when(F.col("op").isin("I", "D") | (F.col("op") == "U") & F.col(value).isNotNull(), F.struct(kept.alias("value"))), ignorenulls=True).over(so_far)

    return rows.select(
        "client_id", "seq", "n", "batch", "change_id", "tie_", "op", "fragment", F.lead("n").over(own).isNull().alias("last"), F.min("day").over(so_far).alias("earliest"), set_to("city").alias("city"), set_to("balance").alias("balance")
    )


def _feed(spark: SparkSession, ws: Workspace, batches: int, buckets: int, largest: dict[int, int], wait: int) -> DataFrame:
    """Starts the stream once for each batch, and once more to give up on everything; what it has decided."""
    empty = spark.createDataFrame([], _FEED)

    def ticks(batch: int, today: int) -> None:
        rows = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(today).cast("int").alias("tick"), F.lit(batch).cast("int").alias("batch"))
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema.fields[3:]]
        rows.select("*", *rest).coalesce(8).write.parquet(ws.path(f"feed/ticks-{batch}"))

    stream = spark.readStream.schema(empty.schema).option("recursiveFileLookup", True).parquet(ws.make("feed"))
    sets = F.when(F.col("city").isNotNull(), 1).otherwise(0) + F.when(F.col("balance").isNotNull(), 2).otherwise(0)
    due = stream.filter("tick is not null or last").select(
        "bucket", "tick", "batch", "client_id", "fragment", "n", "earliest", sets.alias("sets"), F.col("city.value").alias("new_city"), F.col("balance.value").alias("new_balance")
    )
    moved = due.groupBy("bucket").applyInPandasWithState(_turn(wait), _MOVED, _STATE, "append", GroupStateTimeout.NoTimeout)
    today = _NEVER
    for batch in range(1, batches + 2):
        ticks(batch, _ALL if batch > batches else today)
        if batch in largest:
            move(spark, ws.path(f"staged/part_={batch}"), ws.path(f"feed/batch-{batch}"))
            today = max(today, largest[batch])
        sink = moved.writeStream.format("parquet").option("path", ws.path("moved")).option("checkpointLocation", ws.path("checkpoint"))
        sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(_MOVED).parquet(ws.path("moved"))


def apply_changes(changes: DataFrame, batches: int, wait: int = 5, block: int = 4096, buckets: int | None = None) -> DataFrame:
    """change_id, client_id, status (applied or rejected), batch, missed, city, balance, current of each row with a day.

    changes: change_id, client_id, seq, op, city, balance, day (int; null: the row counts for the ranks of seq and vanishes then) and
    batch (1 to ``batches``; of rows of one batch the day and then change_id decide). ``batches`` batches go in order into a stream
    that is started anew for each on one checkpoint; a last start gives up on all gaps, as batch ``batches`` + 1. Of the numbers that
    a client's rows have, the expected one is applied: op I sets city and balance, U those that aren't null, D nulls both, any other
    nothing. At a batch's start, while a client's earliest held day + ``wait`` isn't beyond the largest day of all earlier batches,
    it jumps to its smallest held number; the row applied then has the numbers it ``missed``. ``current`` marks a client's last
    applied row, unless that is a D.

    A null client_id is a client of its own, a null seq the first number of its client; rows that are equal in all columns here
    are told apart, so the second is rejected; very long values are carried as they are; a batch without rows ticks; an empty table
    gives an empty one; other columns are ignored. ``buckets`` (default: one for 4096 rows, 64 at least) is the number of state keys.
    To the driver goes the largest day of each batch alone; nothing is broadcast but the sizes of range partitions.
    """
    spark = changes.sparkSession
    ws = Workspace(spark, "sequenced")
    columns = ["change_id", "client_id", "seq", "op", "city", "balance", "day", "batch"]
    rows = ws.save(changes.select(*columns, F.xxhash64(*changes.columns).alias("tie_")), "rows")
    rows = ws.save(_told_apart(rows), "told")
    ws.drop("rows")
    kept = rows.filter("day is not null")
    counted = kept.groupBy("batch").agg(F.max("day").alias("day"), F.count("*").alias("rows")).collect()  # a row for each batch
    largest = {r["batch"]: r["day"] for r in counted}
    buckets = buckets or max(64, sum(r["rows"] for r in counted) // 4096)
    ahead = ws.save(fragments(with_numbers(rows), block), "fragments")
    a, b = kept.alias("a"), ahead.alias("b")
    same = F.col("a.client_id").eqNullSafe(F.col("b.client_id")) & F.col("a.seq").eqNullSafe(F.col("b.seq"))
    first = F.col("a.tie_") == F.col("b.tie_")
    staged = a.join(b, same).select(
        F.pmod(F.xxhash64("a.client_id"), F.lit(buckets)).alias("bucket"), F.lit(None).cast("int").alias("tick"), "a.batch", "a.change_id", "a.client_id", first.alias("first"), "b.n",
        *[F.when(first, F.col(f"b.{c}")).alias(c) for c in ("fragment", "last", "earliest", "op", "city", "balance")], F.col("a.batch").alias("part_"),
    )
    staged.write.partitionBy("part_").parquet(ws.path("staged"))
    moved = _feed(spark, ws, batches, buckets, largest, wait)
    final = moved.filter("final").select(F.col("client_id").alias("c_"), F.col("fragment").alias("f_"), "final")
    once = F.col("client_id").eqNullSafe(F.col("c_")) & (F.col("fragment") == F.col("f_"))
    decided = moved.filter("not final").drop("final").join(final, once, "left").drop("c_", "f_").alias("d")
    if not counted:
        return spark.createDataFrame([], "change_id long, client_id long, status string, batch int, missed long, city string, balance double, current boolean")
    fed = spark.read.schema(spark.createDataFrame([], _FEED).schema).option("recursiveFileLookup", True).parquet(ws.path("feed")).filter("tick is null").alias("r")
    same = F.col("r.client_id").eqNullSafe(F.col("d.client_id")) & (F.col("r.fragment") == F.col("d.fragment"))
    done = F.col("d.batch").isNotNull()
    value = lambda c: F.when(F.col(f"r.{c}").isNotNull(), F.col(f"r.{c}.value")).otherwise(F.col(f"d.{c}"))
    able = fed.filter("r.first").join(decided, same, "left").select(
        "r.change_id",
        "r.client_id",
        F.when(done, "applied").otherwise("rejected").alias("status"),
        F.coalesce("d.batch", "r.batch").alias("batch"),
        F.when(done & (F.col("r.n") == F.col("r.fragment")), F.col("d.missed")).otherwise(F.lit(0)).cast("long").alias("missed"),
        F.when(done, value("city")).alias("city"),
        F.when(done, value("balance")).alias("balance"),
        (done & F.coalesce(F.col("d.final"), F.lit(False)) & F.col("r.last") & ~F.col("r.op").eqNullSafe("D")).alias("current"),
    )
    # a row that isn't the first of its number meets nothing; without a fragment all those of a client would meet in one task
    never = {"status": F.lit("rejected"), "missed": F.lit(0).cast("long"), "city": F.lit(None).cast("string"), "balance": F.lit(None).cast("double"), "current": F.lit(False)}
    return able.unionByName(fed.filter("not r.first").drop("city", "balance").withColumns(never).select(able.columns))


def _told_apart(rows: DataFrame) -> DataFrame:
    """``tie_`` is another one in each of several rows that are equal: those are counted, and only they are numbered."""
    several = rows.groupBy("change_id", "tie_").agg(F.count("*").alias("n_")).filter("n_ > 1").select("change_id", "tie_")
    several = several.withColumnsRenamed({"change_id": "i_", "tie_": "t_"})
    again = F.col("change_id").eqNullSafe(F.col("i_")) & (F.col("tie_") == F.col("t_"))
    marked = rows.join(several, again, "left")
    lone = F.monotonically_increasing_id()
    return marked.withColumn("tie_", F.when(F.col("t_").isNull(), F.col("tie_")).otherwise(F.xxhash64("tie_", lone))).drop("i_", "t_")
