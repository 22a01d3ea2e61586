"""Best-fit packing of tokenised documents by the sum-of-squares rule.

A document is placed into the open sequence for which the sum of the squared counts of open sequences per residual gap becomes
smallest; a new sequence is opened only where no open one has room, and longer pieces are placed first. The state is one count
per gap, so a placement costs the same however many sequences are open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Workspace, text_of


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, taken in the given order. Ties go to the smallest gap, within it to the bin opened last."""
    counts = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    of, at, opened = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    for i, s in enumerate(np.asarray(sizes, np.int64).tolist()):
        fits = np.flatnonzero(counts[s:capacity])
        if len(fits):
            cost = counts[fits] - counts[fits + s] + 1  # half of the change in the sum; a full bin counts in no gap
            if fits[0] == 0:
                cost = 2 * cost
                cost[0] = 1 - 2 * counts[s]
            gap = s + int(fits[cost.argmin()])
            b = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, b, opened = capacity, opened, opened + 1
        of[i], at[i] = b, capacity - gap
        if gap > s:
            stacks[gap - s].append(b)
            counts[gap - s] += 1
    return of, at


def token_pieces(docs: DataFrame, tokenizer: str, kind: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and ``end_id``, cut only if they exceed ``capacity``.

    ids are little-endian unsigned 32-bit integers. Of a cut document all pieces but the first are full. A null text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ._tokens import encoder

        encode, end = encoder(tokenizer, kind), np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            rows: list = []
            size = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                first = n % capacity or capacity if n > capacity else n
                cuts = [0, *range(first, n + 1, capacity)]
                rows += [(doc_id, k, a, b - a, ids[4 * a : 4 * b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                size += len(ids)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def place(pieces: DataFrame, capacity: int, shard: int = 20_000) -> DataFrame:
    """``pieces`` with sequence_id and offset. Needs doc_id, piece and length; other columns are carried along.

    Full pieces are sequences of their own and aren't shuffled. The others are dealt by hash into shards of about ``shard``
    pieces, each packed alone, so no task's work grows with the input; a shard leaves at most its last open sequences unfilled.
    """
    ws = Workspace(pieces.sparkSession, "packing")
    pieces = ws.save(pieces, "pieces")
    full = pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id() * 2 + 1, "offset": F.lit(0).cast("long")}
    )
    rest = pieces.filter(F.col("length") < capacity)
    n = rest.count()
    shards = -(-n // shard) or 1
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    columns = pieces.columns

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        of, at = sum_of_squares(group["length"].to_numpy(), capacity)
        return group[columns].assign(sequence_id=2 * ((key[0] << 32) + of), offset=at)

    key = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).alias("shard_")
    packed = rest.withColumn("shard_", key).groupBy("shard_").applyInPandas(pack, schema)
    return full.unionByName(packed)


def pack(docs: DataFrame, tokenizer: str, kind: str = "byte", end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Packed pieces with their ids: doc_id, piece, start, length, ids, sequence_id, offset (gapless from 0 in a sequence).

    A null or empty text is its end alone. A very long text is cut into full pieces behind a shorter first one; no other is cut.
    Rows that repeat, with or without a doc_id, are each packed. Pieces of equal length go by doc_id and piece. An empty table
    gives an empty one; other columns are ignored.
    """
    return place(token_pieces(docs, tokenizer, kind, end_id, capacity), capacity)


def pack_digest(docs: DataFrame, tokenizer: str, kind: str = "byte", end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """As ``pack``, with ids_crc32 of each piece's ids instead of the ids."""
    pieces = token_pieces(docs, tokenizer, kind, end_id, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(pieces, capacity)
