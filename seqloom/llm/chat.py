"""Chat formatting after cumulative-snapshot collapse.

A service logs a conversation again after every turn, so most logged conversations are prefixes of longer ones. Rolling hashes
of every prefix of turns identify them: an anti-join of whole-conversation hashes with the hashes of proper prefixes keeps the
maximal conversations, which are then rendered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import Workspace


def render(turns: Column) -> Column:
    """ChatML-like text of an array of (turn, role, text)."""
    one = F.transform(turns, lambda t: F.concat(F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["text"], F.lit("<|im_end|>\n")))
    return F.array_join(one, "")


def _rolling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: the hash of each prefix of its turns, the last one being the whole."""
    for batch in batches:
        out = []
        for turns in batch.column("turns"):
            state, hashes = hashlib.blake2b(digest_size=16), []
            for t in turns:
                for field in (t["role"].as_py(), t["text"].as_py()):
                    raw = field.encode()
                    state.update(len(raw).to_bytes(8, "little") + raw)
                hashes.append(state.copy().digest())
            out.append(hashes)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(out, pa.list_(pa.binary()))], ["conv_id", "prefixes"])


def collapse(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered: conv_id, n_turns, snapshots, text.

    Input: conv_id, turn, role, text. A conversation's turns go by turn, then role, then text; a row that repeats another in
    all four counts once. A null role or text is an empty one, a null turn comes first, and rows without a conv_id are left
    out. Equal conversations collapse to the smallest conv_id; snapshots counts those and the conversation itself. A conversation
    that is a proper prefix of another (the same roles and texts in order) is dropped. An empty table gives an empty one. Other
    columns are ignored. A conversation, which is one text in the end, is held by one task, however long its turns are.
    """
    ws = Workspace(conversations.sparkSession, "chat")
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    rows = conversations.filter("conv_id is not null").select("conv_id", "turn", role, text)
    whole = ws.save(rows.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns")), "whole")
    hashed = ws.save(whole.mapInArrow(_rolling, "conv_id long, prefixes array<binary>"), "hashed")
    full = hashed.groupBy(F.element_at("prefixes", -1).alias("h")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("snapshots"))
    proper = hashed.select(F.explode(F.slice("prefixes", 1, F.size("prefixes") - 1)).alias("h")).distinct()
    kept = full.join(proper, "h", "left_anti").select("conv_id", "snapshots")
    return whole.join(kept, "conv_id").select("conv_id", F.size("turns").cast("long").alias("n_turns"), "snapshots", render(F.col("turns")).alias("text"))
