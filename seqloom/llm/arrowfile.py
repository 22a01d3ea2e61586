"""Token ids in Arrow stream files: batches of fixed-size lists, so equal-length sequences and masks are views into the file.

A writer makes, per range of doc_id, ``part-N.arrow`` (input_ids, mask: whether a place holds a token, first: whether it
starts a document) and ``part-N.index.arrow`` (doc_id, start within the part, n_tokens). Documents follow each other without
gaps; only a part's last sequence is padded.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Workspace, text_of

BATCH = 64  # sequences


def schema(length: int, wide: bool) -> pa.Schema:
    flags = pa.list_(pa.bool_(), length)
    return pa.schema([("input_ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", flags), ("first", flags)])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class PartWriter:
    """Writes one part under a name of its own, and renames it when it is whole: a retried task leaves no half file."""

    def __init__(self, folder: str, part: int, length: int, wide: bool):
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = f"{root}/part-{part:06d}"
        self.temp = f"{root}/_{uuid.uuid4().hex}"
        self.schema, self.length, self.kind = schema(length, wide), length, np.uint32 if wide else np.uint16
        self.out = [self.fs.open_output_stream(self.temp + x) for x in (".arrow", ".index.arrow")]
        self.data, self.index = pa.ipc.new_stream(self.out[0], self.schema), pa.ipc.new_stream(self.out[1], INDEX)
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = self.docs = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        first = np.zeros(len(ids), bool)
        first[:1] = True
        self.rows.append((doc_id, self.tokens, len(ids)))
        self.waiting.append((ids.astype(self.kind), first))
        self.tokens += len(ids)
        self.held += len(ids)
        self.docs += 1
        if self.held >= BATCH * self.length:
            self._flush(False)
        if len(self.rows) >= 10_000:
            self._flush_index()

    def _flush_index(self) -> None:
        if self.rows:
            self.index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)], schema=INDEX))
            self.rows = []

    def _flush(self, last: bool) -> None:
        if not self.waiting:
            return
        ids, first = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        step = BATCH * self.length
        end = len(ids) if last else len(ids) // step * step
        for i in range(0, end, step):
            a, b = ids[i : min(i + step, end)], first[i : min(i + step, end)]
            pad = -len(a) % self.length
            mask = np.concatenate([np.ones(len(a), bool), np.zeros(pad, bool)])
            columns = (np.concatenate([a, np.zeros(pad, self.kind)]), mask, np.concatenate([b, np.zeros(pad, bool)]))
            self.data.write_batch(
                pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns], schema=self.schema)
            )
        self.waiting = [(ids[end:], first[end:])] if end < len(ids) else []
        self.held = len(ids) - end

    def close(self) -> None:
        self._flush(True)
        self._flush_index()
        for x in (self.data, self.index, *self.out):
            x.close()
        for x in (".index.arrow", ".arrow"):
            self.fs.move(self.temp + x, self.final + x)


class TokenPart:
    """Random access to a written part. On a local or mounted file system arrays are views into the mapped file."""

    def __init__(self, base: str):
        from pyarrow import fs

        self.fs, path = fs.FileSystem.from_uri(base)
        local = isinstance(self.fs, fs.LocalFileSystem)
        self._open = (lambda x: pa.memory_map(path + x)) if local else (lambda x: self.fs.open_input_file(path + x))
        self.batches = list(pa.ipc.open_stream(self._open(".arrow")))

    def index(self) -> Iterator[pa.RecordBatch]:
        yield from pa.ipc.open_stream(self._open(".index.arrow"))

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of the part's i-th sequence."""
        row = self.batches[i // BATCH].slice(i % BATCH, 1)
        return row.column("input_ids").flatten().to_numpy(zero_copy_only=True), row.column("mask").flatten()

    def chunks(self) -> Iterator[np.ndarray]:
        for b in self.batches:
            yield b.column("input_ids").flatten().to_numpy(zero_copy_only=True)


def write_parts(docs: DataFrame, folder: str, tokenizer: str, kind: str, end_id: int, length: int = 2048) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order below ``folder`` (a URI that all executors reach).

    Each document's ids are followed by ``end_id``; a null text is empty. Null doc_ids come first, and rows that repeat a doc_id
    follow each other. Returns one row per part: part, docs, tokens, start (ids in earlier parts).
    """
    ranged = docs.select("doc_id", text_of().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from ._tokens import encoder

        encode, writer, part = None, None, TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if writer is None:
                    encode = encoder(tokenizer, kind)
                    writer = PartWriter(folder, part, length, encode.tokenizer.get_vocab_size() > 1 << 16)
                writer.add(doc_id, np.frombuffer(encode(text.as_py()) + np.array([end_id], "<u4").tobytes(), "<u4"))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "docs": [writer.docs], "tokens": [writer.tokens]})

    ws = Workspace(docs.sparkSession, "parts")
    parts = ws.save(ranged.mapInArrow(run, "part long, docs long, tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_documents(parts: DataFrame, folder: str) -> DataFrame:
    """Per document, read from the files: doc_id, start (ids before it), n_tokens, ids_crc32 (of its ids as unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = TokenPart(f"{folder}/part-{part:06d}")
                chunks, now = file.chunks(), np.zeros(0, np.uint16)
                for index in file.index():
                    crcs = []
                    for n in index.column("n_tokens").to_pylist():
                        crc = 0
                        while n:
                            if not len(now):
                                now = next(chunks)
                            crc = zlib.crc32(now[:n].astype("<u4").tobytes(), crc)
                            n, now = n - len(now[:n]), now[n:]
                        crcs.append(crc)
                    start = pa.array(index.column("start").to_numpy() + base)
                    yield pa.RecordBatch.from_arrays(
                        [index.column("doc_id"), start, index.column("n_tokens"), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # one row per file: dealt out so that files are read side by side
    n = max(1, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return parts.select("part", "start").repartition(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
