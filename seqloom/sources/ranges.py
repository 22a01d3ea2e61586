"""FASTQ as a data source of byte ranges: one scan, no shuffle, and the bytes of every record that can't be read.

A range's reader begins at the first record that starts in it and ends with the last one that does, however far that goes, so files
are split anywhere. A record starts at a line with @ whose next but one begins with + and whose second and fourth line are equally
long: quality lines that begin with @ don't pass for one.
"""

from __future__ import annotations

import gzip
import io
import re
from collections import deque
from collections.abc import Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_SCHEMA = "header string, seq string, qual string, path string, start long, end long, error string"
_BATCH = 4096
#: Rows are sent on when they have so many letters.
_BYTES = 4 << 20


def _store(path: str):
    """The file system that a path or URI is on, and what it is called there."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)


def _files(paths: list[str]) -> list[tuple[str, int]]:
    """(path, size) of files, of the files in folders, and of those that a pattern in the last part of a path fits; hidden ones are left out."""
    from pyarrow import fs

    found = []
    for path in paths:
        folder, _, pattern = path.rpartition("/") if "*" in path else (path, "", "*")
        store, inner = _store(folder or ".")
        info = store.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        inside = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(inner, recursive="*" not in path))
        before = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""  # what the store doesn't tell: scheme and host
        found += [(before + x.path, x.size) for x in inside if x.type == fs.FileType.File and not x.base_name.startswith(("_", ".")) and fnmatch(x.base_name, pattern)]
    return sorted(found)


class _Lines:
    """Lines with their places, and a look ahead at some."""

    def __init__(self, file, place: int):
        self.file, self.place = file, place
        self.ahead: deque[tuple[int, int, bytes]] = deque()  # start, end, what stands between

    def look(self, n: int) -> bool:
        while len(self.ahead) < n:
            line = self.file.readline()
            if not line:
                return False
            self.ahead.append((self.place, self.place + len(line), line.rstrip(b"\r\n")))
            self.place += len(line)
        return True

    def record(self) -> str | None:
        """What is wrong with the record that begins at the next line."""
        self.look(4)
        head, seq, plus, qual = (*(x[2] for x in list(self.ahead)[:4]), b"", b"", b"", b"")[:4]
        if not head.startswith(b"@"):
            return "no @"
        if not plus.startswith(b"+"):
            return "no +"
        return None if len(seq) == len(qual) else "lengths differ"

    def blank(self) -> bool:
        return not self.ahead[0][2]


def scan(file, place: int, start: int, end: int | None) -> Iterator[tuple[int, int, list[bytes], str | None]]:
    """(start, end, lines, error) of the records that start in [start, end) of a file that stands at ``place``, a line's start."""
    lines = _Lines(file, place)
    while lines.look(1) and lines.ahead[0][0] < start or lines.look(1) and start > 0 and lines.record():  # to the first record that is one
        if end is not None and lines.ahead[0][0] >= end:
            return
        lines.ahead.popleft()
    while lines.look(1) and (end is None or lines.ahead[0][0] < end):
        if lines.blank():
            lines.ahead.popleft()
            continue
        wrong = lines.record()
        took = [lines.ahead.popleft()]
        if wrong is None:
            took += [lines.ahead.popleft() for _ in range(3)]
        else:
            while lines.look(1) and lines.record() and not (len(took) >= 4 and (lines.blank() or lines.ahead[0][2].startswith(b"@"))):
                took.append(lines.ahead.popleft())
        yield took[0][0], took[-1][1], [x[2] for x in took[:4]], wrong


class _Range(InputPartition):
    def __init__(self, uri: str, start: int, end: int | None):
        self.uri, self.start, self.end = uri, start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.size = options["path"].split("\n"), int(options.get("rangebytes", 64 << 20))

    def partitions(self) -> list[_Range]:
        out = []
        for uri, size in _files(self.paths):
            if uri.endswith(".gz"):
                out.append(_Range(uri, 0, None))
            else:
                out += [_Range(uri, at, at + self.size) for at in range(0, size, self.size)]
        return out

    def read(self, part: _Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # there are no files, or empty ones
            return
        store, inner = _store(part.uri)
        names = ["header", "seq", "qual", "path", "start", "end", "error"]
        with store.open_input_file(inner) as raw:
            place = part.start
            if part.uri.endswith(".gz"):
                file = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20)
            else:
                raw.seek(max(0, part.start - 1))
                file = io.BufferedReader(raw, 1 << 20)
                if part.start:
                    place = part.start - 1 + len(file.readline())  # what is left of the line before
            rows, size = [], 0
            for start, end, lines, wrong in scan(file, place, part.start, part.end):
                text = [x.decode("utf-8", "replace") for x in (*lines, b"", b"", b"", b"")[:4]]
                told = None if wrong is None else f"{wrong} in {part.uri}, bytes {start} to {end}"
                rows.append((text[0].removeprefix("@"), text[1], text[3], part.uri, start, end, told))
                size += end - start
                if size >= _BYTES or len(rows) == _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], names)


def records(file) -> Iterator[tuple[str, str, str, str | None]]:
    """(header, seq, qual, error) of the records of an open file, whose sequences and qualities may go over several lines."""
    lines = (x.decode("utf-8", "replace").rstrip("\r\n") for x in file)
    line = next(lines, None)
    while line is not None:
        head = line.rstrip()
        if not head:
            line = next(lines, None)
            continue
        seq, qual, size = [], [], 0
        while (line := next(lines, None)) is not None and not line.startswith("+"):
            seq.append(line.strip())
        plus = (line or "").strip()
        whole, line = "".join(seq), next(lines, None)
        while line is not None and size < len(whole):
            qual.append(line.rstrip())
            size += len(qual[-1])
            line = next(lines, None)
        wrong = "no @" if head[0] != "@" else "no +" if plus not in ("+", f"+{head[1:]}") else "lengths differ" if len(whole) != size else None
        yield head[1:], whole, "".join(qual), wrong


class _WholeReader(_Reader):
    """A partition for each file, which is read from its start on."""

    def partitions(self) -> list[_Range]:
        return [_Range(uri, 0, None) for uri, _ in _files(self.paths)]

    def read(self, part: _Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        store, inner = _store(part.uri)
        with store.open_input_file(inner) as raw:
            file = io.BufferedReader(gzip.GzipFile(fileobj=raw) if part.uri.endswith(".gz") else raw, 1 << 20)
            rows, size = [], 0
            for n, (header, seq, qual, wrong) in enumerate(records(file)):
                rows.append((header, seq, qual, part.uri, n, wrong))
                size += len(header) + 2 * len(seq)
                if size >= _BYTES or len(rows) == _BATCH:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["header", "seq", "qual", "path", "record", "error"])


class FastqFiles(DataSource):
    """Whole files of records over several lines. Option: path (several ones by line)."""

    @classmethod
    def name(cls) -> str:
        return "fastq_files"

    def schema(self) -> str:
        return "header string, seq string, qual string, path string, record long, error string"

    def reader(self, schema) -> DataSourceReader:
        return _WholeReader(self.options)


_KINDS = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]


class FastqRanges(DataSource):
    """Options: path (several ones by line), rangeBytes (64 MB). Stores are those of Arrow: local files, HDFS, object stores."""

    @classmethod
    def name(cls) -> str:
        return "fastq_ranges"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
