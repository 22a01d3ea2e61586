"""Quality scores on columns: decoding, encoding, summaries, and conversion between formats."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Format:
    offset: int
    low: int
    high: int
    solexa: bool = False
    color: bool = False


# Ascii offset and score range of each format.
FORMATS = {
    "sanger": Format(33, 0, 93),
    "illumina": Format(64, 0, 62),
    "solexa": Format(64, -5, 62, solexa=True),
    "cssanger": Format(33, 0, 93, color=True),
}


def codes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, characters as numbers) of a string column, a null being empty. Text in ASCII is looked at in place."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = text.cast(pa.large_string()).fill_null("")
    if not len(text):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, ends, data = text.buffers()
    offsets = np.frombuffer(ends, np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    if len(raw) and raw.max() > 127:
        each = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in text.to_pylist()]
        return np.concatenate([[0], np.cumsum([len(x) for x in each])]), np.concatenate(each)
    return offsets - offsets[0], raw


def slices(column: pa.Array, rows: int = 256) -> list[pa.Array]:
    """A column by runs of ``rows``: what is worked out of one is gone before the next, however large a batch is."""
    return [column.slice(i, rows) for i in range(0, len(column), rows)]


def lists(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, items) of a column of lists, a null being empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    size = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64), values.flatten().to_numpy(zero_copy_only=False)


def scores(qual: Column, offset: int = 33) -> Column:
    """Integer scores of an ascii quality string; none for an empty or null one. A column of strings is turned at once."""

    @F.arrow_udf("array<int>")
    def decoded(text: pa.Array) -> pa.Array:
        ends, code = codes(text)
        value = code.astype(np.int32)
        value -= offset
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value))

    return decoded(qual)


def total(qual: Column, offset: int = 33) -> Column:
    """Sum of the scores of an ascii quality string, 0 for an empty or null one, without a list of them."""

    @F.arrow_udf("long")
    def summed(text: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, np.int64), *(_sums(*codes(part), offset) for part in slices(text))]))

    return summed(qual)


def _sums(ends: np.ndarray, code: np.ndarray, offset: int) -> np.ndarray:
    upto = np.zeros(len(code) + 1, np.int64)
    np.cumsum(code, out=upto[1:])
    return np.diff(upto[ends]) - offset * np.diff(ends)


def encode(values: Column, offset: int = 33) -> Column:
    return F.array_join(F.transform(values, lambda x: F.char(x + offset)), "")


def decimal_scores(text: Column) -> Column:
    return F.transform(F.split(F.trim(text), " +"), lambda x: x.cast("int"))


def is_ascii(qual: Column) -> Column:
    return ~qual.rlike("[ \t]")


def q_min(values: Column) -> Column:
    return F.array_min(values)


def summary(values: Column) -> Column:
    """struct(total, mean, std) of a list of scores; mean and std (of the population) are null for an empty one."""

    @F.arrow_udf("total double, mean double, std double")
    def summed(column: pa.Array) -> pa.Array:
        parts = [_moments(*lists(part)) for part in slices(column)] or [(np.zeros(0),) * 4]
        n, total, mean, std = map(np.concatenate, zip(*parts, strict=True))
        return pa.StructArray.from_arrays([pa.array(total), *(pa.array(v, mask=n == 0) for v in (mean, std))], ["total", "mean", "std"])

    return summed(values)


def _moments(ends: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """(number, total, mean, std) of each list."""
    x = x.astype(np.float64)
    n = np.diff(ends)
    total, squares = (np.diff(np.concatenate([[0.0], np.cumsum(v)])[ends]) for v in (x, x * x))
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = total / n
        std = np.sqrt(np.maximum(squares / n - mean * mean, 0.0))
    return n, total, mean, std


def q_mean(values: Column) -> Column:
    return summary(values)["mean"]


def q_std(values: Column) -> Column:
    """Population standard deviation."""
    return summary(values)["std"]


def phred_to_solexa(x: Column) -> Column:
    """Rounded half away from zero; scores of 0 and less give -5."""
    return F.when(x <= 0, F.lit(-5)).otherwise(F.round(10.0 * F.log10(F.pow(F.lit(10.0), x / 10.0) - 1.0))).cast("int")


def solexa_to_phred(x: Column) -> Column:
    return F.round(10.0 * F.log10(F.pow(F.lit(10.0), x / 10.0) + 1.0)).cast("int")


def clamp(x: Column, fmt: str) -> Column:
    return F.least(F.greatest(x, F.lit(FORMATS[fmt].low)), F.lit(FORMATS[fmt].high))


def valid_quality(values: Column, fmt: str) -> Column:
    f = FORMATS[fmt]
    return F.forall(values, lambda x: x.between(f.low, f.high))


def valid_sequence(seq: Column, color: bool = False) -> Column:
    return seq.rlike(r"^[A-Za-z][0-6.]*$" if color else r"^[A-Za-z.*-]*$")


def lengths_agree(seq: Column, values: Column, color: bool = False) -> Column:
    """One score a base; with an adapter base in color space one may be missing."""
    same = F.length(seq) == F.size(values)
    return same | (F.length(seq) == F.size(values) + 1) if color else same


def convert(values: Column, source: str, target: str) -> Column:
    """Scores of one format as scores of another: score system, then the target's range."""
    a, b = FORMATS[source], FORMATS[target]

    def one(x: Column) -> Column:
        if a.solexa and not b.solexa:
            x = solexa_to_phred(x)
        elif b.solexa and not a.solexa:
            x = phred_to_solexa(x)
        return clamp(x, target)

    return F.transform(values, one)


def reencode(qual: Column, source: str, target: str) -> Column:
    """An ascii quality string of one format in another."""
    return encode(convert(scores(qual, FORMATS[source].offset), source, target), FORMATS[target].offset)


def fake_quality(seq: Column, fmt: str = "sanger") -> Column:
    return F.repeat(F.lit(chr(FORMATS[fmt].high + FORMATS[fmt].offset)), F.length(seq))
