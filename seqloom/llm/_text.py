"""Vectorised word scanning over Arrow string columns: a slice of texts becomes arrays of word positions and hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Words are runs of bytes other than these (space and \x09-\x0D).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters: ASCII letters and every byte of a character outside ASCII.
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[65:91] = LETTER[128:] = True
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next slice."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, U)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit number."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, without repeats. Sorting is faster here than the hashing of ``np.unique``."""
    x = np.sort(x)
    if len(x) < 2:
        return x
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


@dataclass
class Slice:
    """Some whole texts of a batch. offsets[i]:offsets[i+1] are text i's bytes in data; first is its row."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, most: int = 1 << 19) -> Iterator[Slice]:
    """Cuts a string column into runs of whole texts of about ``most`` bytes; a longer text is a slice of its own.

    Arrays over a slice of half a megabyte stay in the processor's cache and take little memory.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield Slice(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i)
        i = j


#: The lowest 0..8 bytes of a 64-bit number.
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)
#: Words of more bytes are hashed one by one.
_LONG = 256


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word data[start:end].

    Eight bytes at a time are taken in, with every bit mixed between, so words of equal length differ in their hashes if they
    differ in one step alone (all of up to eight bytes do), and no regular pattern of bytes cancels out.
    """
    size = end - start
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    with np.errstate(over="ignore"):
        value = mix((size.astype(U) + U(1)) * U(0xD6E8FEB86659FD93))
        at = np.arange(len(size))
        done = 0
        while len(at):
            taken = eight[start[at] + done] & _LOW[np.minimum(size[at] - done, 8)]
            value[at] = mix((value[at] * U(0x9FB21C651E98DF25)) ^ taken)
            done += 8
            at = at[(size[at] > done) & (size[at] <= _LONG)]
        for k in np.flatnonzero(size > _LONG):
            value[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return value


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def words(s: Slice, keep: np.ndarray | None = None) -> Words:
    """The words of a slice, A-Z lower-cased before hashing. keep: which bytes words are made of (default: no white space)."""
    inside = ~SPACE[s.data] if keep is None else keep[s.data]
    n = len(inside)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = s.offsets[1:-1]
    before[cuts[cuts < n]] = False
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(s.offsets, start, "right") - 1
    return Words(start, end, doc, word_hashes(LOWER[s.data], start, end))


def counts_by(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, n) if weights is not None else np.bincount(doc, minlength=n)


def shingles(w: Words, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word n-grams of ``width``, and where each text's begin (n_docs + 1 offsets).

    A text with some but fewer words has one shingle, its whole sequence; one without words has none.
    """
    per_doc = np.bincount(w.doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    made = np.where(per_doc >= width, per_doc - width + 1, np.minimum(per_doc, 1))
    out_first = np.concatenate([[0], np.cumsum(made)])
    owner = np.repeat(np.arange(n_docs), made)
    at = first[owner] + np.arange(out_first[-1]) - out_first[owner]
    length = np.minimum(per_doc[owner], width)
    value = length.astype(U)
    with np.errstate(over="ignore"):
        for k in range(width):
            has = length > k
            value[has] = mix(value[has] * U(0x9FB21C651E98DF25) + w.hash[at[has] + k])
    return value, out_first
