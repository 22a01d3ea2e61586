"""Patterns looked for in a whole batch of reads at once: bit vectors over windows, and an automaton of many words.

A degenerate pattern is a row of letter sets, so its distance to a window is that of its nearest plain sequence, without spelling
those out: each place takes the letter that fits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bits of one word; patterns are no longer.
LONGEST = 64
#: So many window letters are gathered at a time.
_MOST = 1 << 22


def masks(form: Sequence[str]) -> np.ndarray:
    """For each byte the places of ``form`` (letter sets) that it fits."""
    if len(form) > LONGEST:
        raise ValueError(f"patterns have {LONGEST} places at most")
    out = np.zeros(256, U)
    for k, letters in enumerate(form):
        for c in letters:
            out[ord(c)] |= U(1) << U(k)
    return out


def edits(windows: np.ndarray, form: Sequence[str]) -> np.ndarray:
    """Insertions, deletions and substitutions between each row of ``windows`` (bytes) and the pattern, by bit vectors of differences."""
    fits, m = masks(form), len(form)
    last, every = U(m - 1), U((1 << m) - 1)
    up, down = np.full(len(windows), every, U), np.zeros(len(windows), U)
    score = np.full(len(windows), m, np.int64)
    for j in range(windows.shape[1]):
        equal = fits[windows[:, j]]
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | ~(across | up), up & across
        score += ((more >> last) & U(1)).astype(np.int64) - ((less >> last) & U(1)).astype(np.int64)
        more, less = (more << U(1)) | U(1), less << U(1)
        up, down = (less | ~(vertical | more)) & every, more & vertical & every
    return score


def common(windows: np.ndarray, form: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of each row of ``windows`` and the pattern; a byte 0 fits nothing."""
    fits, every = masks(form), U((1 << len(form)) - 1)
    rest = np.full(len(windows), ~U(0), U)
    for j in range(windows.shape[1]):
        used = rest & fits[windows[:, j]]
        rest = (rest + used) | (rest - used)
    return np.bitwise_count(~rest & every).astype(np.int64)


def batches(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole reads of about ``most`` bytes; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def nearest(data: np.ndarray, offsets: np.ndarray, forms: Sequence[tuple[int, Sequence[str]]], most: int, exact: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each read its window with the fewest edits, then the last, then of the first pattern: (pattern number or -1, place, edits).

    Windows have a pattern's length, begin with letters that fit its first ``exact`` places, and are at most ``most`` edits away.
    """
    count, size = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(count), size)
    room = offsets[1:][owner] - np.arange(len(data)) if count else np.zeros(0, np.int64)
    best = np.full((count, 3), (-1, -1, most + 1), np.int64)
    for number, form in forms:
        m = len(form)
        fits = masks(form)
        at = np.flatnonzero(room >= m)
        for k in range(min(exact, m)):
            at = at[(fits[data[at + k]] >> U(k)) & U(1) == 1]
        step = max(1, _MOST // m)
        for part in (at[i : i + step] for i in range(0, len(at), step)):
            d = edits(data[part[:, None] + np.arange(m)], form)
            near = d <= most
            place, d, own = part[near], d[near], owner[part[near]]
            order = np.lexsort((-place, d, own))
            place, d, own = place[order], d[order], own[order]
            first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
            place, d, own = place[first] - offsets[own[first]], d[first], own[first]
            old = best[own]
            better = (d < old[:, 2]) | (d == old[:, 2]) & (place > old[:, 1])
            best[own[better]] = np.stack([np.full(better.sum(), number), place[better], d[better]], 1)
    return best[:, 0], best[:, 1], best[:, 2]


class Words:
    """Many plain words in one automaton, each with its number; of equal ones the smallest number counts."""

    def __init__(self, words: Sequence[str]):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        self.longest = max(map(len, words), default=0)
        for number, word in enumerate(words):
            if word and word not in self.find:
                self.find.add_word(word, (number, len(word)))
        self.find.make_automaton()
        self.empty = not len(self.find)

    def near(self, read: str) -> tuple[int, int] | None:
        """(number, place) of the smallest number whose first occurrence is at 0 or 1."""
        best = None
        for end, (number, size) in self.find.iter(read[: self.longest + 1]) if not self.empty else ():
            if end - size < 1 and (best is None or number < best[0]):  # a word at 0 ends before the same one at 1
                best = number, end - size + 1
        return best

    def last(self, read: str) -> tuple[int, int] | None:
        """(number, place) of the smallest number that occurs, at its last occurrence."""
        best, place = None, -1
        for end, (number, size) in self.find.iter(read) if not self.empty else ():
            if best is None or number <= best:
                best, place = number, end - size + 1
        return None if best is None else (best, place)
