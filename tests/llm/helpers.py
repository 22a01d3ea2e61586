"""Plain versions of the operators, and awkward documents."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")


def frame(spark, texts, first: int = 0, lang="en"):
    """documents of these texts, with extra columns whose names operators use inside."""
    rows = [(i + first, t, lang if isinstance(lang, str) or lang is None else lang[i], "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tokens(text):
    return WORD.findall(lower(text or ""))


def sets(texts, width):
    out = []
    for t in texts:
        w = tokens(t)
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def groups(texts, width, percent=80):
    """component of each text by comparing all pairs."""
    s = sets(texts, width)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


AWKWARD = [None, "", "   \n\t ", "a", "A", "a b", "A  B\n", "one two three", "é É ß", "long " * 3000, "...!?", "x" * 5000, "0 1 2", "日本語 テキスト", "a b", None]
