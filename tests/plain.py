"""Plain versions of operators that SQL can't express."""

from __future__ import annotations


def align(a: str, b: str, match: int = 2, mismatch: int = -4, internal: int = 7, terminal: int = 2, extend: int = 1) -> tuple[float, str]:
    """(percent identity, CIGAR), cell by cell over the whole matrix."""
    n, m = len(a), len(b)
    low = float("-inf")
    best = [[(low, low, low)] * (m + 1) for _ in range(n + 1)]  # states: pair, query base against gap, target base against gap
    back: dict = {}
    best[0][0] = (0.0, low, low)

    def steps(i: int, j: int, s: int) -> list[tuple[float, int]]:
        pi, pj = (i - 1, j - 1) if s == 0 else (i - 1, j) if s == 1 else (i, j - 1)
        if pi < 0 or pj < 0:
            return []
        edge = (s == 1 and j in (0, m)) or (s == 2 and i in (0, n))
        gain = (match if a[pi] == b[pj] else mismatch) if s == 0 else 0
        return [(best[pi][pj][t] + gain - (0 if s == 0 else extend if t == s else (terminal if edge else internal)), t) for t in (0, 1, 2)]

    for i in range(n + 1):
        for j in range(m + 1):
            if i or j:
                got = [max(steps(i, j, s), key=lambda x: (x[0], -x[1]), default=(low, 0)) for s in (0, 1, 2)]
                best[i][j] = tuple(x[0] for x in got)
                back[i, j] = tuple(x[1] for x in got)
    i, j, s = n, m, max((0, 1, 2), key=lambda t: (best[n][m][t], -t))
    ops = []
    while i or j:
        t = back[i, j][s]
        ops.append((s, a[i - 1] == b[j - 1] if s == 0 else False))
        i, j = (i - 1, j - 1) if s == 0 else (i - 1, j) if s == 1 else (i, j - 1)
        s = t
    ops.reverse()
    inner = ops
    while inner and inner[0][0]:
        inner = inner[1:]
    while inner and inner[-1][0]:
        inner = inner[:-1]
    cigar, runs = "", []
    for s, _ in ops:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    for s, k in runs:
        cigar += (str(k) if k > 1 else "") + "MID"[s]
    return (100.0 * sum(x for _, x in inner) / len(inner) if inner else 0.0), cigar


def chimera_score(query, left, right, beta: float = 8.0, pseudo: float = 1.4) -> tuple[float, int]:
    """(score, cut) column by column."""
    kind = ["a" if q == a != b else "b" if q == b != a else "x" if a == b != q else "" for q, a, b in zip(query, left, right, strict=True)]
    best, cut = 0.0, 0
    total = {c: kind.count(c) for c in "abx"}
    seen = dict.fromkeys("abx", 0)
    for i, c in enumerate(kind[:-1]):
        if c:
            seen[c] += 1
        rest = {k: total[k] - seen[k] for k in "abx"}
        value = seen["a"] / (beta * (seen["b"] + pseudo) + seen["x"]) * (rest["b"] / (beta * (rest["a"] + pseudo) + rest["x"]))
        if value > best:
            best, cut = value, i + 1
    return best, cut


def seeds(sequences: dict, k: int, common: int, levels: int = 4) -> tuple[list, dict]:
    """The common words of each length, and a function's worth of seeds: for each sequence {word: first place}."""
    from collections import Counter

    often: list[set] = []

    def own(seq: str) -> dict:
        out: dict = {}
        for at in range(len(seq)):
            for level in range(levels):
                word = seq[at : at + (k << level)]
                if len(word) < k << level or set(word) - set("ACGT"):
                    break
                if level < len(often) and word in often[level]:
                    continue
                out.setdefault(word, at)
                break
        return out

    for level in range(levels - 1):
        count = Counter()
        for seq in sequences.values():
            for at in range(len(seq)):
                words = [seq[at : at + (k << i)] for i in range(level + 1)]
                if len(words[-1]) == k << level and not set(words[-1]) - set("ACGT") and all(w in o for w, o in zip(words, often, strict=False)):
                    count[words[-1]] += 1
        if not (now := {w for w, c in count.items() if c > common}):
            break
        often.append(now)
    return own, often
