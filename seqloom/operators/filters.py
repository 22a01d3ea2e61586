"""Read filters. Each adds to fail_reason (the first reason stays) or rewrites seq and scores; nothing is dropped before ``split``."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from operator import eq, ge, gt, le, lt, ne

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import sequence as S

COMPARISONS: dict[str, Callable] = {">": gt, ">=": ge, "==": eq, "<": lt, "<=": le, "!=": ne}


def compare(a: Column, op: str, b) -> Column:
    return COMPARISONS[op](a, F.lit(b))


def fails_chastity(filter_flag: Column) -> Column:
    return filter_flag == "Y"


def fails_ambiguity(seq: Column, allowed_at: int = 0) -> Column:
    """More than one N, or one that doesn't stand at the 1-based place ``allowed_at`` (0: nowhere)."""
    n = S.count_of(seq, "N")
    at_place = (F.substring(seq, allowed_at, 1) == "N") if allowed_at else F.lit(False)
    return (n > 1) | ((n == 1) & ~at_place)


def fails_first_50(scores: Column, most: int = 34, least_score: int = 30) -> Column:
    """``most`` or more of the first 50 scores are below ``least_score``."""
    return F.size(F.filter(F.slice(scores, 1, 50), lambda x: x < least_score)) >= most


_AGGREGATES = {"min": np.min, "max": np.max, "sum": np.sum, "mean": np.mean}


def _passing(windows: np.ndarray, agg: str, exclude: int, op: str, threshold: float) -> np.ndarray:
    """Which rows of ``windows`` pass: as they are, or without some of their places, ``exclude`` at most. What is empty passes."""
    width = windows.shape[1]
    good = np.zeros(len(windows), bool)
    for k in range(min(exclude, width) + 1):
        for out in combinations(range(width), k):
            kept = np.delete(windows, out, 1)
            good |= COMPARISONS[op](_AGGREGATES[agg](kept, 1), threshold) if kept.shape[1] else True
    return good


def _first_window(scores: np.ndarray, window: int, step: int, *rule) -> int:
    """The first place, in steps, whose window passes; the last windows may be shorter. len(scores) without one."""
    n = len(scores)
    whole = max(0, n - window + 1)
    if whole:
        good = _passing(np.lib.stride_tricks.sliding_window_view(scores, window)[::step], *rule)
        if good.any():
            return int(good.argmax()) * step
    for at in range(-(-whole // step) * step, n, step):
        if _passing(scores[None, at:], *rule)[0]:
            return at
    return n


def _last_window(scores: np.ndarray, window: int, step: int, *rule) -> int:
    """The end, going back in steps from the last, of the first whole window that passes; 0 without one."""
    n = len(scores)
    if n < window:
        return 0
    good = _passing(np.lib.stride_tricks.sliding_window_view(scores, window)[::-1][::step], *rule)
    return n - int(good.argmax()) * step if good.any() else 0


def trim_ends(df: DataFrame, window: int = 1, step: int = 1, ends: str = "53", agg: str = "min", exclude: int = 0, op: str = ">=", threshold: float = 0) -> DataFrame:
    """Cuts seq and scores at the first window, from each end named, whose value passes the comparison; without one all goes.

    From the 5' end windows may run out of the read, from the 3' end they may not. ``exclude``: a window passes too if it does
    without some of its places, so many at most. Ends are cut in the order named, each on what is left.
    """
    rule = (agg, exclude, op, threshold)

    @F.arrow_udf("first int, last int")
    def kept(column: pa.Array) -> pa.Array:
        at, flat = Q.lists(column)
        first, last = np.zeros(len(at) - 1, np.int32), np.diff(at).astype(np.int32)
        single = COMPARISONS[op](flat, threshold) | (exclude > 0) if window == step == 1 else None
        passing = np.flatnonzero(single) if single is not None else None
        for i in range(len(first)):
            for end in ends:
                a, b = at[i] + first[i], at[i] + last[i]
                if passing is not None:  # one score a window: the nearest of those that pass
                    lo, hi = np.searchsorted(passing, (a, b))
                    if lo == hi:
                        last[i] = first[i]
                    elif end == "5":
                        first[i] = passing[lo] - at[i]
                    else:
                        last[i] = passing[hi - 1] + 1 - at[i]
                elif end == "5":
                    first[i] += _first_window(flat[a:b], window, step, *rule)
                else:
                    last[i] = first[i] + _last_window(flat[a:b], window, step, *rule)
        return pa.StructArray.from_arrays([pa.array(first), pa.array(last)], ["first", "last"])

    df = df.withColumn("kept_", kept("scores"))
    first, size = F.col("kept_.first") + 1, F.col("kept_.last") - F.col("kept_.first")
    return df.withColumns({"seq": F.substring(F.col("seq"), first, size), "scores": F.slice("scores", first, size)}).drop("kept_")


def clip(df: DataFrame, front: int = 0, back: int = 0) -> DataFrame:
    """Removes ``front`` bases from the start, then ``back`` from the end of reads that had more than ``back`` before."""
    out = df
    for name in ("seq", "scores"):
        cut = S.cut if name == "seq" else S.cut_array
        value = cut(F.col(name), front)
        out = out.withColumn(f"{name}_", F.when(F.length("seq") > back, cut(value, 0, -back)).otherwise(value) if back else value)
    return out.withColumns({"seq": F.col("seq_"), "scores": F.col("scores_")}).drop("seq_", "scores_")


def first_reason(**checks: Column) -> Column:
    """The name of the first check, in the given order, that holds."""
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in checks.items()])


def illumina_filter(df: DataFrame, min_length: int = 75, n_at: int = 0, keep_zero_length: bool = False) -> DataFrame:
    """Chastity, ambiguous bases, first 50 scores, length; fail_reason is null for reads that pass. Needs seq, scores, filter_flag."""
    n = F.length("seq")
    return df.withColumn(
        "fail_reason",
        first_reason(
            chastity=fails_chastity(F.col("filter_flag")),
            ambiguous=fails_ambiguity(F.col("seq"), n_at),
            first_50=fails_first_50(F.col("scores")),
            short=n < min_length,
            empty=(n == 0) & F.lit(not keep_zero_length),
        ),
    )


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, failed)."""
    return df.filter("fail_reason is null").drop("fail_reason"), df.filter("fail_reason is not null")


def mean_quality_fails(scores: Column, least: float = 30) -> Column:
    return Q.q_mean(scores) < least


def in_regions(region: Column, regions: list[str]) -> Column:
    return region.isin(regions)
