"""Importance resampling towards a target: hashed n-gram counts of two corpora weigh each document, a seeded race draws.

A document is scanned once. A ring holds the running CRC states of the last ``n`` starts; each word extends every state by a space
and itself and opens a new one, so all runs of 1 to n words get their CRC without a run being spelled out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.warehouse import numbered
from ._shared import Workspace, text_of

#: Words are runs of ASCII digits and letters (lower-cased before) and of every byte of a character outside ASCII.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: So many bytes of a text are cut into words at a time.
_PIECE = 1 << 18


def ring(words: list[bytes], states: list[int], n: int) -> list[int]:
    """CRCs of all runs of up to ``n`` words that end with one of ``words``. ``states`` is the ring: it goes on from call to call."""
    if n == 1:
        return list(map(crc32, words))  # a ring of one start has nothing to extend
    out = []
    for word in words:
        tail = b" " + word
        states[:] = [crc32(tail, state) for state in states[-(n - 1) :]]
        states.append(crc32(word))
        out += states
    return out


def scan(text: str, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end there) of a text, piece by piece, so a very long text takes little memory."""
    raw, states, at = text.encode().lower(), [], 0  # bytes.lower changes A-Z alone
    while at < len(raw):
        cut = _BREAK.search(raw, at + _PIECE)
        end = cut.end() if cut else len(raw)
        words = _WORD.findall(raw, at, end)
        yield len(words), np.array(ring(words, states, n), np.int64) % buckets
        at = end


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """Occurrences in each bucket, over all rows. A task sums up what it scans; ``buckets`` sums go to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for _, found in scan(text.as_py(), n, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counted = texts.select(text_of().alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most ``buckets``
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the buckets' smoothed share in the target over that in the corpus)."""
    k = len(raw)
    ratio = ((target + 1.0) * (raw.sum() + k)) / ((raw + 1.0) * (target.sum() + k))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int) -> DataFrame:
    """doc_id, n_words, n_features and weight (the sum of its features' gains) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("text")):
                for words, found in scan(text.as_py(), n, len(gain)):
                    rows[:, i] += (words, len(found), gain[found].sum())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, rows)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def race(seed: str, scale: int = 1000) -> Column:
    """floor(-scale * ln(-ln u)), u from the first 32 bits of sha256('<seed>:<doc_id>'): Gumbel noise that depends on the row alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score, rank (and n_words) of every row of ``docs`` (doc_id, text).

    Features are runs of 1 to ``n`` words. Of the rows with ``least_words`` words or more, ``percent`` in a hundred are drawn
    without putting back: those of the greatest weight plus Gumbel noise, ties to the smaller doc_id; ``rank`` numbers them, it
    is null for the others. Null and empty texts have no features and weight 0; very long ones are scanned whole; rows that repeat
    are each counted, weighed and ranked; a row without a doc_id has the noise of the text 'null'; empty tables give empty ones,
    and an empty target weighs towards rare buckets. Other columns are ignored.

    What is gathered on the driver: ``buckets`` counts of either side and one count of rows. Ranks come from range partitions of
    (score, doc_id), so no task orders all rows.
    """
    ws = Workspace(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    scored = ws.save(weigh(docs, gain, n).withColumn("score", F.col("weight") + race(seed)), "scored")
    runs = scored.filter(F.col("n_words") >= least_words)
    drawn = runs.count() * percent // 100
    order = numbered(runs.withColumn("behind_", -F.col("score")), ["behind_", "doc_id"], "place_")
    ranked = order.withColumn("rank", F.when(F.col("place_") <= drawn, F.col("place_")))
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(columns).unionByName(rest.select(columns))
