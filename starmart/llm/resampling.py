"""Importance resampling of documents towards a target corpus, on hashed n-gram features.

Words come from the UTF-8 bytes: one table of 256 bytes lower-cases A-Z and blanks every ASCII byte that is neither letter nor
digit, and ``bytes.split`` yields the words. A feature is a run of consecutive words joined by a space; its CRC-32 is extended word by
word, each starting from the sum of the run before it, and counted in one of a fixed number of buckets. Counters are summed within a
task, so a task sends one row per bucket at most. A bucket's gain is a scaled log ratio of its smoothed shares in the target and in the
documents; a document weighs the sum of its features' gains. Adding Gumbel noise, which follows from the id, and taking the highest scores
draws documents without replacement in proportion to their importance. Scores get their rank by one range sort.

A text is worked through in segments that end at a blank, so a very long one needs no more memory than its own bytes twice over.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.ranks import rank_rows
from starmart.operators.staged import stage

from .common import map_batches, slices, strings

# Upper-case letters to lower case, all other ASCII bytes but letters and digits to blanks; bytes of other characters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
# Bytes of a text that are split at once, about.
SEGMENT = 1 << 20
# Features that wait to be reduced to bucket counts.
REDUCE = 200_000
# Different words whose sums a task remembers.
KNOWN_WORDS = 50_000


def segments(data: bytes, size: int = SEGMENT) -> Iterator[list[bytes]]:
    """Words of translated bytes, segment by segment; a segment ends at a blank or at the end."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class _Sums(dict):
    """CRC-32 of words; those of the first KNOWN_WORDS are remembered."""

    def __missing__(self, word: bytes) -> int:
        found = zlib.crc32(word)
        if len(self) < KNOWN_WORDS:
            self[word] = found
        return found


def feature_sums(text: str, longest: int, sums: dict[bytes, int], size: int = SEGMENT) -> Iterator[tuple[int, list[int]]]:
    """(number of words, CRC-32 of the features that end in them) for each segment of a text."""
    crc32 = zlib.crc32
    before: list[bytes] = []
    for words in segments(text.encode().translate(WORD_BYTES), size):
        found = list(map(sums.__getitem__, words))
        if longest > 1:
            # Runs that begin among the last words of the segment before are extended into this one.
            row, carried = before + words, len(before)
            sofar = [crc32(word) for word in row]
            for n in range(2, longest + 1):
                sofar = [crc32(b" " + word, seed) for seed, word in zip(sofar, row[n - 1 :])]
                found += sofar[max(carried - n + 1, 0) :]
            before = row[-(longest - 1) :]
        yield len(words), found


def count_buckets(docs: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each bucket; each task sends a row per bucket at most."""

    def work(batches):
        total: Counter[int] = Counter()
        sums, waiting = _Sums(), []

        def reduce():
            total.update(Counter((np.fromiter(waiting, np.int64, len(waiting)) % buckets).tolist()))
            waiting.clear()

        for batch in slices(batches):
            for text in strings(batch.column(0)):
                for _, found in feature_sums(text, longest, sums):
                    waiting += found
                    if len(waiting) > REDUCE:
                        reduce()
        reduce()
        rows = [pa.array(part, pa.int64()) for part in (list(total.keys()), list(total.values()))]
        yield pa.RecordBatch.from_arrays(rows, names=["bucket", "n"])

    counted = map_batches(docs.select(text_col), work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # one row per bucket
        counts[bucket] = n
    return counts


def bucket_gains(own: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """``floor(scale * ln(share in the target / share in the documents))`` of each bucket, every count raised by one."""
    all_own, all_target, buckets = int(own.sum()), int(target.sum()), len(own)
    return np.array(
        [
            math.floor(scale * math.log((t + 1) * (all_own + buckets) / ((s + 1) * (all_target + buckets))))
            for s, t in zip(own.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weigh(
    docs: DataFrame, gains: np.ndarray, longest: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``__id``, ``__n_words``, ``__n_features`` and ``__weight``, the sum of the gains of each row's features; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)

    def work(batches):
        sums, buckets = _Sums(), len(sent.value)
        for batch in slices(batches):
            columns = np.zeros((3, batch.num_rows), np.int64)
            for row, text in enumerate(strings(batch.column(1))):
                for n_words, found in feature_sums(text, longest, sums):
                    crcs = np.fromiter(found, np.int64, len(found))
                    columns[:, row] += n_words, len(crcs), sent.value[crcs % buckets].sum()
            names = ["__id", "__n_words", "__n_features", "__weight"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), work, f"__id {kind}, __n_words long, __n_features long, __weight long")


def gumbel_noise(id_column: Column, seed: int, scale: int = 1000) -> Column:
    """``floor(-scale * ln(-ln(u)))`` with u from the first 32 bits of the SHA-256 of the seed and the id; null ids as no text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    u = (head + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(scale)) * F.log(-F.log(u)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """``__id``, ``__n_features``, ``__weight``, ``__score`` and ``__rank`` of every row of ``docs``.

    ``__rank`` counts from 1 by falling score among the ``percent`` of the rows with at least ``least_words`` words that are drawn, rounded
    down; it is null for the others. Ties of score go to the smaller id, null last. Null and empty texts have no words, no features and
    weight 0, and are never drawn. Repeated rows are counted, weighed and drawn each; equal ids share their noise. An empty target has
    equal shares in all buckets; an empty table of documents gives an empty one. Extra columns are left behind.
    """
    gains = bucket_gains(
        count_buckets(docs, text_col, longest, buckets), count_buckets(target, target_col, longest, buckets)
    )
    weighed = weigh(docs, gains, longest, id_col, text_col)
    scored = weighed.withColumn("__score", F.col("__weight") + gumbel_noise(F.col("__id"), seed))
    # Rows that may be drawn come first, so a row's place is its rank.
    scored = scored.withColumn("__may", F.col("__n_words") >= least_words)
    order = [F.desc("__may"), F.desc("__score"), F.asc_nulls_last("__id"), F.asc("__n_features"), F.asc("__weight")]
    # The sort samples its input before it moves it; rows this narrow are written first, so texts are read once.
    narrow = stage(scored, "resampling-scores")
    counts = narrow.agg(F.count(F.lit(1)), F.count_if("__may")).first()
    drawn = percent * counts[1] // 100
    ranked = rank_rows(narrow, order, rows=counts[0])
    rank = F.when(F.col("__may") & (F.col("_position") < drawn), F.col("_position") + 1)
    return ranked.select("__id", "__n_features", "__weight", "__score", rank.alias("__rank"))
