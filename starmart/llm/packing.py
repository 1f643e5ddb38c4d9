"""Packing of tokenized documents into sequences of a fixed length by the sum-of-squares rule.

The rule looks only at how many open sequences there are for each residual gap: an item goes where the sum of the squares of
these counts becomes smallest, which keeps all gaps about equally available and so lets later items fill them exactly.
The longest items are placed first. One group of items needs one array of counts; groups are packed by different tasks. What
lies in sequences that are not full at the end is placed again, twice, which leaves about a third of a percent unused.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .byte_bpe import END_OF_TEXT, encoding
from .common import map_batches, strings

# Items that one task packs.
GROUP = 65_536
# Rounds of placing what lies in sequences with a gap.
ROUNDS = 3


def piece_spans(total: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: the remainder first, then whole sequences."""
    first = total % size
    if first:
        yield 0, first
    for start in range(first, total, size):
        yield start, size


def tokenized_pieces(
    docs: DataFrame, rank_path: str, pattern: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id with ``piece``, ``start``, ``length`` and ``ids_crc32`` of each piece of a row's ids and ``end_id``.

    Null text is empty: one piece, ``end_id`` alone. A text of any length is encoded whole and cut into pieces of ``size``, of which the
    first may be shorter. Repeated rows, and rows of one id, give their pieces each; a null id stays null. An empty table gives no
    pieces; other columns are left behind.
    """

    def work(batches):
        encode = encoding(rank_path, pattern)
        for batch in batches:
            rows, out = [], []
            for row, text in enumerate(strings(batch.column(1))):
                if END_OF_TEXT in text:
                    found = encode.encode(text, allowed_special="all")
                else:
                    found = encode.encode_ordinary(text)
                found.append(end_id)
                ids = np.array(found, "<u4")
                for piece, (start, length) in enumerate(piece_spans(len(ids), size)):
                    rows.append(row)
                    out.append((piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = np.array(out, np.int64).reshape(-1, 4).T
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0].astype(np.int32))]
            arrays += [pa.array(np.ascontiguousarray(c)) for c in columns[1:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["__id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"__id {kind}, piece int, start long, length long, ids_crc32 long"
    return map_batches(docs.select(id_col, text_col), work, schema).withColumnRenamed("__id", id_col)


class SumOfSquares:
    """Open sequences by residual gap; ``place`` gives a sequence and the offset in it."""

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.used = 0

    def place(self, length: int) -> tuple[int, int]:
        """Moving a sequence from gap g to g - length changes the sum by 2 (N[g - length] - N[g] + 1); full ones leave it."""
        size, counts = self.size, self.counts
        after = counts[: size + 1 - length]
        change = 2 * (after - counts[length:]) + 2
        change[0] -= 2 * counts[0] + 1
        change[counts[length:] == 0] = np.iinfo(np.int64).max
        # A new sequence has no gap to leave.
        new = 2 * int(counts[size - length]) + 1 if length < size else 0
        best = int(change.argmin())
        if change[best] <= new:
            gap = best + length
            sequence = self.open[gap].pop()
            counts[gap] -= 1
        else:
            gap, sequence = size, self.used
            self.used += 1
        left = gap - length
        if left:
            counts[left] += 1
            self.open[left].append(sequence)
        return sequence, size - gap


def sequences(lengths: list[int], size: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each length, longest placed first, and the number of sequences.

    What lies in sequences with a gap is taken out and placed again in the next round.
    """
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, used = sorted(range(len(lengths)), key=lambda i: -lengths[i]), 0
    for _ in range(rounds):
        packer, members = SumOfSquares(size), defaultdict(list)
        for i in left:
            own, offset[i] = packer.place(lengths[i])
            members[own].append(i)
        loose = {s for gap in packer.open[1:] for s in gap}
        done = [m for s, m in members.items() if s not in loose]
        for m in done:
            sequence[m] = used
            used += 1
        left, before = sorted((i for s in loose for i in members[s]), key=lambda i: (-lengths[i], i)), members
    for s in loose:
        sequence[before[s]] = used
        used += 1
    return sequence, offset, used


def pack(pieces: DataFrame, size: int, length_col: str = "length", group: int = GROUP) -> DataFrame:
    """``pieces`` with ``__sequence`` (any distinct numbers) and ``__offset``, gapless from 0 within each sequence.

    Pieces of the whole ``size`` take a sequence of their own. The others are dealt by chance into groups of about
    ``group``, one task each, so that a task holds a bounded number of them whatever the input.
    Rows are numbered in a written table, so a task that runs again places them alike. Lengths must lie between
    1 and ``size``. Equal and repeated rows are packed each; an empty table gives an empty one.
    """
    numbered = stage(pieces.withColumn("__item", F.monotonically_increasing_id()), "numbered-pieces")
    whole = F.col(length_col) == size
    alone = numbered.where(whole).withColumns({"__sequence": F.col("__item"), "__offset": F.lit(0).cast("long")})
    rest = numbered.where(~whole)
    groups = rest.count() // group + 1
    columns = pieces.columns
    at = columns.index(length_col)

    def work(batches):
        from pyspark import TaskContext

        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None:
            return
        # Numbers of this road have the bit set that row numbers cannot reach.
        first = (1 << 62) | (TaskContext.get().partitionId() << 33)
        sequence, offset, _ = sequences(table.column(at).to_pylist(), size)
        arrays = [*table.columns[: len(columns)], pa.array(sequence + first), pa.array(offset)]
        yield from pa.Table.from_arrays(arrays, names=[*columns, "__sequence", "__offset"]).to_batches(10_000)

    spread = rest.repartition(groups, "__item").sortWithinPartitions("__item")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    packed = map_batches(spread, work, f"{schema}, __sequence long, __offset long")
    return packed.unionByName(alone.select(packed.columns))
