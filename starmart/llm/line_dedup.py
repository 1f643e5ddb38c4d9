"""Lines that many documents repeat, found with two Bloom filters.

A key's 64-bit hash goes to one of many segments. Each segment keeps one filter for hashes seen once and one for
hashes seen again; only the second matters afterwards. A line whose hash is not in it cannot repeat, so only suspected
repeats leave their task as text. They are confirmed by their whole key, so a false suspicion costs time and nothing else.

Hashes cross the network once, eight bytes for each distinct key of a batch. The second filters are broadcast in waves of segments
whose bytes, which are measured, stay under a bound. Each wave reads the lines where they lie, so the texts are read as many times
as the filters fill the bound, and a line that no filter suspects never leaves its task. Their number follows from the bytes of the texts. A second
filter is as large as the hashes seen again need, so few repeats make small filters whatever the number of lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .common import SPACE, map_batches, partitions, slices, strings

# Bits for each hash and probes per hash: about one false suspicion in a hundred.
_BITS_PER_HASH = 10
_PROBES = 6
# Bytes of text whose lines' hashes make one segment, on average.
SEGMENT_TEXT = 512 << 20
# Second filters of one wave, in bytes, are sent to every executor.
BROADCAST_BYTES = 64 << 20


class BloomFilter:
    """Bits of a power of two, tested and set for whole arrays of 64-bit hashes."""

    def __init__(self, bits: int, data: bytes | None = None):
        self.bits = bits
        self.data = np.zeros(bits // 8, np.uint8) if data is None else np.frombuffer(data, np.uint8)

    @classmethod
    def sized_for(cls, hashes: int) -> BloomFilter:
        return cls(1 << max(10, int(hashes * _BITS_PER_HASH - 1).bit_length()))

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        at = hashes.copy()
        for _ in range(_PROBES):
            yield at & np.uint64(self.bits - 1)
            at += step

    def add(self, hashes: np.ndarray) -> None:
        for places in self._places(hashes):
            np.bitwise_or.at(self.data, places >> np.uint64(3), _bit(places))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for places in self._places(hashes):
            found &= (self.data[places >> np.uint64(3)] & _bit(places)) != 0
        return found


def _bit(places: np.ndarray) -> np.ndarray:
    return np.left_shift(1, (places & np.uint64(7)).astype(np.uint8), dtype=np.uint8)


def _key(line: str, min_chars: int) -> bytes | None:
    """Stripped and lower-cased (A-Z only); None for a line too short to count."""
    bare = line.strip(SPACE)
    return bare.encode().lower() if len(bare) >= min_chars else None


def _keys(text: str, min_chars: int) -> set[bytes]:
    return {key for line in text.split("\n") if (key := _key(line, min_chars)) is not None}


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(key) for key in keys), np.uint64, len(keys))


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    """From the high half; the filters probe from the low half on."""
    return ((hashes >> np.uint64(40)) % np.uint64(segments)).astype(np.int64)


def _packed_hashes(docs: DataFrame, segments: int, min_chars: int) -> DataFrame:
    """Distinct hashes of each batch by segment; a hash that repeats within the batch is there twice."""

    def work(batches):
        for batch in batches:
            found = [_hashes(list(_keys(text, min_chars))) for some in slices([batch]) for text in strings(some.column(0))]
            every = np.concatenate([*found, np.zeros(0, np.uint64)])
            once, counts = np.unique(every, return_counts=True)
            packed = np.concatenate([once, once[counts > 1]])
            segment = _segment(packed, segments)
            order = np.argsort(segment, kind="stable")
            packed, segment = packed[order], segment[order]
            used, starts = np.unique(segment, return_index=True)
            parts = np.split(packed, starts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), pa.array([p.tobytes() for p in parts[: len(used)]], pa.binary())],
                names=["__segment", "__hashes"],
            )

    return map_batches(docs.select("__text"), work, "__segment long, __hashes binary")


def _seen_again(arrays: list[np.ndarray]) -> BloomFilter:
    """The filter of hashes seen again, as large as these need: the one of hashes seen once tells them, and is dropped."""
    once, again = BloomFilter.sized_for(sum(map(len, arrays))), [np.zeros(0, np.uint64)]
    for hashes in arrays:
        distinct, counts = np.unique(hashes, return_counts=True)
        again.append(distinct[once.has(distinct) | (counts > 1)])
        once.add(distinct)
    repeated = np.unique(np.concatenate(again))
    twice = BloomFilter.sized_for(len(repeated))
    twice.add(repeated)
    return twice


def _by_segment(batches: Iterator[pa.RecordBatch]) -> dict[int, list[np.ndarray]]:
    arrays: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for segment, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            arrays.setdefault(segment, []).append(np.frombuffer(packed, np.uint64))
    return arrays


def _second_filters(packed: DataFrame, segments: int) -> DataFrame:
    def work(batches):
        for segment, arrays in _by_segment(batches).items():
            twice = _seen_again(arrays)
            if twice.data.any():
                data = zstandard.compress(twice.data.tobytes(), 3)
                yield pa.RecordBatch.from_pydict({"__segment": [segment], "__bits": [twice.bits], "__data": [data]})

    spread = packed.repartition(segments, "__segment")
    return map_batches(spread, work, "__segment long, __bits long, __data binary")


def _suspects_by_broadcast(docs: DataFrame, filters: DataFrame, segments: int, min_chars: int) -> DataFrame:
    rows = filters.collect()  # those of one wave: at most BROADCAST_BYTES
    sent = docs.sparkSession.sparkContext.broadcast({r[0]: (r[1], bytes(r[2])) for r in rows})

    def work(batches):
        second = {s: BloomFilter(bits, zstandard.decompress(data)) for s, (bits, data) in sent.value.items()}
        for batch in slices(batches):
            own = [list(_keys(text, min_chars)) for text in strings(batch.column(1))]
            keys = [key for k in own for key in k]
            rows = np.repeat(np.arange(len(own)), [len(k) for k in own])
            hashes = _hashes(keys)
            segment = _segment(hashes, segments)
            order = np.argsort(segment, kind="stable")
            used, starts = np.unique(segment[order], return_index=True)
            hits = [
                at[second[s].has(hashes[at])]
                for s, at in zip(used.tolist(), np.split(order, starts[1:]), strict=False)
                if s in second
            ]
            found = np.concatenate([*hits, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[found])), pa.array([keys[i] for i in found], pa.binary())],
                names=["__id", "__key"],
            )

    kind = docs.schema["__id"].dataType.simpleString()
    return map_batches(docs.select("__id", "__text"), work, f"__id {kind}, __key binary")


def _waves(filters: DataFrame, broadcast_bytes: int) -> list[list[int]]:
    """Segments whose filters are at most ``broadcast_bytes`` together, or one segment whose filter alone is more."""
    waves, size = [], 0
    for segment, bits in filters.select("__segment", "__bits").orderBy("__segment").collect():  # a number for each segment
        if not waves or size + bits // 8 > broadcast_bytes:
            waves, size = [*waves, []], 0
        waves[-1].append(segment)
        size += bits // 8
    return waves


def _suspects(docs: DataFrame, filters: DataFrame, segments: int, min_chars: int, broadcast_bytes: int) -> DataFrame:
    """(``__id``, ``__key``) of the lines that a second filter holds; lines are tested where they are read, once for each wave."""
    found = None
    for wave in _waves(filters, broadcast_bytes):
        some = _suspects_by_broadcast(docs, filters.where(F.col("__segment").isin(wave)), segments, min_chars)
        found = some if found is None else found.union(some)
    return _suspects_by_broadcast(docs, filters.limit(0), segments, min_chars) if found is None else found


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Texts without the lines that other documents repeat.

    Lines are split at ``\\n``; a line's key is the line without white space at its ends, A-Z lower-cased. A key of at
    least ``min_chars`` code points held by at least ``min_docs`` documents loses all its lines except in the
    document of the largest id that holds it. All columns of ``docs`` come back with the shorter text, and with
    ``__n_lines`` (lines before) and ``__n_dropped``.

    Null or empty text is one empty line; null stays null. Rows of the same id are one document when documents are counted
    and are all returned; a null id counts as one document, smaller than any other. A key held several times by one
    document counts once; the document that keeps it keeps all its lines of that key. An empty table gives an empty one.
    """
    bare = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    size = bare.agg(F.sum(F.octet_length("__text").cast("long"))).first()[0] or 0
    segments = max(partitions(docs.sparkSession), 1 + size // SEGMENT_TEXT)
    packed = _packed_hashes(bare, segments, min_chars)
    filters = stage(_second_filters(packed, segments), "line-filters")
    suspects = _suspects(bare, filters, segments, min_chars, broadcast_bytes)
    suspects = stage(suspects.distinct(), "line-suspects")
    holders = suspects.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.max("__id").alias("__keeper"))
    repeated = holders.where(F.col("__n") >= min_docs).drop("__n")
    drops = (
        suspects.join(repeated, "__key")
        .where(~F.col("__id").eqNullSafe(F.col("__keeper")))
        .groupBy(F.col("__id").alias("__drop_id"))
        .agg(F.collect_list("__key").alias("__drops"))
    )
    joined = docs.join(drops, F.col(id_col).eqNullSafe(F.col("__drop_id")), "left").drop("__drop_id")
    columns = docs.columns
    at = columns.index(text_col)

    def finish(batches):
        for batch in slices(batches):
            texts, counts, dropped = batch.column(at).to_pylist(), [], []
            for i, (text, drop) in enumerate(zip(texts, batch.column(len(columns)).to_pylist(), strict=True)):
                lines = (text or "").split("\n")
                kept = lines
                if drop and text is not None:
                    drop = set(drop)
                    kept = [line for line in lines if _key(line, min_chars) not in drop]
                    texts[i] = "\n".join(kept)
                counts.append(len(lines))
                dropped.append(len(lines) - len(kept))
            arrays = [pa.array(texts, batch.schema.field(j).type) if j == at else batch.column(j) for j in range(len(columns))]
            arrays += [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "__n_lines", "__n_dropped"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, finish, f"{schema}, __n_lines long, __n_dropped long")
