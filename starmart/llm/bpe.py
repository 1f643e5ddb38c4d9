"""Byte-level BPE of a corpus by a global shuffle of its distinct words, and decoding by a table of token bytes.

Texts are cut into words by the tokenizer's pattern. Blocks of documents list their distinct words once and keep, for each
document, the numbers of its words in order (its positions). Words go by hash into buckets; a bucket meets every block's
words of it, encodes each distinct word once, and answers each block with ids. Blocks then put the ids back
by position. A word crosses the network at most once per block, so one that a third of all texts repeat is no hot key,
and rows are packed, many words to a row, so that the exchange is a fraction of the text.

One exchange carries both words, by bucket, and positions, by block; the answers come back by block and join the positions where
they lie, so positions move once. Blocks number themselves by their task, so a task that runs again gives the same rows.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import encoding, ranks
from .common import map_batches, partitions, strings

# Code points of the documents of one block, about: a task holds one block's words and positions at a time.
BLOCK = 3 << 20
# Beyond so many code points the words of a text are numbered one by one, without a list of them.
LONG = 1 << 20
# Tokens of the documents in one batch that leaves a task.
OUT_TOKENS = 1 << 20


def word_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with white space as Unicode defines it, which ``\s`` of this library does not quite."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class _Numbers(dict):
    """Numbers of words in order of their first use."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


# Numbers below _ONE take one byte, the next _TWO two, the next _THREE three; beyond these four follow a mark.
_ONE, _TWO, _THREE = 192, 56 << 8, 7 << 16


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Variable-length numbers, first bytes and the others in streams of their own, each compressed."""
    x = numbers.astype(np.uint32)
    kind = (x >= _ONE).astype(np.uint8) + (x >= _ONE + _TWO) + (x >= _ONE + _TWO + _THREE)
    first = x.astype(np.uint8)
    low = x.copy()
    for k, base in ((1, _ONE), (2, _ONE + _TWO)):
        at = kind == k
        low[at] -= base
        first[at] = (192 + (low[at] >> 8)) if k == 1 else (248 + (low[at] >> 16))
    first[kind == 3] = 255
    middle = (low[kind == 2] >> 8).astype(np.uint8)
    low = low[(kind == 1) | (kind == 2)].astype(np.uint8)
    return _pack_lists([part.tobytes() for part in (first, low, middle, x[kind == 3].astype("<u4"))], compress=True)


def _unpack_numbers(packed: bytes) -> np.ndarray:
    first, low, middle, rest = (np.frombuffer(part, kind) for part, kind in zip(_unpack_lists(packed, compressed=True), "BBBI"))
    kind = (first >= 192).astype(np.uint8) + (first >= 248) + (first == 255)
    x, head = first.astype(np.int64), first.astype(np.int64)
    lows = np.zeros(len(x), np.int64)
    lows[(kind == 1) | (kind == 2)] = low
    x[kind == 1] = _ONE + ((head[kind == 1] - 192) << 8) + lows[kind == 1]
    x[kind == 2] = _ONE + _TWO + ((head[kind == 2] - 248) << 16) + (middle.astype(np.int64) << 8) + lows[kind == 2]
    x[kind == 3] = rest
    return x


def _pack_lists(items: list[bytes], compress: bool = False) -> bytes:
    """Byte strings end to end, compressed together or, with ``compress``, each for itself."""
    items = [zstandard.compress(item, 3) for item in items] if compress else items
    lengths = np.fromiter(map(len, items), "<u4", len(items))
    data = np.array([len(items)], "<u4").tobytes() + lengths.tobytes() + b"".join(items)
    return data if compress else zstandard.compress(data, 9)


def _unpack_lists(packed: bytes, compressed: bool = False) -> list[bytes]:
    data = packed if compressed else zstandard.decompress(packed)
    count = int(np.frombuffer(data, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(data, "<u4", count, 4)).tolist()
    body = data[4 + 4 * count :]
    parts = [body[s:e] for s, e in zip([0, *ends[:-1]], ends)]
    return [zstandard.decompress(part) for part in parts] if compressed else parts


def _blocks(docs: DataFrame, pattern: str, buckets: int, block: int) -> DataFrame:
    """Rows by ``key``: a bucket's words of a block (below 0), and a block's ids, lengths, buckets of words and positions."""
    id_type = docs.schema["__id"].dataType.simpleString()

    def work(batches):
        from pyspark import TaskContext

        words_of, number = word_pattern(pattern), TaskContext.get().partitionId() << 33
        words, ids, positions, size = _Numbers(), [], [], 0

        def close():
            every = np.concatenate([*positions, np.zeros(0, np.uint32)])
            # Frequent words get small numbers.
            order = np.argsort(-np.bincount(every, minlength=len(words)), kind="stable")
            number_of = np.empty(len(words), np.uint32)
            number_of[order] = np.arange(len(words), dtype=np.uint32)
            known = list(words)
            raw = [known[i].encode() for i in order]
            own = np.fromiter((xxhash.xxh3_64_intdigest(word) % buckets for word in raw), np.int64, len(raw))
            by_bucket = np.argsort(own, kind="stable")
            used, starts = np.unique(own[by_bucket], return_index=True)
            lists = [_pack_lists([raw[i] for i in part]) for part in np.split(by_bucket, starts[1:])][: len(used)]
            lengths = np.fromiter(map(len, positions), np.int64, len(positions))
            kept = pa.concat_arrays(ids)
            none = pa.nulls(len(used))
            arrays = [pa.array([number, *(-1 - used)], pa.int64()), pa.array([number] * (1 + len(used)), pa.int64())]
            arrays.append(pa.concat_arrays([pa.ListArray.from_arrays([0, len(kept)], kept), none.cast(pa.list_(kept.type))]))
            for part in (_pack_numbers(lengths), _pack_numbers(own)):
                arrays.append(pa.array([part] + [None] * len(used), pa.binary()))
            arrays.append(pa.array([_pack_numbers(number_of[every]), *lists], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "block", "ids", "lengths", "own", "data"])

        for batch in batches:
            start = 0
            for row, text in enumerate(strings(batch.column(1))):
                if len(text) > LONG:
                    one_by_one = (words[match.group()] for match in words_of.finditer(text))
                    positions.append(np.fromiter(one_by_one, np.uint32))
                else:
                    found = words_of.findall(text)
                    positions.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                size += len(text)
                if size >= block:
                    ids.append(batch.column(0).slice(start, row + 1 - start))
                    yield from close()
                    words, ids, positions, size, start, number = _Numbers(), [], [], 0, row + 1, number + 1
            ids.append(batch.column(0).slice(start))
        if positions:
            yield from close()

    return map_batches(docs, work, f"key long, block long, ids array<{id_type}>, lengths binary, own binary, data binary")


def _answers(dealt: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """For each block the ids of its words by bucket, in the order of the words; a bucket encodes each word once."""

    def work(batches):
        encode, now, known = encoding(rank_path, pattern).encode_ordinary, None, {}
        for batch in batches:
            keys, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, out = [row for row, key in enumerate(keys) if key < 0], []
            for row in rows:
                if keys[row] != now:
                    now, known = keys[row], {}
                words = _unpack_lists(batch.column(5)[row].as_py())
                for word in words:
                    if word not in known:
                        known[word] = encode(word.decode())
                ids = [known[word] for word in words]
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter(chain.from_iterable(ids), np.int64)
                out.append(_pack_lists([_pack_numbers(lengths), _pack_numbers(flat)]))
            own = [pa.array([-1 - keys[row] for row in rows], pa.int64()), pa.array([blocks[row] for row in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, pa.array(out, pa.binary())], names=["bucket", "of", "ids"])

    told = map_batches(dealt.sortWithinPartitions("key"), work, "bucket long, of long, ids binary")
    return told.groupBy("of").agg(F.collect_list(F.struct("bucket", "ids")).alias("answers"))


def encode(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """The id and ``__ids``, the token ids of each row's whole text, as array<int>.

    Ids are those that the tiktoken library gives for the pattern and the ranks, without special tokens. Null and empty
    texts have no ids. Repeated rows and ids are encoded, and returned, each for itself. Extra columns are left behind. The rank
    file must be on every executor.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    bare = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    # Both readers take all rows and columns of the exchange, so Spark makes it once; a filter would give each its own.
    dealt = _blocks(bare, pattern, parts, block).repartition(parts, "key")
    answers = _answers(dealt, rank_path, pattern)
    joined = dealt.join(answers, F.col("key") == F.col("of"), "left")
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for row in np.flatnonzero(batch.column(0).to_numpy() >= 0).tolist():
                ids, lengths, own, data, found = (batch.column(i)[row] for i in (2, 3, 4, 5, 7))
                words = _by_number(_unpack_numbers(own.as_py()), found.as_py() or [])
                numbers, ends = _unpack_numbers(data.as_py()), np.cumsum(_unpack_numbers(lengths.as_py()))
                done, out, total = 0, [], 0
                for last, (s, e) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist()), 1):
                    out.append(_tokens(numbers[s:e], *words))
                    total += len(out[-1])
                    if total > OUT_TOKENS or last == len(ends):
                        yield encoded(ids.values.slice(done, last - done), out)
                        done, out, total = last, [], 0

    def encoded(own, ids):
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)))
        return pa.RecordBatch.from_arrays([own, lists], names=["__id", "__ids"])

    found = map_batches(joined, work, f"__id {kind}, __ids array<int>")
    return found.withColumnRenamed("__id", id_col)


def _by_number(own: np.ndarray, answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block's words: all ids, bucket after bucket, and starts and lengths by the numbers of the words."""
    starts, lengths, ids, total = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), [np.zeros(0, np.int64)], 0
    by_bucket = np.argsort(own, kind="stable")
    sorted_own = own[by_bucket]
    for answer in answers:
        counts, flat = map(_unpack_numbers, _unpack_lists(answer["ids"]))
        numbers = by_bucket[slice(*np.searchsorted(sorted_own, [answer["bucket"], answer["bucket"] + 1]))]
        lengths[numbers] = counts
        starts[numbers] = total + np.cumsum(counts) - counts
        ids.append(flat)
        total += len(flat)
    return np.concatenate(ids), starts, lengths


def _tokens(numbers: np.ndarray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    own = lengths[numbers]
    before = np.cumsum(own) - own
    return ids[np.repeat(starts[numbers] - before, own) + np.arange(own.sum())]


def decode(encoded: DataFrame, rank_path: str, ids_col: str = "__ids") -> DataFrame:
    """``encoded`` with ``__bytes``: each row's ids joined with the table of token bytes, in order.

    The table is the rank file, which has a row per token of the vocabulary and so a size that no corpus changes; every
    task holds it, and no row moves. An id that the table lacks is an error. Null ids give null.
    """
    columns = encoded.columns
    at = columns.index(ids_col)

    def work(batches):
        table = {rank: token for token, rank in ranks(rank_path).items()}
        for batch in batches:
            column = batch.column(at)
            flat, ends = column.flatten().to_numpy(), np.cumsum(np.nan_to_num(_lengths(column))).astype(np.int64)
            out: list[bytes | None] = []
            for i, (s, e) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                out.append(b"".join(map(table.__getitem__, flat[s:e].tolist())) if column[i].is_valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*columns, "__bytes"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return map_batches(encoded, work, f"{schema}, __bytes binary")


def _lengths(lists: pa.ListArray) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(float)
