"""Alignment of two tokenizations of the same texts.

Each text is encoded by a byte-level BPE (A) and by a piece model (B), whose tokens are runs of bytes of a space and the text. The byte
offsets where tokens end are two sorted lists; merging them cuts the bytes into segments, each of which lies in one token of
either side: a link. Where both sides end, a group ends.

The merge runs over the documents of a batch at once. Diagonals at equal distances are placed on its path by a binary search, which
cuts it into pieces of equal work, whatever the lengths of the documents; each piece emits the links of its own segments, and groups that
cross a border are stitched when they are written. Texts beyond a size are cut at single spaces between other characters: both
tokenizers begin a token there, of B because no piece of its vocabulary holds a space behind another character.

How often a pair of ids is linked in the whole corpus is summed by Spark. Documents are kept in blocks that list each of their pairs once,
so a pair moves once per block however many documents share it, and the sums come back to the blocks in the same way.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .bpe import _pack_lists, _pack_numbers, _unpack_lists, _unpack_numbers
from .byte_bpe import encoding, ranks
from .common import map_batches, slices, strings

# Code points of the documents of one block, about; of the texts that are merged at once; and of a part of a long text.
BLOCK, BATCH, PART = 4 << 20, 1 << 18, 1 << 18
# Steps of the merge in one piece.
PIECE = 1 << 14
# The mark that stands for a space in pieces, and the pieces of single bytes: both are fixed with the model's format.
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
# A pair of ids is one number: A above B. Vocabularies of up to 2^20 ids each are taken.
B_BITS = 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SEPARATORS = (";", ",", "|")


class Side(NamedTuple):
    """Token ids and the bytes they end at."""

    ids: np.ndarray
    ends: np.ndarray


@lru_cache(maxsize=2)
def _pieces(model_path: str):
    """The piece model, the bytes of its ids, their lengths, and whether spaces stand only at the front of pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    data = []
    for name in names:
        byte = BYTE_PIECE.fullmatch(name)
        data.append(bytes([int(byte[1], 16)]) if byte else name.replace(SPACE_MARK, " ").encode())
    front = not any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names)
    return model, data, np.array([len(d) for d in data], np.int64), front


@lru_cache(maxsize=2)
def _token_lengths(rank_path: str) -> np.ndarray:
    """Bytes of each id of the rank file."""
    known = ranks(rank_path)
    lengths = np.zeros(max(known.values(), default=-1) + 1, np.int64)
    for token, rank in known.items():
        lengths[rank] = len(token)
    return lengths


def parts(text: str, size: int) -> Iterator[str]:
    """A text cut at single spaces between other characters, which are left out; parts are of at least ``size`` but for the last."""
    start = 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class Encoders:
    """Both tokenizers of a task."""

    def __init__(self, rank_path: str, pattern: str, model_path: str):
        self.encode_a = encoding(rank_path, pattern)
        self.lengths_a = _token_lengths(rank_path)
        self.encode_b, self.pieces, self.lengths_b, self.front = _pieces(model_path)
        self.size = max(len(self.lengths_a), len(self.lengths_b))

    def sides(self, text: str) -> tuple[Side, Side, int] | None:
        """Both sides of a space and the text, and the number of its bytes; None where the tokens' bytes differ from them."""
        raw = (" " + text).encode()
        a = self.encode_a.encode_ordinary(" " + text)
        b = self.encode_b.encode(text)
        if b"".join(map(self.pieces.__getitem__, b)) != raw or self.encode_a.decode_bytes(a) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Side(a, np.cumsum(self.lengths_a[a])), Side(b, np.cumsum(self.lengths_b[b])), len(raw)


def path_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> np.ndarray:
    """Rows (i, j): how many ends of A and of B lie before each diagonal of the merge, equal ends of A first.

    All diagonals are searched at once; each halves its own interval of i.
    """
    diagonals = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ones := low < high).any():
        middle = (low + high) // 2
        # End i of A comes before end (diagonal - i - 1) of B, so the path goes further along A.
        at_a = a[np.minimum(middle, len(a) - 1)] if len(a) else np.zeros(len(middle), np.int64)
        at_b = b[np.clip(diagonals - middle - 1, 0, max(len(b) - 1, 0))] if len(b) else np.zeros(len(middle), np.int64)
        further = open_ones & (at_a <= at_b)
        low = np.where(further, middle + 1, low)
        high = np.where(open_ones & ~further, middle, high)
    return np.column_stack([low, diagonals - low])


class Links(NamedTuple):
    """What one piece finds: tokens of both sides of each segment, its end, and the ends of groups in it."""

    a: np.ndarray
    b: np.ndarray
    ends: np.ndarray
    group_ends: np.ndarray


def piece_links(a: np.ndarray, b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Links:
    """Links of the segments that end in one piece of the path, from its own ends and the last end before them."""
    (i, j), (k, m) = start, stop
    own_a, own_b = a[i:k], b[j:m]
    # An end of B that A shares is A's segment; A's may be the last one of the piece before.
    with_a = np.isin(own_b, own_a, assume_unique=True)
    if i and len(own_b):
        with_a[0] |= own_b[0] == a[i - 1]
    alone = own_b[~with_a]
    ends = np.concatenate([own_a, alone])
    tokens_a = np.concatenate([np.arange(i, k), i + np.searchsorted(own_a, alone)])
    tokens_b = np.concatenate([j + np.searchsorted(own_b, own_a), j + np.flatnonzero(~with_a)])
    return Links(tokens_a, tokens_b, ends, own_b[with_a])


@lru_cache(maxsize=2)
def _names(size: int) -> list[str]:
    """Each separator before each id."""
    return [mark + str(i) for mark in _SEPARATORS for i in range(size)]


def group_text(a: Side, b: Side, group_ends: np.ndarray, size: int) -> str:
    """``;a1,a2|b1;a3|b2,b3`` for whole groups: each token behind the separator that it calls for; ids lie below ``size``."""
    group_a, group_b = np.searchsorted(group_ends, a.ends), np.searchsorted(group_ends, b.ends)
    first_a = np.append(True, group_a[1:] != group_a[:-1])[: len(group_a)]
    first_b = np.append(True, group_b[1:] != group_b[:-1])[: len(group_b)]
    # Tokens of A stand before those of B of their group.
    place_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a)
    place_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, side="right")
    ids = np.empty(len(group_a) + len(group_b), np.int64)
    ids[place_a] = a.ids + size * np.where(first_a, 0, 1)
    ids[place_b] = b.ids + size * np.where(first_b, 2, 1)
    return "".join(map(_names(size).__getitem__, ids.tolist()))


class Tally:
    """What one document adds up to, over the merges that its parts take part in."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest, self.begun = hashlib.sha256(), False
        self.pairs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.valid = True

    def write(self, text: str) -> None:
        if text:
            self.digest.update((text if self.begun else text[1:]).encode())
            self.begun = True

    def add_pairs(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.pairs.append(pairs)
        self.counts.append(counts)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """The document's pairs and how many links hold each; none for a text that is not aligned."""
        if not self.valid or not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate(self.counts), len(pairs)).astype(np.int64)

    def figures(self) -> tuple[int, int, int, int, str]:
        if not self.valid or not self.begun:
            return 0, 0, 0, 0, ""
        return self.n_a, self.n_b, self.n_groups, self.n_links, self.digest.hexdigest()


def merge(batch: list[tuple[Tally, Side, Side, int]], piece: int, size: int) -> None:
    """Add the links and groups of all texts of a batch to their documents; ids of both sides lie below ``size``."""
    if not batch:
        return
    offsets = np.cumsum([0, *(n for *_, n in batch)])
    a = Side(*(np.concatenate(x) for x in zip(*((s.ids, s.ends + o) for (_, s, _, _), o in zip(batch, offsets)))))
    b = Side(*(np.concatenate(x) for x in zip(*((s.ids, s.ends + o) for (_, _, s, _), o in zip(batch, offsets)))))
    cuts = path_cuts(a.ends, b.ends, piece)
    found = [piece_links(a.ends, b.ends, start, stop) for start, stop in zip(cuts[:-1], cuts[1:])]
    links = Links(*(np.concatenate(part) for part in zip(*found)))
    # A text's end is an end of both sides, so nothing crosses from one text into the next.
    text_of = np.searchsorted(offsets[1:], links.ends)
    bits = (a.ids[links.a] << B_BITS) | b.ids[links.b]
    codes, place = np.unique(bits, return_inverse=True)
    own, counts = np.unique(text_of * len(codes) + place, return_counts=True)
    borders = np.searchsorted(own, np.arange(len(batch) + 1) * len(codes))
    n_links = np.bincount(text_of, minlength=len(batch))
    bound = [np.searchsorted(x, offsets, side="right") for x in (a.ends, b.ends, links.group_ends)]
    for k, (tally, *_) in enumerate(batch):
        (a0, a1), (b0, b1), (g0, g1) = ((x[k], x[k + 1]) for x in bound)
        tally.n_a += int(a1 - a0)
        tally.n_b += int(b1 - b0)
        tally.n_groups += int(g1 - g0)
        tally.n_links += int(n_links[k])
        own_pairs = own[borders[k] : borders[k + 1]]
        tally.add_pairs(codes[own_pairs % max(len(codes), 1)], counts[borders[k] : borders[k + 1]])
        whole = Side(a.ids[a0:a1], a.ends[a0:a1]), Side(b.ids[b0:b1], b.ends[b0:b1])
        tally.write(group_text(*whole, links.group_ends[g0:g1], size))


_BLOCK_SCHEMA = (
    "block long, ids array<{kind}>, figures array<struct<n_a: long, n_b: long, n_groups: long, n_links: long, digest: string>>, "
    "pairs array<long>, counts array<long>, own binary"
)


def _blocks(docs: DataFrame, encoders: tuple[str, str, str], block: int, batch_size: int, part: int, piece: int) -> DataFrame:
    """Blocks of whole documents: their ids and figures, their pairs, and each document's pairs by number and count."""
    kind = docs.schema["__id"].dataType.simpleString()

    def work(batches):
        from pyspark import TaskContext

        tokenizers, number = Encoders(*encoders), TaskContext.get().partitionId() << 33
        waiting, waiting_size, ids, tallies, size = [], 0, [], [], 0

        def flush():
            nonlocal waiting, waiting_size
            merge([one for one in waiting if one[0].valid], piece, tokenizers.size)
            waiting, waiting_size = [], 0

        def close():
            nonlocal ids, tallies, size, number
            flush()
            own = [tally.summed() for tally in tallies]
            pairs = np.unique(np.concatenate([p for p, _ in own]))
            counts = np.zeros(len(pairs), np.int64)
            numbers = [np.searchsorted(pairs, p) for p, _ in own]
            for n, (_, c) in zip(numbers, own):
                counts[n] += c
            packed = [
                np.array([len(n) for n in numbers]),
                np.concatenate([np.diff(n, prepend=0) for n in numbers]),
                np.concatenate([c for _, c in own]),
            ]
            names = ["n_a", "n_b", "n_groups", "n_links", "digest"]
            row = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays([0, len(tallies)], pa.concat_arrays(ids)),
                pa.array([[dict(zip(names, tally.figures())) for tally in tallies]], _FIGURES),
                pa.array([pairs], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([_pack_lists([_pack_numbers(x) for x in packed], compress=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(row, names=["block", "ids", "figures", "pairs", "counts", "own"])
            ids, tallies, size, number = [], [], 0, number + 1

        for batch in slices(batches):
            for row, text in enumerate(strings(batch.column(1))):
                tally = Tally()
                ids.append(batch.column(0).slice(row, 1))
                tallies.append(tally)
                pieces = parts(text, part) if tokenizers.front else iter([text])
                for own in pieces if text else ():
                    sides = tokenizers.sides(own)
                    if sides is None:
                        tally.valid = False
                        break
                    waiting.append((tally, *sides))
                    waiting_size += len(own)
                    if waiting_size >= batch_size:
                        flush()
                size += len(text)
                if size >= block:
                    yield from close()
        if tallies:
            yield from close()

    return map_batches(docs, work, _BLOCK_SCHEMA.format(kind=kind))


_FIGURES = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")] + [("digest", pa.string())])
)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``__pair``, ``__count`` and ``__best``: links of each pair of ids in the corpus, and whether no other of its B id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("one"))
    counts = each.groupBy(F.col("one.pairs").alias("__pair")).agg(F.sum("one.counts").alias("__count"))
    counts = stage(counts.withColumn("__b", F.col("__pair").bitwiseAND(F.lit((1 << B_BITS) - 1))), "pair-counts")
    # One row per id of B's vocabulary, which no corpus makes larger.
    most = counts.groupBy("__b").agg(F.max("__count").alias("__most"))
    joined = counts.join(F.broadcast(most), "__b")
    return joined.select("__pair", "__count", (F.col("__count") == F.col("__most")).alias("__best"))


def align(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    batch_size: int = BATCH,
    part: int = PART,
    piece: int = PIECE,
) -> DataFrame:
    """``__id``, ``__n_a``, ``__n_b``, ``__n_groups``, ``__n_links``, ``__groups``, ``__n_best`` and ``__count_sum`` of each row.

    ``__groups`` is the SHA-256 of the groups as text. ``__n_best`` counts the links of a row whose pair is linked in the corpus as
    often as any of its B id; ``__count_sum`` adds up these counts over its links. Null and empty texts, and those whose tokens' bytes
    on either side differ from a space and the text, have zeros and an empty text, and their links count nowhere. Repeated rows and
    ids are aligned, counted and returned each. An empty table gives an empty one; extra columns are left behind. Texts beyond ``part``
    code points are encoded in parts; one without single spaces is encoded whole. Both files must be on every executor.
    """
    bare = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    blocks = stage(_blocks(bare, (rank_path, pattern, model_path), block, batch_size, part, piece), "alignment-blocks")
    listed = blocks.select("block", F.posexplode("pairs").alias("__at", "__pair"))
    told = listed.join(pair_counts(blocks), "__pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("__at", "__count", "__best"))).alias("told")
    )
    kind = bare.schema["__id"].dataType.simpleString()
    joined = blocks.select("block", "ids", "figures", "own").join(told, "block", "left").select("ids", "figures", "own", "told")

    def work(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, figures, told = batch.column(0)[row].values, batch.column(1)[row].values, batch.column(3)[row].values
                sizes, numbers, counts = map(_unpack_numbers, _unpack_lists(batch.column(2)[row].as_py(), compressed=True))
                ends = np.cumsum(sizes)
                rows_of = np.repeat(np.arange(len(sizes)), sizes)
                # Numbers are kept as steps from the one before in their document.
                numbers = np.cumsum(numbers)
                before = np.append(0, numbers)[ends - sizes] if len(numbers) else np.zeros(len(sizes), np.int64)
                numbers -= before[rows_of]
                every = told.field("__count").to_numpy() if told is not None else np.zeros(0, np.int64)
                best = told.field("__best").to_numpy(zero_copy_only=False) if told is not None else np.zeros(0, bool)
                sums = np.zeros((2, len(sizes)), np.int64)
                np.add.at(sums[0], rows_of, counts * best[numbers])
                np.add.at(sums[1], rows_of, counts * every[numbers])
                names = ["n_a", "n_b", "n_groups", "n_links", "digest"]
                out = [ids, *(figures.field(n) for n in names), pa.array(sums[0]), pa.array(sums[1])]
                yield pa.RecordBatch.from_arrays(
                    out, names=["__id", *(f"__{n}" for n in names[:4]), "__groups", "__n_best", "__count_sum"]
                )

    counted = ", ".join(f"__{n} long" for n in ("n_a", "n_b", "n_groups", "n_links"))
    return map_batches(joined, work, f"__id {kind}, {counted}, __groups string, __n_best long, __count_sum long")
