"""Token counts of whole texts, with huge texts encoded piece by piece.

A huge text is cut into overlapping chunks and each is encoded with offsets. Two neighbours are spliced at a boundary that
is proven stable: both encodings begin a token there, with the same id, and an ASCII white-space character stands before it.
The tokenizer drops white space and never lets a piece span it, and neither its normalization nor its special strings
reach across it, so what is left of such a place cannot change what is right of it. Where the overlap holds
no such place it is doubled, and in the end the two chunks are encoded as one. Memory holds one chunk, not the text's tokens.

By the same argument an ordinary text has as many tokens as its words have, so each distinct word is encoded
once per worker.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, map_batches, strings

# Code points: texts beyond HUGE are cut into chunks of CHUNK that overlap by OVERLAP at first.
HUGE = 32_768
CHUNK = 16_384
OVERLAP = 512
# Words that a worker remembers; when there are more it starts anew.
_REMEMBERED = 400_000


@lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer of a file, once per worker; one thread, as Spark already uses every core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordCounts(dict):
    """Tokens of each word (bytes without ASCII white space), encoded when first met."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def learn(self, texts: list[list[bytes]]) -> None:
        if len(self) > _REMEMBERED:
            self.clear()
        new = list({word for words in texts for word in words if word not in self})
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            found = self.tokenizer.encode_batch_fast([word.decode() for word in part], add_special_tokens=False)
            self.update(zip(part, map(len, found), strict=True))


_word_counts: dict[str, WordCounts] = {}

# From text and place to ids and absolute starts of a chunk's tokens.
Encode = Callable[[str, int], tuple[np.ndarray, np.ndarray]]


def encoder(tokenizer) -> Encode:
    def encode(chunk: str, at: int) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer.encode(chunk, add_special_tokens=False)
        starts = np.fromiter((start for start, _ in found.offsets), np.int64, len(found.ids))
        return np.array(found.ids, np.int64), starts + at

    return encode


def _stable(text: str, left: tuple, right: tuple, after: int) -> int | None:
    """The middle one of the boundaries beyond ``after`` that both encodings have."""
    starts, i, j = np.intersect1d(left[1], right[1], return_indices=True)
    same = (left[0][i] == right[0][j]) & (starts > after)
    places = [int(p) for p in starts[same] if text[p - 1] in SPACE]
    return places[len(places) // 2] if places else None


def count_spliced(text: str, encode: Encode, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    total, begin, end = 0, 0, min(chunk, len(text))
    left = encode(text[:end], 0)
    while end < len(text):
        shared, cut = overlap, None
        while cut is None and shared < end - begin:
            right_begin, right_end = end - shared, min(end - shared + max(chunk, 2 * shared), len(text))
            right = encode(text[right_begin:right_end], right_begin)
            cut = _stable(text, left, right, right_begin)
            shared *= 2
        if cut is None:
            end = min(end + max(chunk, end - begin), len(text))
            left = encode(text[begin:end], begin)
            continue
        total += int((left[1] < cut).sum())
        kept = right[1] >= cut
        left, begin, end = (right[0][kept], right[1][kept]), cut, right_end
    return total + len(left[0])


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row; no shuffle.

    Counts equal the tokenizer's on the whole text without added special tokens. The tokenizer must drop white space, as
    that of ``word_bpe_49k.json`` does. Null and empty texts have no bytes and no tokens. Repeated rows are counted
    each; extra columns are left behind. The tokenizer's file must be on every executor.
    """

    def work(batches):
        tokenizer = load(tokenizer_path)
        words = _word_counts.setdefault(tokenizer_path, WordCounts(tokenizer))
        encode = encoder(tokenizer)
        for batch in batches:
            texts = strings(batch.column(1))
            raw = [text.encode() for text in texts]
            split = [data.split() if len(text) <= huge else [] for text, data in zip(texts, raw, strict=True)]
            words.learn(split)
            counts = [
                sum(map(words.__getitem__, own)) if len(text) <= huge else count_spliced(text, encode, chunk, overlap)
                for text, own in zip(texts, split, strict=True)
            ]
            arrays = [batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(counts, pa.int64())]
            arrays.append(pa.array([n > limit for n in counts], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=["__id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    counted = map_batches(
        docs.select(id_col, text_col), work, f"__id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
    return counted.select(F.col("__id").alias(id_col), "n_bytes", "n_tokens", "over_limit")
