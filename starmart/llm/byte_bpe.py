"""Byte-level BPE of the public rank files, loaded once per worker."""

from __future__ import annotations

import base64
from functools import lru_cache

# The one special string of the vocabulary, fixed with it.
END_OF_TEXT = "<|endoftext|>"


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    known = ranks(path)
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={END_OF_TEXT: len(known)}
    )
