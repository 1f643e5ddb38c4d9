"""Alignment of two tokenizers against a plain merge over all documents."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starmart.llm import alignment
from starmart.llm.common import table
from starmart.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
MODEL = public_tokenizers.path("piece_bpe_32k.model")
FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
ODD = [
    None,
    "",
    " ",
    " lead  and trail ",
    "a\x1c\x85 \xa0  b\x1f\n\n\tc",
    "x" * 3000,
    "é́ İ 𝒳 ΑΣ 日本語 text",
    "a mark ▁ of the model",
    "<|endoftext|> <s> <unk> it's 12345 'S x</s>y <0x41>",
    "\x00\x0b\x0c",
    "same text twice",
    "same text twice",
    "a 's b  c d's e 1 2 ! ?" * 40,
]


def bytes_of_byte_level():
    """Characters of the byte-level alphabet: printable bytes stand for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def aligned_by_hand(texts):
    a_side, b_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_side.encode_special_tokens = True
    alphabet, found = bytes_of_byte_level(), []
    for text in texts:
        raw = (" " + text).encode() if text else b""
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = []
        for i in b:
            name = b_side.id_to_piece(i)
            single = len(name) == 6 and name.startswith("<0x")
            b_bytes.append(bytes([int(name[3:5], 16)]) if single else name.replace("▁", " ").encode())
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            a = b = a_bytes = b_bytes = []
        spans = [], []
        for side, tokens in zip(spans, (a_bytes, b_bytes)):
            at = 0
            for token in tokens:
                side.append((at, at + len(token)))
                at += len(token)
        links, i, j = [], 0, 0
        groups = [([], [])]
        new_a = new_b = True
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            if new_a:
                groups[-1][0].append(a[i])
            if new_b:
                groups[-1][1].append(b[j])
            end_a, end_b = spans[0][i][1], spans[1][j][1]
            new_a, new_b = end_a <= end_b, end_b <= end_a
            i, j = i + new_a, j + new_b
            if new_a and new_b:
                groups.append(([], []))
        groups.pop()
        text_of = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(text_of.encode()).hexdigest() if a else ""))
    counts = Counter(link for *_, links, _ in found for link in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for n_a, n_b, n_groups, links, sha in found
    ]


def rows_of(frame):
    return {r["__id"]: (*(r[f"__{n}"] for n in FIGURES), r["__groups"]) for r in frame.collect()}


def test_query_equals_the_plain_merge(spark, trial_dir):
    docs = table(spark, trial_dir, "documents").collect()
    expected = dict(zip([r.doc_id for r in docs], aligned_by_hand([r.text for r in docs])))
    rows = QUERIES["op12_tokenizer_alignment"](spark, trial_dir).collect()
    assert {r.doc_id: (*(r[n] for n in FIGURES), r.groups_sha256) for r in rows} == expected


@pytest.mark.parametrize(("block", "batch", "part", "piece"), [(1, 1, 16, 1), (100, 50, 40, 7), (1 << 22, 1 << 18, 1 << 18, 1 << 14)])
def test_odd_texts_in_small_pieces(docs_of, block, batch, part, piece):
    aligned = alignment.align(docs_of(ODD), RANKS, PATTERN, MODEL, block=block, batch_size=batch, part=part, piece=piece)
    assert rows_of(aligned) == dict(enumerate(aligned_by_hand(ODD)))


def test_a_long_text_is_aligned_in_parts(docs_of):
    text = " ".join(f"word{i} and, so on's\n{i * 7}" for i in range(4000))
    docs = [text, text[:1000], text + " ▁"]
    aligned = alignment.align(docs_of(docs), RANKS, PATTERN, MODEL, batch_size=3000, part=1000, piece=100)
    assert rows_of(aligned) == dict(enumerate(aligned_by_hand(docs)))


def test_pieces_of_the_path_are_of_equal_work():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(1, 5000, n)) for n in (900, 2500))
    a, b = np.append(a, 5000), np.append(b, 5000)
    cuts = alignment.path_cuts(a, b, 64)
    steps = np.diff(cuts.sum(axis=1))
    assert (steps[:-1] == 64).all() and tuple(cuts[-1]) == (len(a), len(b)) and (np.diff(cuts, axis=0) >= 0).all()
    found = [alignment.piece_links(a, b, s, e) for s, e in zip(cuts[:-1], cuts[1:])]
    ends = np.concatenate([f.ends for f in found])
    assert sorted(ends) == sorted(set(a) | set(b))
    assert sorted(np.concatenate([f.group_ends for f in found])) == sorted(set(a) & set(b))
    for f in found:
        assert (np.searchsorted(a, f.ends) == f.a).all() and (np.searchsorted(b, f.ends) == f.b).all()


def test_no_and_repeated_rows(docs_of):
    assert alignment.align(docs_of([]), RANKS, PATTERN, MODEL).collect() == []
    assert [r["__n_links"] for r in alignment.align(docs_of([None, ""]), RANKS, PATTERN, MODEL).collect()] == [0, 0]
    rows = alignment.align(docs_of(["a b", "a b"], [None, None]), RANKS, PATTERN, MODEL).collect()
    assert [(r["__id"], r["__n_links"], r["__count_sum"]) for r in rows] == [(None, 2, 4)] * 2
