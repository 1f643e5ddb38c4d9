"""Operators that look at many rows together, and the pipeline, against brute force."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import compare
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import line_dedup, ngram_join, toxicity, vector_search, warc
from starmart.llm.common import table
from starmart.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(trial_dir):
    return compare.connect(trial_dir)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, trial_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, trial_dir), duck, ORACLE[name]) == []


# --- line dedup

LONG = "This very line is long enough"


def brute_lines(rows, min_docs=3, min_chars=20):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower()
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(line.strip(" \t\n\x0b\x0c\r")) >= min_chars:
                holders[key(line)].add(-1 if i is None else i)
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        own = -1 if i is None else i
        kept = [line for line in lines if gone.get(key(line), own) == own]
        out.append((str(i), str(text if text is None else "\n".join(kept)), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lines_by_one_wave_and_by_many(docs_of, broadcast_bytes):
    texts = [f"{LONG}\nown line {i}\n  {LONG.upper()}\t\nshort" for i in range(5)]
    texts += [None, "", "\n\n", "É" * 20 + "\nx", "É" * 20, "é" * 20, f"{LONG}\n" * 3, "a" * 19, "a" * 19, "a" * 19]
    ids = [0, 1, 2, 3, 3, None, 6, 7, 8, 9, 10, None, 12, 13, 14]
    docs = docs_of(texts, ids)
    got = line_dedup.dedup_lines(docs, broadcast_bytes=broadcast_bytes)
    assert got.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    rows = sorted((str(r.doc_id), str(r.text), r["__n_lines"], r["__n_dropped"]) for r in got.collect())
    assert rows == brute_lines(list(zip(ids, texts, strict=True)))
    assert line_dedup.dedup_lines(docs_of([]), broadcast_bytes=broadcast_bytes).collect() == []


def test_only_suspected_lines_leave_their_task(docs_of):
    """With a wave for each segment too, only repeats and few others are sent as text, each once."""
    docs = docs_of([f"line number {i} of nobody else\nsecond line of text {i}\n{LONG} {i % 7}" for i in range(3000)])
    bare = docs.selectExpr("doc_id AS __id", "text AS __text")
    filters = line_dedup._second_filters(line_dedup._packed_hashes(bare, 8, 20), 8)
    assert sum(r["__bits"] for r in filters.collect()) <= 8 * 1024
    assert len(line_dedup._waves(filters, 0)) == filters.count() > 2 and len(line_dedup._waves(filters, 1 << 20)) == 1
    sent = [line_dedup._suspects(bare, filters, 8, 20, size).collect() for size in (0, 1 << 20)]
    assert sorted(sent[0]) == sorted(sent[1])
    assert sum(LONG.lower().encode() in r["__key"] for r in sent[0]) == 3000 and len(sent[0]) < 3300


def test_bloom_filters_have_no_false_negatives():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 2**64, 4000, np.uint64) for _ in range(5)]
    arrays.append(np.concatenate([arrays[0][:500], arrays[3][-500:]]))
    twice = line_dedup._seen_again(arrays)
    assert twice.has(arrays[5]).all()
    assert twice.has(rng.integers(0, 2**64, 10_000, np.uint64)).mean() < 0.05


# --- archives


def test_files_are_closed_by_records_and_by_bytes(spark, tmp_path):
    """Files of one task: only the last record may bring a file over its bytes, and all records come back."""
    rows = [(i, f"http://example.org/{i}", "é" * (40_000 if i % 10 == 3 else 100)) for i in range(100)] + [(3, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    expected = sorted((i, len((html or "").encode())) for i, _, html in rows)
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_arc(pages, arc, records=40, roll_bytes=100_000)
    read = warc.read_arc(spark, arc).coalesce(1)
    assert sorted((r.page_id, r.payload_bytes) for r in read.collect()) == expected
    warc.convert(read, out, min_payload=1 << 30, records=40, roll_bytes=100_000)
    assert sorted((r.page_id, r.payload_bytes) for r in warc.read_warc(spark, out).collect()) == expected
    for folder, end in ((arc, b"filedesc:"), (out, b"WARC-Type: warcinfo")):
        files = [gzip.decompress(f.read_bytes()) for f in Path(folder).rglob("*.txt.gz")]
        assert len(files) > 5 and max(map(len, files)) < 100_000 + 81_000
        assert all(data.count(end) == 1 for data in files)


def test_pages_come_back_from_archives(spark, trial_dir):
    pages = table(spark, trial_dir, "pages").collect()
    heads = defaultdict(int)
    for page in pages:
        heads[page.html or ""] = max(heads[page.html or ""], page.page_id)
    got = {r.page_id: tuple(r) for r in QUERIES["op4_warc"](spark, trial_dir).collect()}
    for page in pages:
        payload, head = (page.html or "").encode(), heads[page.html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        response = head == page.page_id
        kind = "response" if response else "revisit"
        assert got[page.page_id] == (page.page_id, len(payload), digest, kind, None if response else head)


def test_odd_pages(spark):
    same = "x\r\n\r\nWARC/1.0\r\n"
    rows = [(1, None, None), (2, "http://a b/é", same), (2, "http://a b/é", same), (None, "u", same), (None, "u", "only")]
    rows += [(3, "v", "\x00\n\n"), (4, "v", ""), (-5, "w", "y"), (6, "w", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    got = [(r.page_id, r.record_type, r.payload, r.payload_bytes, r.refers_to) for r in warc.archive_round_trip(pages).collect()]
    expected = [(1, "revisit", "", 0, 4), (2, "response", same, 15, None), (2, "response", same, 15, None)]
    expected += [(None, "revisit", "", 15, 2), (None, "response", "only", 4, None), (3, "response", "\x00\n\n", 3, None)]
    expected += [(4, "response", "", 0, None), (-5, "response", "y", 1, None), (6, "response", "z" * 300_000, 300_000, None)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    large = warc.archive_round_trip(pages, min_payload=1).where("payload_bytes = 0").collect()
    assert {r.record_type for r in large} == {"response"}
    assert warc.archive_round_trip(pages.limit(0)).collect() == []


@pytest.mark.parametrize(("version", "middle"), [(1, ""), (2, " 200 - - 0 f.arc")])
def test_both_versions_of_the_old_format(version, middle):
    block = f"{version} 0 org\n{warc.ARC_FIELDS[version]}\n"
    body = "HTTP/1.1 200 OK\r\nX-Page-Id: 8\r\n\r\nh\né"
    length = len(body.encode())
    file = f"filedesc://f 0.0.0.0 20200101000000 text/plain{middle} {len(block)}\n{block}\n"
    file += f"http://h/ 1.2.3.4 20200102030405 text/html{middle} {length}\n{body}\n"
    (record,) = warc.arc_records(io.BufferedReader(io.BytesIO(file.encode())))
    assert record[:4] == (8, "http://h/", "1.2.3.4", "20200102030405") and record[5:7] == ("h\né", 4)
    cut = io.BufferedReader(io.BytesIO(file.encode()[:-4]))
    with pytest.raises(ValueError, match="declared length"):
        list(warc.arc_records(cut))


# --- vector search


def brute_nearest(rows, every, k):
    out = {}
    for query, q in rows:
        if query % every == 0:
            scores = sorted((-float((np.array(v) * np.array(q)).sum()), i) for i, v in rows if i != query)
            out[query] = [i for _, i in scores[:k]]
    return out


def test_recall_and_scores(spark, trial_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, trial_dir, "embeddings").collect()]
    vectors, found = {i: np.array(v, float) for i, v in rows}, defaultdict(list)
    for r in QUERIES["op5_nearest_neighbours"](spark, trial_dir).orderBy("query_id", "rank").collect():
        assert r.score == pytest.approx(float((vectors[r.query_id] * vectors[r.vec_id]).sum()), abs=1e-12)
        found[r.query_id].append(r.vec_id)
    expected = brute_nearest(rows, 20, 20)
    assert found.keys() == expected.keys() and all(len(f) == 20 for f in found.values())
    assert sum(len(set(found[q]) & set(e)) for q, e in expected.items()) >= 0.9 * 20 * len(expected)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [-1.0, 3.0]), (9, [-1.0, 3.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, leaf int")
    got = vector_search.search(frame, k=20, every=1).orderBy("query_id", "rank").collect()
    assert [(r["rank"], r.vec_id) for r in got if r.query_id == 0] == [(1, 1), (2, 2), (3, 9)]
    assert {r.query_id for r in got} == {0, 1, 2, 9}
    assert vector_search.search(frame.limit(0)).collect() == []


def test_many_equal_vectors_keep_ties_in_order(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)] + [(i, [1.0] * 8) for i in range(600, 900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in vector_search.search(frame, k=10, every=100, target=1.0).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r.vec_id)
    assert found[700] == brute_nearest(rows, 100, 10)[700]


def test_best_first_visits_every_leaf_once():
    sample = np.random.default_rng(4).normal(size=(3000, 5))
    tree = vector_search.fit_tree(sample, float(np.sqrt((sample**2).sum(axis=1)).max()))
    assert sorted(tree.best_first(sample[0])) == list(range(tree.leaves))
    assert next(iter(tree.best_first(sample[0] * 0.999))) in range(tree.leaves)
    assert set(tree.assign(sample)) == set(range(tree.leaves))


# --- toxicity


def test_held_out_scores_rank_toxic_texts_higher(spark, trial_dir):
    folder = trial_dir.replace("sf0.001", "sf0.1")
    rows = QUERIES["op8_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in table(spark, folder, "labels").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    toxic = np.array([r.score for r in held if labels[r.doc_id] == 1])
    plain = np.sort([r.score for r in held if labels[r.doc_id] == 0])
    assert (np.searchsorted(plain, toxic) / len(plain)).mean() > 0.9
    assert (plain >= 0.7).mean() < 0.02


def test_toxicity_of_odd_tables(spark, docs_of):
    docs = docs_of([None, "", "a b", "a b", "x " * 20_000], [None, 1, 2, 2, 3])
    labels = spark.createDataFrame([(None, 1), (2, 1), (2, 0), (3, None), (1, 0)], "doc_id long, toxic int")
    scorer = toxicity.fit_scorer(docs, labels)
    assert {r["__score"] for r in toxicity.score_toxicity(docs, scorer).collect()} == {0.5}
    assert toxicity.keep_ordinary(docs, scorer, 0.4).count() == 2
    assert toxicity.score_toxicity(docs.limit(0), toxicity.fit_scorer(docs.limit(0), labels.limit(0))).collect() == []


def test_only_rows_that_calibrate_are_left_out_of_the_counts(spark, docs_of, monkeypatch):
    docs = docs_of([f"word{i % 7} other{i % 5}" for i in range(600)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    seen, learn = [], toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda train: (seen.append(train.count()), learn(train))[1])
    trained = docs.where(~toxicity.held_out(F.col("doc_id"))).count()
    toxicity.fit_scorer(docs, labels, calibration_rows=10)
    assert seen == [trained - 10]


class BruteToxicity:
    """The two models by dictionaries: log ratios of words, beginnings and pairs."""

    def __init__(self, texts):
        self.pairs = Counter()
        for text, label in texts:
            words = ["", *re.findall(r"\w+", text.lower())]
            self.pairs.update((v, w, label) for v, w in zip(words, words[1:]))
        self.known = {w for _, w, _ in self.pairs}
        self.follows, self.before = Counter((w, c) for _, w, c in self.pairs), Counter()
        for (v, _, c), n in self.pairs.items():
            self.before[v, c] += n
        self.totals = [sum(n for (_, c), n in self.follows.items() if c == label) for label in (0, 1)]
        self.stems = Counter()
        for (w, c), n in self.follows.items():
            for size in range(3, min(len(w), 8) + 1):
                self.stems[w[:size], c] += n

    @staticmethod
    def refine(logs, weights, counts, prior):
        total, out = sum(counts), []
        for c in (0, 1):
            expected = total * weights[c] / sum(weights)
            given_back = sum(min(n, 0.75) for n in counts) * expected / total
            out.append(logs[c] + math.log((max(counts[c] - 0.75, 0) + given_back + prior) / (expected + prior)))
        return out

    def word(self, word):
        """Logs, and whether the word itself says something; of an unknown word those of its longest known beginning."""
        logs = [0.0, 0.0]
        steps = [(self.stems, word[:n]) for n in range(3, min(len(word), 8) + 1)]
        for counts, name in steps + [(self.follows, word)]:
            own = [counts[name, 0], counts[name, 1]]
            if not sum(own):
                break
            logs = self.refine(logs, [n * math.exp(x) for n, x in zip(self.totals, logs)], own, 4)
        return logs

    def ratios(self, text):
        words, raw = ["", *re.findall(r"\w+", (text or "").lower())], [0.0, 0.0]
        for v, w in zip(words, words[1:]):
            logs = self.word(w)
            ratio = logs[1] - logs[0]
            raw[0] += ratio if abs(ratio) > 1.5 else 0.0
            own = [self.pairs[v, w, 0], self.pairs[v, w, 1]]
            if sum(own):
                tilt = logs if abs(ratio) > 1.5 else [0.0, 0.0]
                pair = self.refine([0.0, 0.0], [self.before[v, c] * math.exp(tilt[c]) for c in (0, 1)], own, 8)
                raw[1] += pair[1] - pair[0] if abs(pair[1] - pair[0]) > 0.5 else 0.0
        return [x / (len(words) - 1 + 30) for x in raw]


@pytest.mark.parametrize("block", [400, 1 << 22])
def test_raw_scores_equal_the_models_by_dictionaries(spark, docs_of, trial_dir, monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(0)
    common = [f"word{i}" for i in range(12)] + ["an", "b", "über", "idiotisch", "idioten"]
    texts = [(" ".join(rng.choice(common, 40)) + (" Idiot an idiots! an idiot" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(150)]
    texts += [(r.text, 0) for r in table(spark, trial_dir, "documents").limit(15).collect()]
    scorer = toxicity.learn(spark.createDataFrame(texts, "__text string, __label int"))
    asked = [t for t, _ in texts[:20] + texts[-15:]] + [None, "", "idiotic idio idiotisches WORD3 word33", "an idiot " * 300]
    raw = toxicity.raw_scores(docs_of(asked), scorer, "doc_id", "text").collect()
    brute = BruteToxicity(texts)
    assert len(raw) == len(asked)
    for row in raw:
        assert (row["__words"], row["__pairs"]) == pytest.approx(brute.ratios(asked[row["__id"]]), abs=1e-9)
    assert sum(abs(row["__words"]) + abs(row["__pairs"]) > 0 for row in raw) >= 4


@pytest.mark.parametrize("ends", ["", "bdgk"])
def test_phrases_of_common_words_are_found(spark, docs_of, ends):
    """Toxic texts that differ from others only by the order of common words, in twenty ways."""
    rng = np.random.default_rng(4)
    words = np.array([f"{a}{b}{c}" for a in "bcdfghklmnprst" for b in "aeiou" for c in ends or [""]])
    phrases = [" ".join(rng.choice(words, 3, replace=False)) for _ in range(20)]
    texts, toxic = [], []
    for i in range(9000):
        own = list(rng.choice(words, 30))
        toxic.append(int(i % 30 == 0))
        if toxic[-1]:
            own[10:13] = phrases[i // 30 % 20].split()
        texts.append(" ".join(own))
    docs = docs_of(texts)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, toxicity.fit_scorer(docs, labels)).where("__held_out").collect()
    bad = np.array([r["__score"] for r in scored if toxic[r["__id"]]])
    good = np.sort([r["__score"] for r in scored if not toxic[r["__id"]]])
    below = (np.searchsorted(good, bad) + np.searchsorted(good, bad, side="right")) / 2 / len(good)
    assert below.mean() >= (0.98 if ends else 0.9)


def test_rejected_texts_are_found_through_a_small_filter(spark, docs_of, monkeypatch):
    monkeypatch.setattr(toxicity, "FILTER_BITS", (15, 15))
    texts = [f"plain text number{i}" + (" idiot" * 5 if i % 4 == 0 else "") for i in range(2000)]
    docs = docs_of(texts).union(docs_of([None, "", texts[0]], [5000, 5001, 5002]))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2000)], "doc_id long, toxic int")
    scorer = toxicity.fit_scorer(docs, labels)
    kept = toxicity.keep_ordinary(docs, scorer, 0.7)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(2000) if i % 4] + [5000, 5001]


# --- n-gram join


def brute_groups(rows, n, percent):
    sets, parent = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words)} if 0 < len(words) < n else {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    meet = defaultdict(list)
    for i, own in sets.items():
        for gram in own:
            meet[gram].append(i)
    for i, own in sets.items():
        for j, shared in Counter(j for gram in own for j in meet[gram] if j > i).items():
            if 100 * shared >= percent * (len(own) + len(sets[j]) - shared):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(own), root(i)) for i, own in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (3, 60)])
def test_groups_equal_brute_force(spark, trial_dir, n, percent):
    docs = table(spark, trial_dir, "documents")
    got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(docs, n, percent).collect()}
    assert got == brute_groups([(r.doc_id, r.text) for r in docs.collect()], n, percent)


def test_groups_of_chains_copies_and_near_copies(docs_of):
    """Chains whose ends are far apart, two large groups that share rare n-grams, and many near copies."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(4000)]
    texts = []
    chain = rng.choice(words, 200).tolist()
    for step in range(40):
        chain = chain.copy()
        chain[step * 5] = f"c{step}"
        texts.append(" ".join(chain))
    shared = rng.choice(words, 12).tolist()
    for _ in range(2):
        base = shared + rng.choice(words, 100).tolist()
        for k in range(60):
            copy = base.copy()
            copy[int(rng.integers(12, 112))] = f"n{k}"
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(words, int(rng.integers(1, 60)))) for _ in range(100)]
    texts += texts[:5] + ["one two", "One TWO", "", "one"]
    order = rng.permutation(len(texts)).tolist()
    rows = list(zip(order, texts, strict=True))
    for percent in (90, 95):
        got = ngram_join.similar_groups(docs_of(texts, order), 3, percent).collect()
        assert {r[0]: (r[1], r[2]) for r in got} == brute_groups(rows, 3, percent)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_texts_with_words_appended_prepended_or_cut_off_link(docs_of, n, percent):
    rng = np.random.default_rng(4)
    texts = []
    for i in range(60):
        base = [f"t{i}w{k}" for k in range(int(rng.integers(40, 130)))]
        own = [f"t{i}x{k}" for k in range(30)]
        change = int((len(base) - n + 1) * (100 - percent) / percent) - int(rng.integers(0, 3))
        other = [base + own[:change], own[:change] + base, base[change:], base[:-change]][i % 4]
        copies = (1, 1) if i < 40 else (4, 1) if i < 50 else (1, 4)
        texts += [" ".join(base)] * copies[0] + [" ".join(other)] * copies[1]
    order = rng.permutation(len(texts)).tolist()
    got = ngram_join.similar_groups(docs_of(texts, order), n, percent).collect()
    expected = brute_groups(list(zip(order, texts, strict=True)), n, percent)
    assert {r[0]: (r[1], r[2]) for r in got} == expected
    assert len({first for _, first in expected.values()}) < 90


def test_a_list_is_dealt_into_cells(spark, monkeypatch):
    """No cell holds more than its two blocks, and members of two components meet in one."""
    monkeypatch.setattr(ngram_join, "CELL_BYTES", 20 * (ngram_join.MEMBER_BYTES + 10))
    rows = [(1, i, 10, 10, 0 if i < 200 else i, None, None, None, None) for i in range(300)]
    members = spark.createDataFrame(rows, "list long, id long, size long, common long, c long, low1 double, high1 double, low2 double, high2 double")
    cells = ngram_join._cells(members, spark.createDataFrame([(i, b"\0") for i in range(300)], "id long, bits binary"))
    held = defaultdict(lambda: ([], []))
    for r in cells.collect():
        held[r.list, r.block, r.other][r.outside].append(r.id)
    assert len(held) > 15 * 5 and max(len(inner) + len(outer) for inner, outer in held.values()) < 100
    met = Counter((a, b) for inner, outer in held.values() for a in inner for b in outer)
    assert met == {(a, b): 1 for a in range(300) for b in range(200, 300)}


def test_groups_of_one_list_over_many_cells(docs_of, monkeypatch):
    """A line that all texts share, near copies in one component and others outside of it."""
    monkeypatch.setattr(ngram_join, "CELL_BYTES", 4096)
    rng = np.random.default_rng(5)
    texts = []
    for g in range(12):
        base = ["all", "texts", "hold", "this"] + [f"g{g}w{k % 60}" for k in range(60)]
        for k in range(40 if g == 0 else int(rng.integers(1, 5))):
            copy = base.copy()
            copy[int(rng.integers(5, 60))] = f"g{g}n{k}"
            texts.append(" ".join(copy))
    order = rng.permutation(len(texts)).tolist()
    for percent in (30, 90):
        got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(docs_of(texts, order), 3, percent).collect()}
        assert got == brute_groups(list(zip(order, texts, strict=True)), 3, percent)


def test_groups_over_many_blocks_and_fragments(spark, trial_dir, monkeypatch):
    """Blocks of a few hundred n-grams, so that sets are sent to several and each overlap is the sum of eight parts."""
    monkeypatch.setattr(ngram_join, "FRAGMENT", 50)
    blocks, dealt = [], ngram_join._dealt
    monkeypatch.setattr(ngram_join, "_dealt", lambda pairs, sets, n: blocks.append(n) or dealt(pairs, sets, n))
    docs = table(spark, trial_dir, "documents").where("length(text) < 3000").limit(300).cache()
    got = {r[0]: (r[1], r[2]) for r in ngram_join.similar_groups(docs, 3, 30).collect()}
    assert got == brute_groups([(r.doc_id, r.text) for r in docs.collect()], 3, 30)
    assert max(blocks) > 4


def test_pairs_go_to_one_block_and_sets_to_the_blocks_of_their_pairs(spark):
    """Rows grow with the pairs: eight for each, whatever the number of blocks, and a set that all pairs name is once in each."""
    pairs = spark.createDataFrame([(0, i, 10, 10) for i in range(1, 1001)], "a long, b long, sa long, sb long")
    parts = [(p, i, b"12345678") for i in range(1001) for p in range(ngram_join.FRAGMENTS)]
    sets = spark.createDataFrame(parts, "part long, a long, grams binary")
    for blocks in (1, 20):
        rows = ngram_join._dealt(pairs, sets, blocks).collect()
        asked = [r for r in rows if r.b is not None]
        assert len(asked) == 1000 * ngram_join.FRAGMENTS and len({r.block for r in rows}) == blocks
        assert len(rows) - len(asked) == (1000 + blocks) * ngram_join.FRAGMENTS


def test_each_text_of_an_id_stands_for_itself(docs_of):
    first, second = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    near = first + " more"
    rows = [(1, first), (1, second), (2, second), (3, near), (3, near), (4, near + " yet"), (5, None), (5, None), (6, ""), (7, "x")]
    kept = ngram_join.one_of_each_group(docs_of([t for _, t in rows], [i for i, _ in rows]), 3, 90)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, first), (1, second), (5, None), (6, ""), (7, "x")], key=str)
    assert kept.columns == docs_of([]).columns


def test_groups_of_odd_rows(docs_of):
    docs = docs_of(["a b c", "a b c", None, None, "a b c", "  ", "x" * 50_000], [4, 4, None, 2, None, 3, 9])
    got = sorted(((r[0], r[1], r[2]) for r in ngram_join.similar_groups(docs).collect()), key=str)
    expected = [(4, 1, 4), (4, 1, 4), (None, 0, None), (2, 0, 2), (None, 1, None), (3, 0, 3), (9, 1, 9)]
    assert got == sorted(expected, key=str)
    kept = ngram_join.one_of_each_group(docs, 3, 90)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "9", "None", "None"]
    assert ngram_join.similar_groups(docs.limit(0)).collect() == []


def test_bitmaps_never_refuse_too_much():
    rng = np.random.default_rng(6)
    for _ in range(50):
        x = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 900)), np.uint64))
        y = np.unique(np.concatenate([rng.choice(x, len(x) // 2 + 1), rng.integers(0, 2**64, int(rng.integers(1, 3000)), np.uint64)]))
        most = ngram_join.most_shared(ngram_join._bitmap(x), ngram_join._bitmap(y), len(x) + len(y))
        assert most >= len(np.intersect1d(x, y))


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 1000), (5, 5)], "a long, b long")
    found = {r.id: r.component for r in ngram_join.components(links).collect()}
    assert found == {**{i: 0 for i in range(301)}, 900: 900, 1000: 900}


# --- pipeline


def test_stages_take_effect(spark, trial_dir):
    original = table(spark, trial_dir, "documents")
    docs, seen = original, {}
    for name, work in corpus_pipeline.STAGES:
        before, docs = docs, work(spark, docs, trial_dir).cache()
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == original.columns
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
    rows = {name: {r.doc_id: r.text for r in frame.collect()} for name, frame in seen.items() if name != "best_fit_packing"}
    expected = brute_lines(list(rows["toxicity"].items()))
    assert sorted((str(i), str(t)) for i, t in rows["line_dedup"].items()) == [e[:2] for e in expected]
    groups = brute_groups(list(rows["line_dedup"].items()), 5, 80)
    assert rows["ngram_jaccard_join"].keys() == {i for i, (_, first) in groups.items() if i == first}
    assert not any("AKIA" in text or "password=" in text for text in rows["secret_scan"].values())
    assert {r.doc_id for r in seen["best_fit_packing"].collect()} == rows["secret_scan"].keys()
    assert all(r.n_chars == len(r.text) for r in seen["secret_scan"].collect())


def test_stages_of_an_empty_table(spark, trial_dir):
    docs = table(spark, trial_dir, "documents").limit(0)
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, docs, trial_dir).collect() == []


def test_line_hashes_hold_the_texts_of_a_slice_and_not_of_a_batch(spark):
    class Rows:
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            return work

    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh \n", k=300)) * 10 for _ in range(10_240)]
    batch = pa.RecordBatch.from_pydict({"__text": texts})
    work = line_dedup._packed_hashes(Rows(), 4, 20)
    tracemalloc.start()
    try:
        rows = sum(found.num_rows for found in work(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 4 and most < 20e6 < batch.nbytes
