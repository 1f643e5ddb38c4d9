"""Drawing documents: towards a target corpus, and from sources by weight."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import mixing, resampling
from starmart.llm.common import table
from starmart.llm.queries import ORACLE, QUERIES

ODD = [None, "", " \n", "!?", "One", "one ONE, one; two", "Ärger Ärger\x7fÄ", "a1 b2 " * 400, "x" * 5000, "same words", "same words"]

# --- towards a target


def features(text, longest):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def drawn_by_hand(texts, ids, target, percent, least_words, longest, buckets, seed):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    own = Counter(bucket(f) for text in texts for f in features(text, longest)[1])
    wanted = Counter(bucket(f) for text in target for f in features(text, longest)[1])
    s, t = sum(own.values()), sum(wanted.values())
    rows = []
    for i, text in zip(ids, texts):
        words, found = features(text, longest)
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets))))
            for b in map(bucket, found)
        )
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words) >= least_words])
    may = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for rank, row in enumerate(may[: percent * len(may) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize(("longest", "buckets"), [(1, 10_000), (3, 50)])
def test_drawn_documents_equal_those_by_hand(spark, docs_of, trial_dir, longest, buckets):
    texts = [*ODD, *(r.text for r in table(spark, trial_dir, "documents").limit(60).collect())]
    target = table(spark, trial_dir, "benchmark")
    known = [r.text for r in target.collect()]
    found = resampling.resample(docs_of(texts), target, percent=30, least_words=2, longest=longest, buckets=buckets)
    expected = drawn_by_hand(texts, range(len(texts)), known, 30, 2, longest, buckets, 2024)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_features_do_not_depend_on_segments():
    text = "Alpha beta, gamma! " * 50 + "x" * 300 + " Ärger über öl"
    expected = sorted(zlib.crc32(f.encode()) for f in features(text, 3)[1])
    for size in (1, 7, 64, 1 << 20):
        parts = list(resampling.feature_sums(text, 3, resampling._Sums(), size))
        assert sorted(crc for _, found in parts for crc in found) == expected
        assert sum(n for n, _ in parts) == len(features(text, 1)[0])


def test_gains_of_equal_shares_are_zero():
    assert resampling.bucket_gains(np.array([3, 3, 0]), np.array([3, 3, 0])).tolist() == [0, 0, 0]


def test_nothing_is_drawn_from_nothing(docs_of):
    assert resampling.resample(docs_of([]), docs_of(["a"])).collect() == []
    rows = resampling.resample(docs_of(["a b", "a b", None], [4, 4, None]), docs_of([]), percent=100, least_words=2).collect()
    assert sorted((r["__id"] or -1, r["__rank"] or 0) for r in rows) == [(-1, 0), (4, 1), (4, 2)]


def test_resampling_query_equals_its_sql(spark, trial_dir):
    name = "op13_importance_resampling"
    assert compare.differences(QUERIES[name](spark, trial_dir), compare.connect(trial_dir), ORACLE[name]) == []


# --- from sources by weight


def mixed_by_hand(rows, weights, percent, epochs, seed, tried):
    """rows: (id, source, text, weight)."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for _, _, text, _ in rows]
    by_source = defaultdict(list)
    for n, (i, source, _, weight) in enumerate(rows):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:13], 16)
        draw = -math.log((h + 0.5) / 2**52)
        by_source[source].append((draw / weight if weight > 0 else math.inf, i is None, i or 0, sizes[n], n))
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    turn = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    own = {s: sum(m[3] for m in by_source[s]) for s in names}
    target, open_sources, budget = {}, set(names), sum(sizes) * percent / 100
    while open_sources:
        share = {s: budget * turn[s] / sum(turn[x] for x in open_sources) for s in open_sources}
        above = {s for s in open_sources if share[s] >= epochs * own[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = epochs * own[s]
            budget -= target[s]
        open_sources -= above
    taken = [0] * len(rows)
    for s in names:
        whole = int(target[s] / own[s] + 1e-9) if own[s] else 0
        gap, left = target[s] - whole * own[s], None
        for *_, size, n in sorted(by_source[s]):
            taken[n] = size * whole
            if size and gap > 1e-9 and (left is None or left > 0):
                fits = size <= gap + 1e-9
                if not fits or left is not None:
                    left = (tried if left is None else left) - 1
                if fits:
                    taken[n] += size
                    gap -= size
    return sizes, own, target, taken


def source_rows(spark, rows):
    return spark.createDataFrame(
        [(i, source, text, "x", n) for n, (i, source, text, _) in enumerate(rows)],
        "doc_id long, source string, text string, size string, weight long",
    )


@pytest.mark.parametrize(("ranges", "tried"), [(1, 64), (7, 3)])
def test_mix_equals_the_one_by_hand(spark, monkeypatch, ranges, tried):
    rng = np.random.default_rng(ranges)
    names, rows = ["a", "b", "Z", "é", "\U0001f600", "tiny", None, "none"], []
    for i in range(600):
        source = names[0] if i % 3 == 0 else names[rng.integers(1, 7)]
        n = int(rng.integers(0, 40)) if i != 5 else 900
        n = n if source != "tiny" or i % 50 == 1 else 0
        rows.append((i, source, " ".join(["w"] * n) if n or i % 2 else None, [1.0, 2.0, 0.5, 0.0][i % 4]))
    rows += [(9_000, "none", "", 1.0), (9_001, "none", None, 1.0), (9_002, "a", "y\x1cy\x0bz\u00a0z", 1.0)]
    monkeypatch.setattr(mixing, "LEAST_RANGE", len(rows) // ranges)
    monkeypatch.setattr(mixing, "RANGE", len(rows) // ranges)
    quality = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, weight double")
    quality = quality.unionByName(quality.withColumn("weight", F.col("weight") / 2))
    arguments = dict(weights=[5, 2, 1], percent=150, epochs=2, seed=7, tried=tried)
    found = {r["__id"]: r for r in mixing.mix(source_rows(spark, rows), quality=quality, **arguments).collect()}
    sizes, own, target, taken = mixed_by_hand(rows, [5, 2, 1], 150, 2, 7, tried)
    assert len(found) == len(rows)
    for n, (i, source, _, _) in enumerate(rows):
        row = found[i]
        assert (row["__size"], row["__source_size"], row["__taken"]) == (sizes[n], own[source], taken[n])
        assert row["__target"] == pytest.approx(target[source], rel=1e-12)


def test_each_source_comes_near_its_target(spark, trial_dir):
    rows = QUERIES["op11_source_mixing"](spark, trial_dir.replace("sf0.001", "sf0.01")).collect()
    docs = {r.doc_id: r.source for r in table(spark, trial_dir.replace("sf0.001", "sf0.01"), "documents").collect()}
    taken = Counter()
    for r in rows:
        taken[docs[r.doc_id]] += r.taken
        assert r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size
    target = {docs[r.doc_id]: r.target for r in rows}
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    assert all(0.99 * target[s] <= taken[s] <= target[s] for s in target)


def test_heavier_documents_are_drawn_more_often(spark):
    rows = [(i, "s", "w w", 4.0 if i % 2 else 1.0) for i in range(2000)]
    quality = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, weight double")
    found = mixing.mix(source_rows(spark, rows), [1], percent=20, epochs=1, quality=quality).collect()
    drawn = Counter(r["__id"] % 2 for r in found if r["__taken"])
    assert sum(drawn.values()) == 400 and drawn[1] > 3 * drawn[0]


def test_mixes_of_little(spark):
    assert mixing.mix(source_rows(spark, []), [5, 2, 1], 150).collect() == []
    rows = mixing.mix(source_rows(spark, [(1, None, None, 1), (None, None, "", 1)]), [5, 2, 1], 150).collect()
    assert sorted((r["__size"], r["__target"], r["__taken"]) for r in rows) == [(0, 0.0, 0)] * 2
    twice = mixing.mix(source_rows(spark, [(3, "s", "a b", 1)] * 4), [1], 50).collect()
    assert sorted(r["__taken"] for r in twice) == [0, 0, 2, 2]


def test_mixing_query_equals_its_sql(spark, trial_dir):
    name = "op11_source_mixing"
    assert compare.differences(QUERIES[name](spark, trial_dir), compare.connect(trial_dir), ORACLE[name]) == []
