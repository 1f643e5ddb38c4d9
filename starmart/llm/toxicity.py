"""Toxicity by two class-conditional language models with Kneser-Ney smoothing.

Each class (toxic, ordinary) has a bigram model over a word model. The lower order counts continuations, as Kneser and Ney have it: a word
counts once for each different word that it follows in the class. Both orders back off to counts that the classes share. What a class
shows of an expression is discounted, and the discounts go back as the shared counts expect; then both what is seen and what is
expected are raised by a prior. So a rare expression is about as likely in one class as in the other, and only what one class says far
more often than its share moves a score. A word is expected as its beginnings are, from three characters on, which finds an uncommon form of
a common stem; a pair is expected as its left word's occurrences and its right word are.

Every word, beginning and pair of the training texts is counted, in tables that grow with them and are only joined. Expressions whose log
ratio of toxic over ordinary stays within a limit count as equally likely in both. The others are the model, a table. Texts
are scored in blocks: a block asks once for each expression that the model may hold, by the sums of a filter of bounded size, and
answers come back to the blocks; what the filter lets through in vain finds no answer, so it decides only what moves.

A document's two raw scores are the sums, over its words and over its pairs, of the log ratios of all their occurrences, divided by its
number of words (and SHORT more, so that a few words are no proof). A logistic curve, fitted on labelled rows that the counts leave out, turns them
into a score from 0 to 1.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .bpe import _Numbers, _pack_lists, _unpack_lists
from .common import map_batches, slices, strings

# Kneser-Ney discount, and the counts by which what is seen and what is expected are raised: of words and of pairs.
DISCOUNT = 0.75
PRIOR, PAIR_PRIOR = 4.0, 8.0
# Log ratios up to these count as none. Pairs are weighed against their own words, so less of theirs is chance.
EVIDENCE, PAIR_EVIDENCE = 1.5, 0.5
# Words by which each text counts as longer.
SHORT = 30
# Beginnings on which a word's expectation rests, in characters.
STEMS = range(3, 9)
# Code points of the documents that are counted or scored together, about; longer texts are read word by word.
BLOCK = 3 << 20
# Fewest and most bits of the filter, as powers of two: 64 MB at most; and bits for each expression of the model, below that.
FILTER_BITS = (15, 29)
BITS_EACH = 64
# Labels up to this many rows are sent to the texts; more are joined by Spark's own choice.
BROADCAST_LABELS = 2_000_000
# One labelled row in CALIBRATION_SHARE fits the logistic curve; of these at most CALIBRATION_ROWS, lowest hash first.
CALIBRATION_SHARE = 6
CALIBRATION_ROWS = 20_000

_WORD = re.compile(r"\w+")
# Spark's xxhash64 of a text is this sum with its seed, so keys made on either side agree.
_SEED = 42
# Bits of a bitmap row of Spark's bitmap functions.
_BITMAP = 32_768


def held_out(id_column: Column) -> Column:
    """Rows that never train: the CRC-32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), _SEED)


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left ^ ((right << np.uint64(1)) | (right >> np.uint64(63)))


def _pair_key(left: Column, right: Column) -> Column:
    turned = F.shiftleft(right, 1).bitwiseOR(F.shiftrightunsigned(right, 63))
    return left.bitwiseXOR(turned)


def _stem_mark(text: str) -> str:
    """No word has this mark, so beginnings and words have keys of their own."""
    return text + "*"


class _Texts:
    """Words of some texts by number; number 0 is the place before the first word."""

    def __init__(self):
        self.words, self.rows, self.size = _Numbers(), [], 0
        self.words[""]

    def add(self, text: str) -> None:
        number = self.words.__getitem__
        if len(text) > BLOCK:
            found = np.fromiter((number(m.group()) for m in _WORD.finditer(text.lower())), np.int64)
        else:
            words = _WORD.findall(text.lower())
            found = np.fromiter(map(number, words), np.int64, len(words))
        self.rows.append(found)
        self.size += len(text)

    def keys(self) -> np.ndarray:
        return np.fromiter(map(_key, self.words), np.uint64, len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, left and right number of every word's occurrence, in order."""
        lengths = np.fromiter(map(len, self.rows), np.int64, len(self.rows))
        right = np.concatenate([*self.rows, np.zeros(0, np.int64)])
        left = np.zeros(len(right), np.int64)
        left[1:] = right[:-1]
        starts = np.cumsum(lengths) - lengths
        left[starts[lengths > 0]] = 0
        return np.repeat(np.arange(len(lengths)), lengths), left, right


def _words_of(train: DataFrame) -> DataFrame:
    """The different words of all texts."""

    def work(batches):
        texts = _Texts()

        def drain():
            words = [word for word in texts.words if word]
            for at in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 50_000], pa.string())], names=["word"])

        for batch in slices(batches):
            for text in strings(batch.column(0)):
                texts.add(text)
                texts.rows.clear()
                if texts.size >= BLOCK:
                    yield from drain()
                    texts = _Texts()
        yield from drain()

    return map_batches(train.select("__text"), work, "word string").distinct()


def _count_pairs(train: DataFrame) -> DataFrame:
    """Rows (v, w, toxic, ordinary): occurrences of each pair of words, summed within blocks before they move."""

    def work(batches):
        texts, labels = _Texts(), []

        def drain():
            row, left, right = texts.pairs()
            size, toxic = len(texts.words), np.array(labels, bool)
            codes, place = np.unique(left * size + right, return_inverse=True)
            counts = [np.bincount(place, of, len(codes)).astype(np.int64) for of in (toxic[row], ~toxic[row])]
            keys = texts.keys().view(np.int64)
            for at in range(0, len(codes), 100_000):
                part = slice(at, at + 100_000)
                columns = [keys[codes[part] // size], keys[codes[part] % size], *(c[part] for c in counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["v", "w", "toxic", "ordinary"])

        for batch in slices(batches):
            for text, label in zip(strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                texts.add(text)
                labels.append(label)
                if texts.size >= BLOCK:
                    yield from drain()
                    texts, labels = _Texts(), []
        if labels:
            yield from drain()

    counted = map_batches(train.select("__text", "__label"), work, "v long, w long, toxic long, ordinary long")
    return counted.groupBy("v", "w").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def least_pair(prior: float = PAIR_PRIOR, evidence: float = PAIR_EVIDENCE) -> int:
    """Occurrences below which no pair can be evidence: counts and expectations lie between 0 and the occurrences."""
    return next(n for n in range(1, 1 << 20) if 2 * math.log((n + prior) / prior) > evidence)


def _refined(
    logs: tuple[Column, Column], share: Column, counts: tuple[Column, Column], prior: float
) -> tuple[Column, Column]:
    """Logs of what each class shows over its share, of an expression of which the toxic class is expected to have ``share``."""
    total = counts[0] + counts[1]
    given_back = (F.least(counts[0], F.lit(DISCOUNT)) + F.least(counts[1], F.lit(DISCOUNT))) / total
    out = []
    for log, part, count in zip(logs, (share, 1 - share), counts):
        expected = total * part
        smoothed = F.greatest(count - DISCOUNT, F.lit(0.0)) + given_back * expected
        out.append(log + F.log((smoothed + prior) / (expected + prior)))
    return out[0], out[1]


@dataclass(frozen=True)
class Scorer:
    """The model (a written table of ``key``, ``value``, ``is_pair``), its filter, and the weights of both raw scores and a constant."""

    model: DataFrame
    bits: np.ndarray
    weights: np.ndarray

    def score(self) -> Column:
        """The score of raw scores ``__words`` and ``__pairs``."""
        a, b, c = (float(w) for w in self.weights)
        x = F.lit(a) * F.col("__words") + F.lit(b) * F.col("__pairs") + F.lit(c)
        return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(700.0)), F.lit(-700.0))))


def learn(train: DataFrame) -> Scorer:
    """The model of all rows (``__text``, ``__label``: 1 toxic, 0 ordinary) of ``train``; the weights are zeros."""
    grouped = _count_pairs(train)
    often = F.col("toxic") + F.col("ordinary") >= least_pair()
    none = F.lit(None).cast("long")
    # One exchange serves the three: pairs that can be evidence, and what each word follows and is followed by, of all pairs.
    parts = [
        grouped.where(often).select(F.lit(0).alias("kind"), "v", "w", "toxic", "ordinary"),
        grouped.groupBy("w")
        .agg(F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("ordinary") > 0).alias("ordinary"))
        .select(F.lit(1).alias("kind"), none.alias("v"), "w", "toxic", "ordinary"),
        grouped.groupBy("v")
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
        .select(F.lit(2).alias("kind"), "v", none.alias("w"), "toxic", "ordinary"),
    ]
    counts = stage(parts[0].unionByName(parts[1]).unionByName(parts[2]), "toxicity-counts")
    double = {c: F.col(c).cast("double") for c in ("toxic", "ordinary")}
    follows = counts.where("kind = 1").select("w", *[c.alias(n) for n, c in double.items()])
    totals = [float(n or 0) for n in follows.agg(F.sum("toxic"), F.sum("ordinary")).first()]

    words = stage(_words_of(train).join(follows, F.xxhash64("word") == F.col("w")).drop("w"), "toxicity-words")
    expressions = stage(_word_evidence(words, totals), "toxicity-expressions")
    own = F.abs("value") > EVIDENCE
    found = expressions.where(own | (F.abs("parent") > EVIDENCE)).groupBy("key")
    # An expression without evidence hides its shorter beginnings that have some.
    listed = found.agg(F.max(F.when(own, F.col("value")).otherwise(0.0)).alias("value")).withColumn("is_pair", F.lit(False))

    known = expressions.where(own & F.col("whole")).select(F.col("key").alias("w"), "toxic_log", "ordinary_log")
    before = counts.where("kind = 2").select("v", F.col("toxic").alias("v_toxic"), F.col("ordinary").alias("v_ordinary"))
    pairs = counts.where("kind = 0").drop("kind").withColumns(double).join(before, "v").join(known, "w", "left")
    weights = [
        F.col(f"v_{c}") * F.exp(F.coalesce(F.col(f"{c}_log"), F.lit(0.0))) for c in ("toxic", "ordinary")
    ]
    pairs = pairs.withColumn("share", weights[0] / (weights[0] + weights[1]))
    zero = F.lit(0.0)
    logs = _refined((zero, zero), F.col("share"), (F.col("toxic"), F.col("ordinary")), PAIR_PRIOR)
    paired = pairs.select(_pair_key(F.col("v"), F.col("w")).alias("key"), (logs[0] - logs[1]).alias("value"))
    paired = paired.where(F.abs("value") > PAIR_EVIDENCE).groupBy("key").agg(F.max("value").alias("value"))
    model = stage(listed.unionByName(paired.withColumn("is_pair", F.lit(True))), "toxicity-model")
    return Scorer(model, _filter(model), np.zeros(3))


def _word_evidence(words: DataFrame, totals: list[float]) -> DataFrame:
    """Rows of each word and each of its beginnings: ``key``, ``value`` (log ratio), ``parent`` (that of the next shorter one).

    ``whole`` marks words; ``toxic_log`` and ``ordinary_log`` are the two logs. Beginnings come once per word that has them, alike.
    """
    beginnings = F.array(*[F.when(F.char_length("word") >= n, F.substring("word", 1, n)) for n in STEMS])
    each = words.select("word", F.explode(beginnings).alias("stem"), "toxic", "ordinary").where("stem IS NOT NULL")
    stems = each.groupBy("stem").agg(F.sum("toxic").alias("s_toxic"), F.sum("ordinary").alias("s_ordinary"))
    length = F.char_length("stem")
    counts = [
        F.max(F.when(length == n, F.col(f"s_{c}"))).alias(f"{c}{n}") for n in STEMS for c in ("toxic", "ordinary")
    ]
    steps = each.select("word", "stem").join(stems, "stem").groupBy("word").agg(*counts)
    now = words.join(steps, "word", "left").withColumns({f"{c}_log": F.lit(0.0) for c in ("toxic", "ordinary")})
    # The toxic class's part of what both classes' totals and logs expect; 0 where it has nothing.
    odds = F.lit(totals[1] / totals[0] if totals[0] else math.inf) * F.exp(F.col("ordinary_log") - F.col("toxic_log"))
    rows = []
    for n in [*STEMS, ""]:
        name = F.concat(F.substring("word", 1, n), F.lit("*")) if n else F.col("word")
        known = F.col(f"toxic{n}").isNotNull()
        logs = F.col("toxic_log"), F.col("ordinary_log")
        now = now.withColumns({"share": 1 / (1 + odds), f"parent{n}": logs[0] - logs[1]})
        toxic, ordinary = _refined(logs, F.col("share"), (F.col(f"toxic{n}"), F.col(f"ordinary{n}")), PRIOR)
        now = now.withColumns({"toxic_log": F.when(known, toxic).otherwise(logs[0]), "ordinary_log": F.when(known, ordinary).otherwise(logs[1])})
        now = now.withColumns({f"toxic_at{n}": F.col("toxic_log"), f"ordinary_at{n}": F.col("ordinary_log")})
        row = F.struct(
            F.xxhash64(name).alias("key"),
            (F.col(f"toxic_at{n}") - F.col(f"ordinary_at{n}")).alias("value"),
            F.col(f"parent{n}").alias("parent"),
            F.lit(not n).alias("whole"),
            F.col(f"toxic_at{n}").alias("toxic_log"),
            F.col(f"ordinary_at{n}").alias("ordinary_log"),
        )
        rows.append(F.when(known, row))
    return now.select(F.explode(F.array(*rows)).alias("row")).where("row IS NOT NULL").select("row.*")


def _filter(model: DataFrame) -> np.ndarray:
    """Bits by the low bits of the keys of the model, packed: as many as serve its size, at most 64 MB."""
    least, most = FILTER_BITS
    size = 1 << min(max(math.ceil(math.log2(max(model.count(), 1) * BITS_EACH)), least), most)
    place = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    rows = model.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    packed = np.zeros(size // 8, np.uint8)
    for bucket, bits in rows.toLocalIterator():  # 4 KB each, 64 MB in all at most
        at = (bucket - 1) * _BITMAP // 8
        packed[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return packed


def _may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _questions(texts: _Texts, bits: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys that the model may hold, and which of them each row's words and pairs hang on, packed for the answer.

    An item is a word, with the places of the keys of itself and its beginnings, longest first (-1: not asked), or a pair, with one.
    """
    keys, stems, width = texts.keys(), {}, 1 + len(STEMS)
    table = np.zeros((len(keys), width), np.uint64)
    asks = np.zeros((len(keys), width), bool)
    table[:, 0] = keys
    asks[1:, 0] = True
    for column, n in enumerate(reversed(STEMS), 1):
        at = [i for i, word in enumerate(texts.words) if len(word) >= n]
        own = []
        for i, word in zip(at, (word for word in texts.words if len(word) >= n)):
            stem = word[:n]
            if stem not in stems:
                stems[stem] = _key(_stem_mark(stem))
            own.append(stems[stem])
        table[at, column] = np.array(own, np.uint64)
        asks[at, column] = True
    asks &= _may_hold(bits, table.ravel()).reshape(table.shape)
    row, left, right = texts.pairs()
    pair_keys = _pair_keys(keys[left], keys[right])
    paired = _may_hold(bits, pair_keys)
    own_pairs, pair_of = np.unique(pair_keys[paired], return_inverse=True)
    asked = np.unique(np.concatenate([table[asks], own_pairs]))

    words = np.flatnonzero(asks.any(axis=1))
    item_of = np.full(len(keys), -1, np.int64)
    item_of[words] = np.arange(len(words))
    places = np.where(asks[words], np.searchsorted(asked, table[words]), -1)
    pair_places = np.full((len(own_pairs), width), -1, np.int64)
    pair_places[:, 0] = np.searchsorted(asked, own_pairs)
    worded = item_of[right] >= 0
    n_items = max(len(words) + len(own_pairs), 1)
    hits = np.concatenate([row[worded] * n_items + item_of[right[worded]], row[paired] * n_items + len(words) + pair_of])
    hits, counts = np.unique(hits, return_counts=True)
    lengths = [len(r) for r in texts.rows]
    parts = [lengths, hits // n_items, hits % n_items, counts, np.concatenate([places, pair_places]).ravel(), [len(words)]]
    return asked.view(np.int64), [np.asarray(p, "<i4") for p in parts]


def raw_scores(docs: DataFrame, scorer: Scorer, id_col: str, text_col: str) -> DataFrame:
    """``__id``, ``__words`` and ``__pairs`` of every row: log ratios of its words and its pairs, divided by its length."""
    sent, kind = docs.sparkSession.sparkContext.broadcast(scorer.bits), docs.schema[id_col].dataType.simpleString()

    def ask(batches):
        from pyspark import TaskContext

        number, texts, ids = TaskContext.get().partitionId() << 33, _Texts(), []

        def close():
            keys, parts = _questions(texts, sent.value)
            own = pa.concat_arrays(ids)
            packed = _pack_lists([part.tobytes() for part in parts], compress=True)
            columns = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays([0, len(own)], own),
                pa.array([keys], pa.list_(pa.int64())),
                pa.array([packed], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "keys", "hits"])

        for batch in slices(batches):
            start = 0
            for row, text in enumerate(strings(batch.column(1))):
                texts.add(text)
                if texts.size >= BLOCK:
                    ids.append(batch.column(0).slice(start, row + 1 - start))
                    yield from close()
                    number, texts, ids, start = number + 1, _Texts(), [], row + 1
            ids.append(batch.column(0).slice(start))
        if texts.rows:
            yield from close()

    bare = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    blocks = stage(map_batches(bare, ask, f"block long, ids array<{kind}>, keys array<long>, hits binary"), "toxicity-blocks")
    asked = blocks.select("block", F.posexplode("keys").alias("place", "key"))
    told = asked.join(scorer.model, "key").groupBy("block").agg(F.collect_list(F.struct("place", "value", "is_pair")).alias("told"))
    joined = blocks.select("block", "ids", F.size("keys").alias("n"), "hits").join(told, "block", "left").drop("block")

    def answer(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n, told = batch.column(0)[i].values, batch.column(1)[i].as_py(), batch.column(3)[i].values
                parts = [np.frombuffer(p, "<i4") for p in _unpack_lists(batch.column(2)[i].as_py(), compressed=True)]
                lengths, row, item, counts, places, (n_words,) = parts
                # One value more than there are keys, for those that are not asked; words and pairs keep apart.
                values = np.full((2, n + 1), np.nan)
                if told is not None:
                    is_pair = told.field("is_pair").to_numpy(zero_copy_only=False).astype(int)
                    values[is_pair, told.field("place").to_numpy()] = told.field("value").to_numpy()
                table = places.reshape(-1, 1 + len(STEMS))
                side = (np.arange(len(table)) >= n_words).astype(int)
                found = values[side[:, None], table]
                first = np.argmax(~np.isnan(found), axis=1) if len(found) else np.zeros(0, int)
                item_value = np.nan_to_num(found[np.arange(len(found)), first])
                raw = np.zeros((2, len(lengths)))
                np.add.at(raw, (side[item], row), counts * item_value[item])
                raw /= lengths + SHORT
                yield pa.RecordBatch.from_arrays([ids, pa.array(raw[0]), pa.array(raw[1])], names=["__id", "__words", "__pairs"])

    return map_batches(joined, answer, f"__id {kind}, __words double, __pairs double")


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of the columns of ``x`` and a constant, by damped Newton steps on standardized values, lightly regularized."""
    mean, spread = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    rows = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (y - p) - 1e-2 * w
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w += move * min(1.0, 4.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    own = w[:-1] / spread
    return np.append(own, w[-1] - own @ mean)


def fit_scorer(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    calibration_rows: int = CALIBRATION_ROWS,
    broadcast_labels: int = BROADCAST_LABELS,
) -> Scorer:
    """A scorer learned from labelled rows of ``docs`` that are not held out.

    Labels other than 0 and 1 are not used; an id with both is toxic; a null id never trains; repeated rows count each. Without labels of
    both classes among the calibrating rows, as with an empty table, every score is 0.5. Very long texts are read word by word.
    """
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("__label"))
    )
    known = stage(known, "toxic-labels")
    small = known.count() <= broadcast_labels
    texts = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    calibrates = F.pmod(F.xxhash64("__id"), F.lit(CALIBRATION_SHARE)) == 0
    sample = stage(known.where(calibrates).orderBy(F.xxhash64("__id"), "__id").limit(calibration_rows), "calibration")
    counted = known.join(F.broadcast(sample.select("__id")), "__id", "left_anti")
    train = texts.join(F.broadcast(counted) if small else counted, "__id").select("__text", "__label")
    scorer = learn(train)

    chosen = texts.join(F.broadcast(sample), "__id").select("__label", "__text")
    # Repeated rows of an id may make more than the sample's rows.
    fitted = raw_scores(chosen, scorer, "__label", "__text").limit(calibration_rows).collect()
    rows = np.array([(r["__words"], r["__pairs"], r["__id"]) for r in fitted], float).reshape(-1, 3)
    both = 0 < rows[:, 2].sum() < len(rows)
    return replace(scorer, weights=fit_logistic(rows[:, :2], rows[:, 2])) if both else scorer


def score_toxicity(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id``, ``__held_out`` and ``__score`` (0 to 1, higher: toxic likelier) of every row.

    Null and empty texts have no words and get the score of raw scores of 0. Repeated rows are scored each; extra columns are
    left behind; an empty table gives an empty one. Only expressions that the model may hold move, once per block.
    """
    raw = raw_scores(docs, scorer, id_col, text_col)
    return raw.select("__id", held_out(F.col("__id")).alias("__held_out"), scorer.score().alias("__score"))


def keep_ordinary(docs: DataFrame, scorer: Scorer, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, that score below ``threshold``. Null and empty texts stay; equal texts share their fate.

    Rejected texts are known by two sums of their bytes. A filter of bounded size, made of these, picks the rows that may be among
    them; only those are joined, so texts that stay hardly move.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = docs.where(text != "").select(F.struct(F.xxhash64(text).alias("a"), F.crc32(text).alias("b")).alias("__sums"), text.alias("__text"))
    raw = raw_scores(digest, scorer, "__sums", "__text")
    rejected = raw.where(scorer.score() >= threshold).select(F.col("__id")["a"].alias("key"), F.col("__id")["b"].alias("__b"))
    rejected = stage(rejected.distinct(), "toxic-texts")
    sent = docs.sparkSession.sparkContext.broadcast(_filter(rejected))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(_may_hold(sent.value, keys.to_numpy().view(np.uint64)))

    marked = docs.withColumns({"__key": F.xxhash64(text), "__crc": F.crc32(text)}).withColumn("__maybe", maybe(F.col("__key")))
    suspects = marked.where("__maybe").join(
        rejected, (F.col("__key") == F.col("key")) & (F.col("__crc") == F.col("__b")), "left_anti"
    )
    return marked.where("NOT __maybe").select(docs.columns).unionByName(suspects.select(docs.columns))
