"""Learned decision lists over text statistics, in Spark expressions from the text to the verdict.

Sequential covering: a rule is a conjunction of thresholds, grown literal by literal on one part of the labelled rows
and cut back on another; the rows that it covers are put aside and the next rule is grown on the rest. Rows never
reach the driver: every step is one aggregate that counts both classes for each bin of each statistic.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .common import SPACE_CLASS, bind

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks"]

# Every labelled row whose hash falls on this third is kept from growing and used to cut rules back.
_FOLDS = 3


def _repeat_words(words: Column) -> Column:
    """Words inside any window of WINDOW words that occurs more than once, in time n log n."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(sorted_windows: Column) -> Column:
        same = F.filter(
            sorted_windows,
            lambda w, i: F.coalesce(F.get(sorted_windows, i - 1)["h"] == w["h"], F.lit(False))
            | F.coalesce(F.get(sorted_windows, i + 1)["h"] == w["h"], F.lit(False)),
        )
        starts = F.sort_array(F.transform(same, lambda w: w["at"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))

        def step(seen: Column, at: Column) -> Column:
            more = F.least(F.lit(WINDOW), at - seen["last"]).cast("long")
            return F.struct((seen["n"] + more).alias("n"), at.alias("last"))

        return F.aggregate(starts, start, step, lambda seen: seen["n"])

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        repeated = bind(F.sort_array(placed), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(repeated)

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(bind(windows, count))


def text_counts(text: Column) -> Column:
    """A struct of ``COUNTS``. Null text has no words and no lines."""
    text = F.coalesce(text, F.lit(""))
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE_CLASS}]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    def of_text(words: Column, lines: Column) -> Column:
        found = {
            "n_words": words["n_words"],
            "word_chars": words["word_chars"],
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": lines["n_dup_lines"],
            "n_repeat_words": words["n_repeat_words"],
            "n_lines": lines["n_lines"],
            "n_capitals": F.regexp_count(text, F.lit("[A-Z]")).cast("long"),
            "n_marks": F.regexp_count(text, F.lit("[!?]")).cast("long"),
        }
        return F.struct(*[found[c].alias(c) for c in COUNTS])

    words = F.regexp_extract_all(text, F.lit(f"[^{SPACE_CLASS}]+"), 0)
    return bind(bind(words, of_words), lambda w: bind(bind(with_word, of_lines), lambda ls: of_text(w, ls)))


def features(counts: Column) -> dict[str, Column]:
    """What the rules may ask about, as doubles."""

    def per(top: str, bottom: str) -> Column:
        return counts[top].cast("double") / F.greatest(counts[bottom], F.lit(1)).cast("double")

    return {
        "words": counts["n_words"].cast("double"),
        "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "duplicate_lines": per("n_dup_lines", "n_lines"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "capitals_per_word": per("n_capitals", "n_words"),
        "marks_per_word": per("n_marks", "n_words"),
    }


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    bound: float

    def condition(self, values: Mapping[str, Column]) -> Column:
        value = values[self.feature]
        return value >= F.lit(self.bound) if self.at_least else value < F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.bound:.6g}"


Rule = tuple[Literal, ...]


def _holds(rule: Sequence[Literal], values: Mapping[str, Column]) -> Column:
    return reduce(and_, [literal.condition(values) for literal in rule], F.lit(True))


def decision(rules: Sequence[Rule], values: Mapping[str, Column]) -> Column:
    """The ordered list as one conditional expression: true where the first matching rule rejects."""
    if not rules:
        return F.lit(False)
    chain = F.when(_holds(rules[0], values), True)
    for rule in rules[1:]:
        chain = chain.when(_holds(rule, values), True)
    return chain.otherwise(False)


def _bounds(rows: DataFrame, names: Sequence[str], steps: int) -> dict[str, list[float]]:
    """Quantiles of each class, so that a rare class has bounds of its own."""
    shares = F.array(*[F.lit((i + 0.5) / steps) for i in range(steps)])
    found = rows.groupBy("__bad").agg(*[F.percentile_approx(n, shares, F.lit(1000)).alias(n) for n in names]).collect()
    return {n: sorted({value for row in found for value in (row[n] or [])}) for n in names}


def learn_rules(
    rows: DataFrame,
    names: Sequence[str],
    steps: int = 24,
    max_literals: int = 4,
    max_rules: int = 24,
    min_precision: float = 0.95,
    min_covered: int = 5,
) -> list[Rule]:
    """An ordered list of rules for ``__bad`` = 1 from rows with double columns ``names``, ``__bad`` and ``__fold``.

    ``rows`` is read once per literal, and once per rule for its thresholds, and should be a written table. A rule is kept
    while its precision on the rows held back for pruning is at least ``min_precision``; covering stops at the first rule that isn't.
    """
    values = {n: F.col(n) for n in names}
    grow, prune = F.col("__fold") != 0, F.col("__fold") == 0
    bad, good = F.col("__bad") == 1, F.col("__bad") == 0
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.where(~decision(rules, values))
        # Thresholds come from the rows that no rule covers yet, so a rare kind of bad text gets its own once the common ones are covered.
        bounds = _bounds(left, names, steps)
        if not any(bounds.values()):
            break

        def bin_of(name: str, bounds=bounds) -> Column:
            value = F.col(name)
            return F.size(F.filter(F.array(*[F.lit(b) for b in bounds[name]]), lambda b: b <= value))

        bins = F.array(*[F.struct(F.lit(i).alias("f"), bin_of(n).alias("bin")) for i, n in enumerate(names) if bounds[n]])
        rule: Rule = ()
        while len(rule) < max_literals:
            inside = left.where(_holds(rule, values) & grow).select("__bad", F.inline(bins))
            counted = inside.groupBy("f", "bin").agg(F.count_if(bad).alias("p"), F.count_if(good).alias("n")).collect()
            literal = _best_literal(counted, names, bounds)
            if literal is None or literal in rule:
                break
            rule += (literal,)
        if not rule:
            break
        heads = [rule[: k + 1] for k in range(len(rule))]
        tested = left.agg(
            *[F.count_if(_holds(h, values) & side & fold).alias(f"{c}{k}")
              for k, h in enumerate(heads) for c, side, fold in (("p", bad, prune), ("n", good, prune))]
        ).first()

        def worth(k: int, tested=tested) -> tuple[float, int]:
            p, n = tested[f"p{k}"], tested[f"n{k}"]
            return (p - n) / (p + n) if p + n else -1.0, p

        best = max(range(len(heads)), key=worth)
        p, n = tested[f"p{best}"], tested[f"n{best}"]
        if p < min_covered or p < min_precision * (p + n):
            break
        rules.append(heads[best])
    return rules


def _best_literal(counted: list, names: Sequence[str], bounds: Mapping[str, list[float]]) -> Literal | None:
    """The literal of largest information gain, from the class counts of each feature's bins."""
    found, best_gain = None, 1e-9
    for i, name in enumerate(names):
        own = {row["bin"]: (row["p"], row["n"]) for row in counted if row["f"] == i}
        total_p, total_n = sum(p for p, _ in own.values()), sum(n for _, n in own.values())
        if not total_p or not total_n:
            continue
        prior, below_p, below_n = math.log2(total_p / (total_p + total_n)), 0, 0
        for k, bound in enumerate(bounds[name]):
            p, n = own.get(k, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for at_least, p, n in ((True, total_p - below_p, total_n - below_n), (False, below_p, below_n)):
                gain = p * (math.log2(p / (p + n)) - prior) if p else 0.0
                if gain > best_gain:
                    found, best_gain = Literal(name, at_least, bound), gain
    return found


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> tuple[DataFrame, list[Rule]]:
    """Counts, base verdict and learned verdict per row, and the rules.

    Returns the id, ``COUNTS``, ``base_failed`` and ``kept``. Null and empty texts have no words and so fail the base.
    Labels other than 0 and 1 are not used; of several labels for an id the lowest counts; without labels no
    rule is learned and the base decides alone. Repeated rows are judged, and returned, each for itself. Extra columns of
    either table are left behind.
    """
    bare = docs.select(F.col(id_col).alias("__id"), text_counts(F.col(text_col)).alias("__c"))
    counts = stage(bare.select("__id", F.col("__c.*")), "text-counts")
    row = {c: F.col(c) for c in COUNTS}
    values = features(row)
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg((1 - F.min(label_col)).alias("__bad"))
    )
    judged = counts.where(~base_failed(row)).select("__id", *[v.alias(n) for n, v in values.items()])
    labelled = judged.join(known, "__id").withColumn("__fold", F.pmod(F.xxhash64("__id"), F.lit(_FOLDS))).drop("__id")
    rules = learn_rules(stage(labelled, "labelled-counts"), list(values))
    failed = base_failed(row)
    result = counts.select(
        F.col("__id").alias(id_col),
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & ~decision(rules, values)).alias("kept"),
    )
    return result, rules
