"""Mixing sources to target weights by weighted sampling without replacement.

Sources share a budget of words by weight; none gets more than a given number of epochs of its own words, and what it cannot take is
shared again among the others. A document's key is an exponential number, made from its id, divided by its quality weight (Efraimidis and
Spirakis): taking documents by rising key is a weighted draw without replacement. Each source first takes all its documents
as often as whole epochs fit its target; what is left of the target is filled by key order.

Documents are sorted by (source, key) over ranges of the whole table and summed within each range, so a source that holds a third of all
rows spans many tasks; the sums of the ranges before, the target and the source's size then come to a row by (range, source). The
first document that no longer fits, and some after it, are tried once more in order, which closes the gap that a long one
leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.ranks import rank_rows
from starmart.operators.staged import stage

from .common import SPACE_CLASS, map_batches

# Documents after the first that does not fit which are tried, for each source.
TRIED = 64
# Rows that one range should hold at least, and at most.
LEAST_RANGE, RANGE = 10_000, 5_000_000


def n_words(text: Column) -> Column:
    """Words are runs of other characters than white space; counted without a list of them."""
    marks = F.regexp_replace(text, f"[{SPACE_CLASS}]*+[^{SPACE_CLASS}]++[{SPACE_CLASS}]*+", "w")
    return F.when(text.rlike(f"[^{SPACE_CLASS}]"), F.char_length(marks)).otherwise(0).cast("long")


def exponential_key(id_column: Column, weight: Column, seed: int) -> Column:
    """``-ln(u) / weight`` with u from the first 52 bits of the SHA-256 of the seed and the id (null: no text).

    A null weight counts as 1; one that is not above 0 and finite puts the row behind all others.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")
    draw = -F.log((head + F.lit(0.5)) / F.lit(float(1 << 52)))
    weight = F.coalesce(weight.cast("double"), F.lit(1.0))
    usable = (weight > 0) & (weight < float("inf"))
    return F.when(usable, draw / F.when(usable, weight)).otherwise(float("inf"))


def source_targets(sizes: DataFrame, weights: Sequence[int], percent: int, epochs: int) -> DataFrame:
    """``__target`` of each row (``__none``, ``__source``, ``__source_size``) of ``sizes``.

    Sources in order, null last, take ``weights`` in turn. ``percent`` of all words is shared by weight; a source whose share is above
    ``epochs`` times its size gets that, and the excess is shared again, until none is above. Each round is one aggregate; the
    sources are never in one place.
    """
    order = [F.asc("__none"), F.asc("__source")]
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_position") % len(weights) + 1).cast("int"))
    cap = (F.col("__source_size") * epochs).alias("__cap")
    placed = rank_rows(sizes, order).select("__none", "__source", "__source_size", cap, turn.cast("long").alias("__turn"))
    known = stage(placed, "mixing-sources")
    budget = (known.agg(F.sum("__source_size")).first()[0] or 0) * percent / 100
    # The level is words per unit of weight; it only rises, so a source that was above once stays at its cap.
    level, capped = -1.0, -1
    while True:
        above = F.col("__cap") <= level * F.col("__turn")
        taken, left, number = known.agg(
            F.sum(F.when(above, F.col("__cap"))), F.sum(F.when(~above, F.col("__turn"))), F.count_if(above)
        ).first()
        if number == capped or not left:
            break
        level, capped = (budget - (taken or 0)) / left, number
    shared = F.lit(budget - (taken or 0)) * F.col("__turn") / F.lit(float(left or 1))
    target = F.when(above, F.col("__cap").cast("double")).otherwise(shared)
    return known.select("__none", "__source", "__source_size", target.alias("__target"))


def _running_sums(narrow: DataFrame, rows: int) -> DataFrame:
    """Rows sorted by (source, key) over ranges, with ``__range`` and ``__within``, the sum of a source's sizes up to each row there."""
    order = [F.asc("__none"), F.asc("__source"), F.asc("__key"), F.asc_nulls_last("__id"), F.asc("__size")]
    session = int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(min(session, rows // LEAST_RANGE), rows // RANGE, 1)
    at = [narrow.columns.index(c) for c in ("__none", "__source", "__size")]

    def work(batches):
        from pyspark import TaskContext

        number, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            none, source, size = (batch.column(i) for i in at)
            # Sources are runs of rows: a new one begins where a row differs from the one before.
            source, none = source.to_numpy(zero_copy_only=False), none.to_numpy(zero_copy_only=False)
            begins = np.flatnonzero((source[1:] != source[:-1]) | (none[1:] != none[:-1])) + 1
            sums = np.cumsum(size.to_numpy())
            if last != (none[0], source[0]):
                total = 0
            before = np.zeros(batch.num_rows, np.int64)
            before[begins] = sums[begins - 1]
            before = np.maximum.accumulate(before)
            carried = np.where(np.arange(batch.num_rows) < (begins[0] if len(begins) else batch.num_rows), total, 0)
            within = sums - before + carried
            last, total = (none[-1], source[-1]), int(within[-1])
            extra = [pa.array(np.full(batch.num_rows, number), pa.int32()), pa.array(within)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "__range", "__within"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema)
    ordered = narrow.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return stage(map_batches(ordered, work, f"{schema}, __range int, __within long"), "mixing-ranges")


def _fitting(late: DataFrame) -> DataFrame:
    """``__chosen``, the rows that still fit the gap of their source, tried one by one in order."""
    in_order = F.array_sort(F.collect_list(F.struct("__before", "__size", "__row")))
    tries = late.groupBy("__none", "__source").agg(F.first("__rest").alias("__rest"), in_order.alias("__tries"))
    # The gap begins where the first of them would have been put.
    gap = F.col("__rest") - F.col("__tries")[0]["__before"]
    start = F.struct(gap.alias("gap"), F.array().cast("array<bigint>").alias("rows"))

    def put(state, one):
        fits = one["__size"] <= state["gap"]
        return F.struct(
            F.when(fits, state["gap"] - one["__size"]).otherwise(state["gap"]).alias("gap"),
            F.when(fits, F.concat(state["rows"], F.array(one["__row"]))).otherwise(state["rows"]).alias("rows"),
        )

    chosen = F.aggregate("__tries", start, put)
    return tries.select(F.explode(chosen["rows"]).alias("__chosen"))


def mix(
    docs: DataFrame,
    weights: Sequence[int],
    percent: int,
    epochs: int = 2,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: DataFrame | None = None,
    tried: int = TRIED,
) -> DataFrame:
    """``__id``, ``__size`` (words), ``__source_size``, ``__target`` and ``__taken`` of every row of ``docs``.

    ``__taken`` is the row's size times how often the mix takes it: as many whole epochs as its source's target holds, and once more if
    the draw chooses it. A source's taken words are at most its target; they fall short of it by less than the size of each
    document that was tried and not taken. ``quality`` holds the weights of rows by id, in ``id_col`` and ``weight``; the largest
    counts where an id has several, and rows without one weigh 1.

    Null and empty texts have size 0 and are never counted. A null source is a source of its own, the last one. Repeated rows are drawn
    each; equal ids share their key, and equal keys go by id, then size. Very long texts are counted without being cut. An empty
    table gives an empty one, sources without words the target 0. Extra columns are left behind.
    """
    sized = docs.select(
        F.col(id_col).alias("__id"),
        F.col(source_col).isNull().alias("__none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("__source"),
        F.coalesce(n_words(F.col(text_col)), F.lit(0)).cast("long").alias("__size"),
    )
    weight = F.lit(1.0)
    if quality is not None:
        known = quality.groupBy(F.col(id_col).alias("__of")).agg(F.max("weight").alias("__weight"))
        sized, weight = sized.join(known, F.col("__id") == F.col("__of"), "left"), F.col("__weight")
    keyed = sized.withColumn("__key", exponential_key(F.col("__id"), weight, seed))
    keyed = keyed.select("__id", "__none", "__source", "__size", "__key")
    # Written once: the range sort samples its input before it moves it, and rows get a number that stays.
    narrow = stage(keyed.withColumn("__row", F.monotonically_increasing_id()), "mixing-sizes")
    sizes = stage(narrow.groupBy("__none", "__source").agg(F.sum("__size").alias("__source_size")), "mixing-source-sizes")
    targets = source_targets(sizes, weights, percent, epochs)
    summed = _running_sums(narrow, narrow.count())

    # One row per range and source: a few more than there are ranges or sources.
    earlier = Window.partitionBy("__none", "__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summed.groupBy("__none", "__source", "__range").agg(F.sum("__size").alias("__sum"))
    offsets = offsets.withColumn("__offset", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    whole = F.floor(F.col("__target") / F.nullif(F.col("__source_size"), F.lit(0)))
    offsets = offsets.join(targets, ["__none", "__source"])
    offsets = offsets.withColumn("__epochs", F.coalesce(whole, F.lit(0)).cast("long"))
    offsets = offsets.withColumn("__rest", F.col("__target") - F.col("__epochs") * F.col("__source_size"))
    placed = summed.join(stage(offsets, "mixing-offsets"), ["__none", "__source", "__range"])
    placed = placed.withColumn("__before", F.col("__offset") + F.col("__within") - F.col("__size"))
    fits = F.col("__before") + F.col("__size") <= F.col("__rest")

    # Of each source only the first documents that do not fit; Spark cuts them in each task before they move.
    late = placed.where(~fits & (F.col("__size") > 0) & (F.col("__rest") > 0))
    place = F.row_number().over(Window.partitionBy("__none", "__source").orderBy("__before"))
    late = late.select("__none", "__source", "__before", "__size", "__row", "__rest").withColumn("__place", place)
    chosen = stage(_fitting(late.where(F.col("__place") <= tried)), "mixing-chosen")

    taken = placed.join(chosen, F.col("__row") == F.col("__chosen"), "left")
    once = F.when((fits & (F.col("__rest") > 0)) | F.col("__chosen").isNotNull(), 1).otherwise(0)
    return taken.select(
        "__id", "__size", "__source_size", "__target", (F.col("__size") * (F.col("__epochs") + once)).alias("__taken")
    )
