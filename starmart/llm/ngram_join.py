"""Exact Jaccard join on word n-grams, by vertical partitioning, and the groups that its links make.

Documents of one n-gram set are a class and only its representative, the smallest id, goes on. All n-grams have a global
order, rarest first. Two sets as similar as the threshold share an n-gram among the first few of each (the prefix filter), so
documents meet in lists of the n-grams of their prefixes. How alike two of them are is counted vertically: an order that all sets
share, that of the n-grams' hashes, is cut into FRAGMENTS fragments, each holds its part of every set, partial overlaps are counted
per fragment and summed per pair. Pairs are dealt into blocks whose number follows from the sizes of their sets; a cell, one block
in one fragment, holds only the sets that its pairs name. So the work grows with the pairs, not with pairs times fragments.

Pairs are never enumerated within a list. Rounds link each list's members to one of them, the list's leader, so a group of
thousands of near copies costs its size and not its square. What a round has linked is one component, and later rounds only compare members of different components,
until no list holds two components with an untested pair. A test is never left out unless it can't matter: both members are in
one component already, their sizes rule a link out, or distances to a common leader do (1 - Jaccard is a metric, so two sets are at
least as far apart as their distances to a third differ).

The order needs counts of all n-grams only roughly, as any order common to all documents gives the same links: counts are kept
for ORDER_SLOTS hashes of n-grams, a table of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.staged import stage

from .common import map_batches, partitions, slices, strings

# Slots of the table of approximate document frequencies: 4 bytes each, whatever the corpus.
ORDER_SLOTS = 1 << 20

# Fragments of the n-gram order, whatever the corpus.
FRAGMENTS = 8
# N-grams that one block of pairs holds in one fragment, on average: 16 MB.
FRAGMENT = 1 << 21
# Weight of the members of one block of a list: bytes of their bitmaps unpacked, half at least, and of the numbers of each.
CELL_BYTES = 1 << 22
MEMBER_BYTES = 512
# Candidate documents up to this many are sent to the texts; more are joined by Spark's own choice.
BROADCAST_IDS = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles, A-Z lower-cased; all words as one shingle where there are fewer."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    count = len(words) - n + 1
    mixed = hashes[:count]
    for k in range(1, n):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : count + k])
    mixed = np.sort(mixed)
    return mixed[np.append(True, mixed[1:] != mixed[:-1])]


def _digest(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


_SLOT_SHIFT = np.uint64(64 - (ORDER_SLOTS - 1).bit_length())
_CHUNK = ORDER_SLOTS >> 4


def _survey(docs: DataFrame, n: int) -> DataFrame:
    """One pass over all texts: size and digest of each set, and per task how many sets hold an n-gram of each slot."""

    def work(batches):
        counts = np.zeros(ORDER_SLOTS, np.int64)
        for batch in slices(batches):
            sets = [shingle_set(text, n) for text in strings(batch.column(1))]
            every = np.concatenate([*sets, np.zeros(0, np.uint64)])
            counts += np.bincount((every >> _SLOT_SHIFT).astype(np.int64), minlength=ORDER_SLOTS)
            rows, none = batch.num_rows, [None] * batch.num_rows
            arrays = [batch.column(0), pa.array(map(len, sets), pa.int64(), size=rows), pa.array(map(_digest, sets), pa.binary(), size=rows)]
            arrays += [pa.array(none, pa.int64()), pa.array(none, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        for i in range(0, ORDER_SLOTS, _CHUNK):
            data = [zstandard.compress(counts[i : i + _CHUNK].astype("<i8").tobytes(), 3)]
            arrays = [pa.array([None], id_type), pa.array([None], pa.int64()), pa.array([None], pa.binary())]
            arrays += [pa.array([i], pa.int64()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names, id_type = ["__id", "__size", "__set", "__chunk", "__counts"], pa.int64()
    return map_batches(docs, work, "__id long, __size long, __set binary, __chunk long, __counts binary")


def _frequencies(survey: DataFrame) -> np.ndarray:
    """The summed table; it has ORDER_SLOTS numbers whatever the corpus."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(zstandard.decompress(data), "<i8")
        for i, total in sums.items():
            yield pa.RecordBatch.from_pydict({"__chunk": [i], "__counts": [total.tobytes()]})

    parts = survey.where("__chunk IS NOT NULL").select("__chunk", "__counts").repartition("__chunk")
    table = np.zeros(ORDER_SLOTS, np.int64)
    for i, data in map_batches(parts, add, "__chunk long, __counts binary").collect():
        table[i : i + _CHUNK] = np.frombuffer(data, "<i8")
    return table


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity of the n-grams in each slot; a power of two of slots, the n-grams' number at least."""
    bits = max(6, (len(shingles) - 1).bit_length())
    slots = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    return (np.bincount(slots, minlength=1 << bits) & 1).astype(np.uint8)


def most_shared(x: np.ndarray, y: np.ndarray, sizes: int) -> int:
    """An upper bound of what two sets share, from their bitmaps and the sum of their sizes; the longer bitmap is folded."""
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[0::2] ^ x[1::2]
    return (sizes - int((x ^ y).sum())) // 2


def _prefixes(docs: DataFrame, nodes: DataFrame, frequencies: np.ndarray, n: int, percent: int) -> DataFrame:
    """(``id``, ``size``, ``prefix``, ``bits``) of each representative."""
    sent = docs.sparkSession.sparkContext.broadcast(np.minimum(frequencies, (1 << 24) - 1).astype(np.uint64) << np.uint64(40))

    def work(batches):
        table = sent.value
        for batch in slices(batches):
            digests, packed, bits = [], [], []
            for text in strings(batch.column(1)):
                own = shingle_set(text, n)
                digests.append(_digest(own))
                if not len(own):
                    packed.append(own.view(np.int64)), bits.append(b"")
                    continue
                length = len(own) - (percent * len(own) + 99) // 100 + 1
                order = table[(own >> _SLOT_SHIFT).astype(np.int64)] | (own >> np.uint64(24))
                # Equals of the last one belong to it too: a longer prefix loses nothing.
                packed.append(own[order <= np.partition(order, length - 1)[length - 1]].view(np.int64))
                bits.append(np.packbits(_bitmap(own)).tobytes())
            arrays = [batch.column(0), pa.array(digests, pa.binary()), pa.array(packed, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["__id", "__set", "prefix", "bits"])

    found = map_batches(docs, work, "__id long, __set binary, prefix array<long>, bits binary")
    own = found.join(nodes, ["__id", "__set"]).dropDuplicates(["__id", "__set"])
    return own.select(F.col("__id").alias("id"), F.col("__size").alias("size"), "prefix", "bits")


def _prefix_lists(own: DataFrame) -> DataFrame:
    """(``list``, ``id``, ``size``, ``grams``): representatives that share n-grams of their prefixes, two or more to a list.

    N-grams whose lists have the same members share one list; ``grams`` is how many they are. Members are told by their number
    and two hashes, begun before the shuffle, so no task holds a list; lists that these take for one are tested as one.
    """
    grams = own.select(F.explode("prefix").alias("gram"), "id", "size")
    parts = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"h{k}") for k in range(2)]
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), *parts).where("n > 1")
    # Written, so that both sides of the join are plain exchanges and Spark can split a long list's n-gram.
    lists = stage(held.select("gram", F.xxhash64("n", "h0", "h1").alias("list")), "gram-lists")
    return grams.join(lists, "gram").groupBy("list", "id", "size").agg(F.count(F.lit(1)).alias("grams"))


def _linkable(lists: DataFrame, percent: int) -> DataFrame:
    """(``list``, ``id``, ``size``, ``common``): members that may link with another of their list.

    ``common`` is the least size of a linked set, less one, plus the n-grams of the prefix that other prefixes hold. It bounds what
    a set y shares with a set x that is not larger, and says nothing of larger ones: where x's prefix ends later in the order, y's
    prefix has all it shares in x's prefix, and its other n-grams are not in x. Where x's ends first, the shared ones of x's prefix are in
    y's, and y's prefix is longer by no more n-grams than y is. Prefixes that equals of the last n-gram lengthen only share more.
    So a pair needs sizes that the threshold and the ``common`` of the larger one allow.
    """
    shared = lists.groupBy("id").agg(F.sum("grams").alias("shared"))
    common = F.least("size", F.floor((percent * F.col("size") + 99) / 100) - 1 + F.col("shared")).alias("common")
    rows = lists.join(shared, "id").select("list", "id", "size", common)

    rows = stage(rows, "list-members")

    def work(batches):
        left = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            keys = table.column(0).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            left = table.slice(last)
            yield from met(table.slice(0, last))
        if left is not None:
            yield from met(left)

    def met(table):
        """The smallest other size that a member may meet as the larger one, and whether a larger or equal one may meet it."""
        keys, sizes, members, common = (c.to_numpy() for c in table.columns)
        least = (percent * sizes + 99) // 100
        most = np.minimum(sizes, (100 + percent) * common // percent - sizes)
        lowest, under = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else []
        for s, e in zip(starts, [*starts[1:], len(keys)]):
            own, single = sizes[s:e], members[s:e] == 1
            low = np.searchsorted(own, least[s:e])
            # A single member of its size does not meet itself.
            lowest[s:e] = np.where((own[low] == own) & single, np.iinfo(np.int64).max, own[low])
            high = np.maximum(low, np.searchsorted(own, most[s:e], "right"))
            over = np.cumsum(np.bincount(low, minlength=e - s + 1) - np.bincount(high, minlength=e - s + 1))[: e - s]
            under[s:e] = over - (single & (most[s:e] >= own)) > 0
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, sizes, lowest, under)], names=["list", "size", "lowest", "under"])

    # A list has no more sizes than its largest text has n-grams, however many its members are.
    sizes = rows.groupBy("list", "size").agg(F.count(F.lit(1)).alias("members"), F.max("common").alias("common"))
    ordered = sizes.repartition("list").sortWithinPartitions("list", "size")
    bounds = map_batches(ordered, work, "list long, size long, lowest long, under boolean")
    larger = F.col("lowest") <= F.floor((100 + percent) * F.col("common") / percent) - F.col("size")
    return rows.join(bounds, ["list", "size"]).where(F.col("under") | larger).select("list", "id", "size", "common")


def _bounded(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``, ``sa``, ``sb``) with ``most``, an upper bound of what they share."""

    def work(batches):
        for batch in batches:
            most = []
            for sa, sb, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                x, y = (np.unpackbits(np.frombuffer(bits, np.uint8)) for bits in (x, y))
                most.append(most_shared(x, y, sa + sb))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(most, pa.int64())], names=["a", "b", "sa", "sb", "most"])

    for side in ("a", "b"):
        pairs = pairs.join(own.select(F.col("id").alias(side), F.col("bits").alias(f"x{side}")), side)
    return map_batches(pairs.select("a", "b", "sa", "sb", "xa", "xb"), work, "a long, b long, sa long, sb long, most long")


def _fragments(docs: DataFrame, nodes: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """Sets of the given representatives, cut at FRAGMENTS - 1 places of the n-gram hashes, an order that all documents share."""
    small = ids.count() <= BROADCAST_IDS
    wanted = nodes.join(F.broadcast(ids) if small else ids, F.col("__id") == F.col("id"), "left_semi").select(
        F.col("__id").alias("__node"), F.col("__set").alias("__want")
    )
    chosen = docs.join(F.broadcast(wanted) if small else wanted, F.col("__id") == F.col("__node"))
    fragments = FRAGMENTS

    def cut(batches):
        for batch in slices(batches):
            ids, parts, packed = [], [], []
            for node, text, want in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = shingle_set(text or "", n)
                if _digest(own) != want:
                    continue
                part = (((own >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)
                used, starts = np.unique(part, return_index=True)
                ids += [node] * len(used)
                parts += used.tolist()
                packed += [p.tobytes() for p in np.split(own, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["part", "a", "grams"])

    return map_batches(chosen.select("__node", "__text", "__want"), cut, "part long, a long, grams binary")


def _dealt(pairs: DataFrame, sets: DataFrame, blocks: int) -> DataFrame:
    """Rows of cells (``block``, ``part``): the sets that the block's pairs need first, then its pairs.

    A pair goes to one block. A set goes to the blocks that have a pair of it, so its copies are no more than its pairs, nor than
    the blocks; one that a third of all pairs name is one row in each block.
    """
    block = F.pmod(F.xxhash64("a", "b"), F.lit(blocks)).alias("block")
    none = F.lit(None).cast("binary").alias("grams")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(FRAGMENTS - 1).cast("long")))
    asked = pairs.select(block, every.alias("part"), "a", "b", none)
    if blocks == 1:
        sent = sets.withColumn("block", F.lit(0).cast("long"))
    else:
        named = pairs.select(block, F.explode(F.array("a", "b")).alias("a")).distinct()
        sent = sets.join(named, "a")
    return sent.select("block", "part", "a", F.lit(None).cast("long").alias("b"), "grams").union(asked)


def _overlaps(pairs: DataFrame, sets: DataFrame, blocks: int) -> DataFrame:
    """Pairs (``a``, ``b``, ``sa``, ``sb``) with ``n``, what they share: partial overlaps by fragment, summed."""
    rows = _dealt(pairs, sets, blocks).repartition(blocks * FRAGMENTS, "block", "part")
    rows = rows.sortWithinPartitions("block", "part", F.col("b").isNotNull())

    def count(batches):
        cell, held = None, {}
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for block, part, a, b, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, part) != cell:
                    cell, held = (block, part), {}
                if b is None:
                    held[a] = np.frombuffer(grams, np.uint64)
                elif a in held and b in held:
                    x, y = held[a], held[b]
                    if len(x) > len(y):
                        x, y = y, x
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    shared = int((y[at] == x).sum())
                    if shared:
                        out.append((a, b, shared))
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["a", "b", "n"])

    summed = map_batches(rows, count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return pairs.join(summed, ["a", "b"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``component``) of all ids in links (``a``, ``b``): the smallest id that links reach.

    Each round every id takes its smallest neighbour as parent, parents are followed to their roots, and links are contracted to the
    roots that they join; a round at least halves the components that still have links.
    """
    links, found = stage(links.where("a <> b").select("a", "b"), "links"), None
    while True:
        both = links.union(links.select("b", "a"))
        parent = stage(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "parents")
        while True:
            above = parent.select(F.col("a").alias("p"), F.col("p").alias("root"))
            jumped = stage(parent.join(above, "p").select("a", F.col("root").alias("p"), (F.col("root") < F.col("p")).alias("moved")), "parents")
            parent = jumped.select("a", "p")
            if not jumped.where("moved").head(1):
                break
        if found is None:
            found = parent.select(F.col("a").alias("id"), F.col("p").alias("component"))
        else:
            roots = parent.select(F.col("a").alias("component"), F.col("p").alias("root"))
            found = found.join(roots, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        found = stage(found, "components")
        for side in ("a", "b"):
            roots = parent.select(F.col("a").alias(side), F.col("p").alias("root"))
            links = links.join(roots, side).drop(side).withColumnRenamed("root", side)
        links = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if not links.head(1):
            return found


def _pair(leader: str, percent: int):
    """The pair of a leader and a member, smaller id first, and whether sizes and common n-grams allow a link."""
    small, large = F.least(f"{leader}.size", "size"), F.greatest(f"{leader}.size", "size")
    first = F.col(f"{leader}.id") < F.col("id")
    columns = [
        F.least(f"{leader}.id", "id").alias("a"),
        F.greatest(f"{leader}.id", "id").alias("b"),
        F.when(first, F.col(f"{leader}.size")).otherwise(F.col("size")).alias("sa"),
        F.when(first, F.col("size")).otherwise(F.col(f"{leader}.size")).alias("sb"),
    ]
    larger = F.when(F.col("size") > F.col(f"{leader}.size"), F.col("common")).when(F.col("size") < F.col(f"{leader}.size"), F.col(f"{leader}.common"))
    overlap = (100 + percent) * larger.otherwise(F.least(f"{leader}.common", "common")) >= percent * (small + large)
    return columns, (100 * small >= percent * large) & overlap


def _by_length(bits: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Bitmaps as matrices, one for each length, with the places of their rows."""
    places: dict[int, list[int]] = {}
    for i, data in enumerate(bits):
        places.setdefault(8 * len(data), []).append(i)
    unpack = lambda at: np.unpackbits(np.frombuffer(b"".join(bits[i] for i in at), np.uint8)).reshape(len(at), -1)
    return {length: (np.array(at), unpack(at)) for length, at in places.items()}


def _differing(one: np.ndarray, lengths: dict[int, tuple[np.ndarray, np.ndarray]], count: int) -> np.ndarray:
    """Bits that one bitmap and each other differ in, at the shorter one's length."""
    found = np.zeros(count, np.int64)
    for length, (at, others) in lengths.items():
        mine = one
        while len(mine) > length:
            mine = mine[0::2] ^ mine[1::2]
        while others.shape[1] > len(mine):
            others = others[:, 0::2] ^ others[:, 1::2]
        found[at] = (others ^ mine).sum(axis=1)
    return found


def _cells(members: DataFrame, own: DataFrame) -> DataFrame:
    """Members of each list dealt into blocks of bounded weight, and every block beside each block of members outside the list's
    largest component: rows of a cell (``list``, ``block``, ``other``), ``outside`` first.

    Two members of the largest component never meet. So a list costs its blocks times the blocks of its outsiders, each a cell of its own.
    """
    weight = F.sum(F.col("size") + MEMBER_BYTES)
    parts = members.groupBy("list", "c").agg(F.count(F.lit(1)).alias("n"), weight.alias("w"))
    largest = F.max(F.struct("n", "c", "w")).alias("largest")
    whole = parts.groupBy("list").agg(F.sum("w").alias("w"), largest)
    block = lambda w: (1 + F.floor(w / CELL_BYTES)).cast("int")
    whole = whole.select("list", F.col("largest.c").alias("main"), block(F.col("w")).alias("blocks"), block(F.col("w") - F.col("largest.w")).alias("others"))
    rows = members.join(stage(whole, "open-lists"), "list").join(own.select("id", "bits"), "id")
    facts = ["list", "id", "size", "common", "c", "low1", "high1", "low2", "high2", "bits", "main"]
    dealt = F.xxhash64("id", F.lit(7))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = rows.select(*facts, F.pmod(dealt, "blocks").cast("int").alias("block"), every("others").alias("other"), F.lit(False).alias("outside"))
    outer = rows.where("c <> main")
    outer = outer.select(*facts, every("blocks").alias("block"), F.pmod(dealt, "others").cast("int").alias("other"), F.lit(True).alias("outside"))
    cells = inner.union(outer).select("block", "other", "outside", *facts)
    return cells.repartition("list", "block", "other").sortWithinPartitions("list", "block", "other", "outside", "id")


def _rest_of_lists(percent: int):
    """Pairs of a cell that two leaders leave open and that pass every filter: component, size, distance, bitmap."""
    reach = 1 - percent / 100 + 1e-9

    def work(batches):
        cell, held = None, []
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in (3, 0, 1)]
            change = np.any([np.diff(k) != 0 for k in keys], axis=0)
            starts = [0, *(np.flatnonzero(change) + 1).tolist()] if batch.num_rows else []
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                now = tuple(int(k[s]) for k in keys)
                if now != cell:
                    yield from pairs(held)
                    cell, held = now, []
                held.append(batch.slice(s, e - s))
        yield from pairs(held)

    def pairs(held):
        if not held:
            return
        table = pa.Table.from_batches(held)
        outside = table.column(2).to_numpy()
        inner, outer = table.filter(pa.array(~outside)), table.filter(pa.array(outside))
        if not len(inner) or not len(outer):
            return
        ids, sizes, common, own, *bounds = (inner.column(i).to_numpy() for i in range(4, 12))
        lengths = _by_length([bytes(b) for b in inner.column(12).to_pylist()])
        main = inner.column(13).to_numpy()
        others = [outer.column(i).to_numpy() for i in range(4, 12)]
        for i, (id_, size, shared, c, low1, high1, low2, high2) in enumerate(zip(*others, strict=True)):
            both = sizes + size
            # Of two outsiders the one of the smaller id is the inner one.
            ok = (own != c) & ((own == main) | (ids < id_)) & (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size))
            larger = np.where(sizes > size, common, np.where(sizes < size, shared, np.minimum(common, shared)))
            ok &= (100 + percent) * larger >= percent * both
            for low, high, a, b in ((*bounds[:2], low1, high1), (*bounds[2:], low2, high2)):
                ok &= ~(low - b > reach) & ~(a - high > reach)
            if not ok.any():
                continue
            bits = np.unpackbits(np.frombuffer(outer.column(12)[i].as_py(), np.uint8))
            differ = _differing(bits, lengths, len(ids))
            ok &= (100 + percent) * ((both - differ) // 2) >= percent * both
            hits = np.flatnonzero(ok)
            if len(hits):
                swap = ids[hits] < id_
                columns = [np.where(swap, ids[hits], id_), np.where(swap, id_, ids[hits])]
                columns += [np.where(swap, sizes[hits], size), np.where(swap, size, sizes[hits])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "sa", "sb"])

    return work


def similar_groups(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``__n_shingles`` and ``__component`` (smallest id that links reach, itself included) of every row.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``n``-word shingles. A document of fewer
    words has one shingle, all its words; one without words, or null, has none and links with nothing. A row without an id
    comes back with no component and links with nothing. Rows of one id are one document: repeated rows come back each with
    the same component, and where their texts differ the set of least digest is the one that is compared. Extra columns are left behind.
    Ids are whole numbers.
    """
    bare = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    survey = stage(_survey(bare, n), "shingle-survey")
    info = survey.where("__chunk IS NULL").select("__id", "__size", "__set")
    known = info.where("__id IS NOT NULL AND __set IS NOT NULL")
    classes = known.groupBy("__set", "__size").agg(F.min("__id").alias("__id"))
    chosen = F.min(F.struct("__set", "__size")).alias("__c")
    classes = stage(classes, "shingle-classes")
    nodes = stage(classes.groupBy("__id").agg(chosen).select("__id", F.col("__c.__set"), F.col("__c.__size")), "nodes")

    own = stage(_prefixes(bare, nodes, _frequencies(survey), n, percent), "prefixes")
    lists = stage(_prefix_lists(own), "prefix-lists")
    joined = _linked(bare, nodes, own, stage(_linkable(lists, percent), "linkable"), n, percent)
    found = info.join(classes.select("__set", F.col("__id").alias("__rep")), "__set", "left")
    found = found.join(joined.select(F.col("id").alias("__rep"), "component"), "__rep", "left")
    return found.select(
        F.col("__id").alias(id_col),
        F.col("__size").alias("__n_shingles"),
        F.when(F.col("__id").isNotNull(), F.coalesce("component", "__rep", "__id")).alias("__component"),
    )


def one_of_each_group(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each group of linked texts: that of the smallest id.

    Each different text of an id is a document of its own, so none is lost with another of its id; of the texts that one id has in a
    group, the one of the smallest digest stays. Rows of equal id and text are one document and stay as one row. Rows without an id,
    and texts without words, all stay. An empty table gives an empty one.
    """
    known = docs.where(F.col(id_col).isNotNull()).withColumn("__sum", F.xxhash64(id_col, text_col))
    grouped = similar_groups(known.select("__sum", text_col), n, percent, "__sum", text_col)
    ids = known.select(F.col(id_col).alias("__first"), F.col("__sum").alias("__row")).distinct()
    both = ids.join(grouped.select("__sum", "__component").distinct(), F.col("__row") == F.col("__sum"))
    kept = both.groupBy("__component").agg(F.min(F.struct("__first", "__row"))["__row"].alias("__kept")).select("__kept")
    chosen = known.join(stage(kept, "kept-rows"), F.col("__sum") == F.col("__kept"), "left_semi").dropDuplicates(["__sum"])
    return chosen.select(docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def _linked(docs: DataFrame, nodes: DataFrame, own: DataFrame, lists: DataFrame, n: int, percent: int) -> DataFrame:
    """Components of the representatives that link with others."""
    reach = 1 - percent / 100 + 1e-9
    jaccard = F.col("n") / (F.col("sa") + F.col("sb") - F.col("n"))

    def tested(pairs: DataFrame) -> DataFrame:
        """Pairs with bounds of their distance (1 - Jaccard), equal where it was counted, and whether they link."""
        bounded = stage(_bounded(pairs, own), "bounded")
        passes = 100 * F.col("most") >= percent * (F.col("sa") + F.col("sb") - F.col("most"))
        asked = stage(bounded.where(passes).drop("most"), "asked")
        ids = stage(asked.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "asked-ids")
        # What all pairs name is at least what all cells hold, and it grows as the pairs do.
        total = asked.agg(F.sum(F.col("sa") + F.col("sb"))).first()[0] or 0
        blocks = 1 + total // (FRAGMENT * FRAGMENTS)
        exact = _overlaps(asked, _fragments(docs, nodes, ids, n), blocks)
        link = 100 * F.col("n") >= percent * (F.col("sa") + F.col("sb") - F.col("n"))
        counted = exact.select("a", "b", (1 - jaccard).alias("low"), (1 - jaccard).alias("high"), link.alias("link"))
        least = 1 - F.col("most") / (F.col("sa") + F.col("sb") - F.col("most"))
        refused = bounded.where(~passes).select("a", "b", least.alias("low"), F.lit(1.0).alias("high"), F.lit(False).alias("link"))
        return stage(counted.union(refused), "tested")

    def linking(tests: DataFrame) -> DataFrame:
        return tests.where("link").select("a", "b")

    def with_distance(members: DataFrame, tests: DataFrame, leader: str, tag: str) -> DataFrame:
        """Bounds of a member's distance to a leader of its list, null where it was not tested."""
        told = tests.select("a", "b", "low", "high")
        keyed = members.withColumns({"a": F.least(f"{leader}.id", "id"), "b": F.greatest(f"{leader}.id", "id")})
        itself = F.when(F.col("a") == F.col("b"), F.lit(0.0))
        bounds = {f"{side}{tag}": itself.otherwise(F.col(side)) for side in ("low", "high")}
        return keyed.join(told, ["a", "b"], "left").withColumns(bounds).drop("a", "b", "low", "high")

    def labelled(members: DataFrame, links: DataFrame) -> DataFrame:
        found = members.drop("c").join(components(links), "id", "left")
        return found.withColumn("c", F.coalesce("component", "id")).drop("component")

    def open_lists(members: DataFrame, leaders: DataFrame) -> DataFrame:
        """Members of lists of two or more components, and their leaders: one join by list, whose long lists Spark can split."""
        span = members.groupBy("list").agg(F.min("c").alias("least"), F.max("c").alias("most"))
        return members.join(stage(span.where("least < most").select("list").join(leaders, "list"), "open-lists"), "list")

    # Leaders are members with few n-grams of their own: near the middle of a group of near copies, so they link with most of it.
    alone = (F.col("size") - F.col("common")).alias("alone")
    first = stage(lists.groupBy("list").agg(F.min(F.struct(alone, "id", "size", "common")).alias("l1")), "leaders")
    columns, possible = _pair("l1", percent)
    pairs = stage(lists.join(first, "list").where(possible & (F.col("l1.id") != F.col("id"))).select(*columns).distinct(), "pairs")
    tests1 = tested(pairs)
    links = linking(tests1)
    found = stage(labelled(lists, links), "labelled")
    members = stage(with_distance(open_lists(found, first), tests1, "l1", "1"), "members")

    # The second leader is one outside the first leader's component, which is looked up by the leader: minima by list start in each task.
    led = stage(members.where(F.col("id") == F.col("l1.id")).select(F.col("id").alias("head"), F.col("c").alias("c1")).distinct(), "led")
    facts = F.struct(alone, "id", "size", "common", "c", "low1", "high1")
    outside = members.join(led, F.col("l1.id") == F.col("head")).where("c <> c1")
    second = stage(outside.groupBy("list").agg(F.min(facts).alias("l2")), "leaders")
    columns, possible = _pair("l2", percent)
    apart = (F.col("low1") - F.col("l2.high1") > reach) | (F.col("l2.low1") - F.col("high1") > reach)
    asked = members.join(second, "list").where(possible & (F.col("c") != F.col("l2.c")) & ~F.coalesce(apart, F.lit(False)))
    tests2 = tested(stage(asked.select(*columns).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs"))
    links = links.union(linking(tests2))

    again = open_lists(stage(labelled(members, links), "labelled"), second)
    again = with_distance(again, tests1.union(tests2), "l2", "2")
    again = stage(again.select("list", "id", "size", "common", "c", "low1", "high1", "low2", "high2"), "open-members")
    rest = map_batches(_cells(again, own), _rest_of_lists(percent), "a long, b long, sa long, sb long").distinct()
    done = pairs.select("a", "b").union(tests2.select("a", "b"))
    tests3 = tested(stage(rest.join(done, ["a", "b"], "left_anti"), "pairs"))
    return components(links.union(linking(tests3)))
