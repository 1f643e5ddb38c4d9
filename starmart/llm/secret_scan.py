"""Secrets in texts: three plain kinds, and weak parts of credentials that count only beside their complements.

Plain kinds (``assign``, ``access``, ``hex``) are always reported. Weak parts are account names (``login``), mixed-case keys
without a keyword (``key``) and addresses of services (``endpoint``): each alone is ordinary text. They are linked
within a scope, a stretch of SCOPE code points of one document to either side:

* a ``key`` counts if an access identifier or an account name starts in its scope;
* a ``login`` counts if a secret (assign, hex or key) starts in its scope;
* an ``endpoint`` counts if both an identifier and a secret start in its scope.

The link is an interval join of parts with parts, written as a range frame over the starts within a document, so that no
pair of parts is ever built and a document of many parts costs no more than its parts. All of it is Spark
expressions: Spark finds matches but not their places, so these come from the lengths of what lies between the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Patterns of the plain kinds, with the least length of the group that is measured.
_VALUE = r"[A-Za-z0-9+/_.=-]+"
KINDS: dict[str, tuple[str, int, int]] = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?(""" + _VALUE + ")", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
    "login": (r"""(?i:user_?name|user|login|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 1, 3),
    "key": (r"[A-Za-z0-9+/_=-]+", 0, 20),
    "endpoint": (r"""(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x20\x09-\x0D"'<>]+""", 0, 10),
}
BASE = ("assign", "access", "hex")
# Quick tests that any kept match passes, so that most texts are neither split nor searched for every run of letters.
_HINTS = {"hex": r"[0-9a-f]{32}", "key": r"[A-Za-z0-9+/_=-]{20}", "access": r"AKIA[A-Z0-9]{12}"}
SCOPE = 256

_NUMBER = {kind: i for i, kind in enumerate(KINDS)}


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, index, length before, own length, kept) of all matches of one kind, leftmost and disjoint."""
    pattern, group, least = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    measured = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), group)
    lengths = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("before"),
        whole.alias("whole"),
        measured.alias("measured"),
    )

    def part(m: Column, i: Column) -> Column:
        kept = F.char_length(m["measured"]) >= least
        if kind == "key":
            for needed in ("[a-z]", "[A-Z]", "[0-9]"):
                kept &= m["whole"].rlike(needed)
        return _part(kind, i, F.char_length(m["before"]), F.char_length(m["whole"]), kept)

    return F.when(text.rlike(_HINTS.get(kind, pattern)), F.transform(lengths, part)).otherwise(_no_parts())


def _part(kind: str | None, i: Column, before: Column, own: Column, kept: Column) -> Column:
    return F.struct(
        F.lit(-1 if kind is None else _NUMBER[kind]).alias("k"),
        i.cast("int").alias("i"),
        before.cast("long").alias("before"),
        own.cast("long").alias("own"),
        kept.alias("kept"),
    )


def _no_parts() -> Column:
    return F.array().cast("array<struct<k:int,i:int,before:bigint,own:bigint,kept:boolean>>")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """The id and ``__spans``, an array of (start, kind number, kind, end) sorted by start, then kind as in ``KINDS``.

    Starts and ends are code points, ends exclusive. Spans of different kinds may overlap, except that a weak ``key`` is
    dropped where it overlaps a plain span. Null and empty texts have none. Every row comes back, repeated
    ids and rows too; the rows are told apart by a number given where they are read. Extra columns are left behind.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    header = F.array(_part(None, F.lit(0), F.lit(0), F.lit(0), F.lit(False)))
    # The number comes before the parts are unfolded: one per text, not one per part.
    numbered = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), text.alias("__t"))
    found = F.concat(header, *[_matches(F.col("__t"), kind) for kind in KINDS])
    parts = numbered.select("__row", "__id", F.inline(found))
    in_kind = Window.partitionBy("__row", "k").orderBy("i")
    upto = F.sum(F.col("before") + F.col("own")).over(in_kind.rowsBetween(Window.unboundedPreceding, 0))
    # One shuffle, by row; its windows and the last aggregate all use that.
    placed = (
        parts.repartition("__row")
        .withColumn("end", upto)
        .where(F.col("kept") | (F.col("k") < 0))
        .withColumn("start", F.when(F.col("k") >= 0, F.col("end") - F.col("own")))
    )

    in_row = Window.partitionBy("__row").orderBy("start")
    k = F.col("k")

    def is_kind(*kinds: str) -> Column:
        return k.isin([_NUMBER[kind] for kind in kinds])

    # Where plain spans reach that begin before, and where the next one begins.
    plain = is_kind(*BASE)
    reach = F.max(F.when(plain, F.col("end"))).over(in_row.rangeBetween(Window.unboundedPreceding, 0))
    # The rows at or after a start are those up to it in falling order.
    onward = Window.partitionBy("__row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    following = F.min(F.when(plain, F.col("start"))).over(onward)
    free = F.coalesce(reach <= F.col("start"), F.lit(True)) & F.coalesce(following >= F.col("end"), F.lit(True))
    told = placed.withColumn("__free", free).where(~is_kind("key") | F.col("__free"))

    def beside(*kinds: str) -> Column:
        """Whether a part of these kinds ends or begins within the scope of this one, however long either is."""
        ends = F.max(F.when(is_kind(*kinds), F.col("end"))).over(in_row.rangeBetween(Window.unboundedPreceding, 0))
        begins = F.min(F.when(is_kind(*kinds), F.col("start"))).over(onward)
        near = F.coalesce(ends >= F.col("start") - scope, F.lit(False))
        return near | F.coalesce(begins <= F.col("end") + scope, F.lit(False))

    identifier, secret = F.col("__identifier"), F.col("__secret")
    linked = told.withColumns({"__identifier": beside("access", "login"), "__secret": beside("assign", "hex", "key")})
    reported = (
        plain
        | (is_kind("key") & identifier)
        | (is_kind("login") & secret)
        | (is_kind("endpoint") & identifier & secret)
    )
    names = F.array(*[F.lit(kind) for kind in KINDS])
    span = F.struct(F.col("start"), k, F.get(names, k).alias("kind"), F.col("end"))
    return linked.groupBy("__row").agg(
        F.first("__id").alias(id_col), F.sort_array(F.collect_list(F.when(reported, span))).alias("__spans")
    ).drop("__row")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each reported stretch of text replaced by ``mask``; overlapping spans are one stretch.

    Spans depend on the text alone, so texts meet their spans by id and hash of the text; only rows with spans are joined.
    Null texts stay null. All columns of ``docs`` come back.
    """
    marked = docs.select(F.struct(id_col, F.xxhash64(text_col)).alias("__key"), F.col(text_col).alias("__text"))
    found = scan_secrets(marked, "__key", "__text").where(F.size("__spans") > 0)
    found = found.groupBy("__key").agg(F.first("__spans").alias("__spans"))
    by_id = found.select(F.col(f"__key.{id_col}").alias("__id"), F.col("__key.col2").alias("__hash"), "__spans")
    joined = docs.join(
        by_id, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__hash")), "left"
    )
    text = F.col(text_col)

    def cut(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["last"]
        between = F.substring(text, (done["last"] + 1).cast("int"), (span["start"] - done["last"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(done["out"], between, F.lit(mask))).otherwise(done["out"]).alias("out"),
            F.greatest(done["last"], span["end"]).alias("last"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("last"))
    rest = F.aggregate(
        "__spans",
        start,
        cut,
        lambda d: F.concat(d["out"], F.substring(text, (d["last"] + 1).cast("int"), F.char_length(text))),
    )
    clean = F.when(F.col("__spans").isNull(), text).otherwise(rest)
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
