"""The registered queries of this package: (spark, sf_dir) -> DataFrame, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    bpe,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    resampling,
    secret_scan,
    token_counts,
    toxicity,
    vector_search,
    warc,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(work: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[work.__name__] = work
    return work


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE["op7_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(keeper) FILTER (doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id
"""


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("__spans")

    def number(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE))
    return scanned.select(
        "doc_id",
        *[number(kind) for kind in secret_scan.BASE],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(spans).alias("spans"),
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = packing.tokenized_pieces(docs, ranks, public_tokenizers.PATTERN, end_id=2, size=1024)
    packed = packing.pack(pieces, size=1024)
    return packed.withColumnsRenamed({"__sequence": "sequence_id", "__offset": "offset"})


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"), min_payload=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# A base32 digit is five bits; five hexadecimal digits make four of them.
ORACLE["op4_warc"] = r"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
told AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
         max(page_id) OVER (PARTITION BY h, payload_bytes) AS head
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM told
"""


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.fit_scorer(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("__id").alias("doc_id"),
        F.col("__held_out").alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = ngram_join.similar_groups(table(spark, sf_dir, "documents"), n=3, percent=90)
    return grouped.withColumnsRenamed({"__n_shingles": "n_shingles", "__component": "component_id"})


# Sets are compared where they share a shingle that few documents hold: linked sets share 90 % of the larger one, so they
# share one of the rarest tenth of each, and one more.
ORACLE["op9_ngram_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM worded
), grams AS MATERIALIZED (SELECT doc_id, len(s) AS size, unnest(s) AS gram FROM sets),
classes AS MATERIALIZED (
  SELECT h, size, min(doc_id) AS rep
  FROM (SELECT doc_id, size, sha256(string_agg(gram, chr(10) ORDER BY gram)) AS h FROM grams GROUP BY doc_id, size) GROUP BY h, size
), own AS MATERIALIZED (
  SELECT doc_id, size, gram, row_number() OVER (PARTITION BY doc_id ORDER BY n, gram) AS place
  FROM grams JOIN (SELECT gram, count(*) AS n FROM grams GROUP BY gram) USING (gram) WHERE doc_id IN (SELECT rep FROM classes)
), prefixes AS (SELECT * FROM own WHERE place <= size - (90 * size + 99) // 100 + 1),
asked AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.size AS sa, y.size AS sb
  FROM prefixes x JOIN prefixes y ON x.gram = y.gram AND x.doc_id < y.doc_id
  WHERE 100 * least(x.size, y.size) >= 90 * greatest(x.size, y.size)
), shared AS (
  SELECT a, b, sa, sb, count(*) AS n FROM asked JOIN own x ON x.doc_id = a JOIN own y ON y.doc_id = b AND y.gram = x.gram GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM shared WHERE 100 * n >= 90 * (sa + sb - n) UNION SELECT b, a FROM shared WHERE 100 * n >= 90 * (sa + sb - n)
), reached AS (
  SELECT rep AS id, rep AS first FROM classes
  UNION
  SELECT links.b, reached.first FROM reached JOIN links ON links.a = reached.id AND reached.first < links.b
), least_of AS (SELECT id, min(first) AS component_id FROM reached GROUP BY id),
hashed AS (SELECT doc_id, sha256(string_agg(gram, chr(10) ORDER BY gram)) AS h FROM grams GROUP BY doc_id)
SELECT sets.doc_id, len(s) AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN hashed USING (doc_id) LEFT JOIN classes USING (h) LEFT JOIN least_of ON least_of.id = classes.rep
"""


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decimal = F.array_join(F.col("__ids").cast("array<string>"), " ")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("__ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("__bytes", 256).alias("decoded_sha256"),
    )


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = resampling.resample(docs, target, percent=10, least_words=20, longest=1, buckets=10_000, seed=2024)
    return drawn.select(
        F.col("__id").alias("doc_id"),
        F.col("__n_features").alias("n_features"),
        F.col("__weight").alias("weight"),
        F.col("__score").alias("score"),
        F.col("__rank").alias("rank"),
    )


# The remainders of CRC-32 for each byte are made by eight steps of its polynomial; sums are taken of distinct words.
ORACLE["op13_importance_resampling"] = r"""
WITH RECURSIVE step AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
), remainders AS (SELECT list(c ORDER BY byte) AS t FROM step WHERE k = 8),
words AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), counted AS (SELECT side, id, word, count(*) AS n FROM words GROUP BY ALL),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counted)),
bucketed AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, remainders
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM counted JOIN bucketed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM sums) + 10000))::DOUBLE
                                 / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))::DOUBLE))::BIGINT AS gain FROM sums
), weights AS (
  SELECT id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM counted JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT
           + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents LEFT JOIN weights ON id = doc_id
), placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM placed
"""


@query
def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality weights: 2 for documents labelled good, 1/2 for those labelled bad, 1 for the others."""
    labels = table(spark, sf_dir, "labels")
    quality = labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("weight"))
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=[5, 2, 1], percent=150, epochs=2, seed=2024, quality=quality)
    return mixed.select(
        F.col("__id").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
    )


# Targets by one pass over the sources in order of cap per weight, not by rounds.
ORACLE["op11_source_mixing"] = r"""
WITH RECURSIVE good AS (
  SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE END) AS w FROM labels GROUP BY doc_id
), sized AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1114111)) AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((('0x' || substr(sha256('2024:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) / coalesce(w, 1.0::DOUBLE) AS key
  FROM documents LEFT JOIN good USING (doc_id)
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2 * source_size AS cap,
         sum(source_size) OVER () * 150 / 100.0::DOUBLE
           - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM sources
), capped AS (SELECT *, cap * weights <= rest * weight AS above FROM levels),
shared AS (
  SELECT source, source_size, CASE WHEN above THEN cap::DOUBLE ELSE (SELECT max_by(rest, weights) FROM capped WHERE NOT above) * weight
    / (SELECT max(weights) FROM capped WHERE NOT above)::DOUBLE END AS target
  FROM capped
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM shared
), summed AS (
  SELECT r, doc_id, size, source, source_size, target, epochs, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN budgets b USING (source)
), late AS (
  SELECT r, source, size, rest, upto - size AS before, row_number() OVER (PARTITION BY source ORDER BY upto) AS place
  FROM summed WHERE upto > rest AND size > 0 AND rest > 0
), tries AS (
  SELECT source, place, r, size <= rest - before AS fits, rest - before - CASE WHEN size <= rest - before THEN size ELSE 0 END AS gap
  FROM late WHERE place = 1
  UNION ALL
  SELECT l.source, l.place, l.r, l.size <= t.gap, t.gap - CASE WHEN l.size <= t.gap THEN l.size ELSE 0 END
  FROM tries t JOIN late l ON l.source = t.source AND l.place = t.place + 1 AND l.place <= 64
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN (upto <= rest AND rest > 0) OR coalesce(fits, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed LEFT JOIN (SELECT r, fits FROM tries WHERE fits) USING (r)
"""


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks, model = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align(docs, ranks, public_tokenizers.PATTERN, model)
    figures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return aligned.select(
        F.col("__id").alias("doc_id"),
        *[F.col(f"__{name}").alias(name) for name in figures],
        F.col("__groups").alias("groups_sha256"),
    )
