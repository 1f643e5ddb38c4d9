"""JSON documents: a dataset catalog and saved pages of an API answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG = "dataset array<struct<title: string, distribution: array<struct<mediaType: string, downloadURL: string>>>>"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog document: one row per dataset, with its place in the document."""
    documents = spark.read.schema(CATALOG).option("multiLine", True).json(path)
    return documents.select(F.posexplode("dataset").alias("place", "entry")).select("place", "entry.*")


def latest_distribution(catalog: DataFrame, needle: str) -> DataFrame:
    """Newest dataset whose title holds ``needle`` and its first CSV link: title, year, url; no row without a match.

    The year is the last four of all digits of the title (0 when there are fewer); the first dataset wins a tie.
    A link counts as CSV by media type or by its ending. The url is null when the newest dataset has no CSV.
    """
    digits = F.regexp_replace("title", "[^0-9]", "")
    year = F.when(F.length(digits) >= 4, F.right(digits, F.lit(4)).cast("int")).otherwise(F.lit(0))
    csv_links = F.filter(
        "distribution",
        lambda d: (F.coalesce(d["mediaType"], F.lit("")) == "text/csv")
        | F.lower(F.coalesce(d["downloadURL"], F.lit(""))).endswith(".csv"),
    )
    return (
        catalog.where(F.col("title").contains(needle))
        .withColumn("year", year)
        .orderBy(F.desc("year"), "place")
        .limit(1)
        .select("title", "year", F.try_element_at(csv_links, F.lit(1))["downloadURL"].alias("url"))
    )


def resolve_latest_csv(spark: SparkSession, path: str, needle: str) -> str:
    """URL of the newest matching CSV in a catalog document; raises ``LookupError`` when there is none."""
    found = latest_distribution(read_catalog(spark, path), needle).first()
    if found is None:
        raise LookupError(f"no dataset titled like {needle!r} in the catalog")
    if found["url"] is None:
        raise LookupError(f"dataset {found['title']!r} has no CSV distribution")
    return found["url"]


def read_pages(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Saved API pages as one table: the ``results`` array of every page file in ``path``, one row per record.

    The fixed schema gives null for a key that a record lacks and leaves out keys it does not name. With
    ``multi_line`` each file is one document; without it each line is, and large files can be split.
    """
    page = T.StructType([T.StructField("results", T.ArrayType(schema))])
    pages = spark.read.schema(page).option("multiLine", multi_line).json(path)
    return pages.select(F.inline("results"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself, or ``LookupError`` when it is empty."""
    if df.isEmpty():
        raise LookupError(f"{what} returned no rows")
    return df
