"""CSV landing files to typed raw tables.

Columns are matched by name, cells that mean "no value" become null, and a row that does not fit (wrong number of
fields, a number that does not parse, a missing key) is set aside with its reason instead of stopping the load.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import null_tokens, try_number
from ..functions.text import NULL_TOKENS
from ..sinks.store import Store

log = logging.getLogger(__name__)

_BROKEN, _UNREAD = "_broken", "_unread"
STATUS, REASON, RECORD, LOADED_AT = "load_status", "reject_reason", "reject_record", "loaded_at"
LOADED, REJECTED = "loaded", "rejected"


class MissingLanding(FileNotFoundError):
    """The landing folder itself is not there."""


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(``file``, ``line``): the first line of every file of ``path`` that is not empty, null for one that can't be read at all."""
    texts = spark.read.option("ignoreCorruptFiles", True).text(path).where("_metadata.file_block_start = 0")
    texts = texts.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
    # Two streaming passes instead of a sort of all texts, which the first of a text column would need.
    first = texts.groupBy("file").agg(F.min("at").alias("at"))
    lines = texts.join(first, ["file", "at"], "left_semi").select("file", F.col("value").alias("line"))
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    return files.join(lines, "file", "left")


def _layouts(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """Files of ``path`` by their header line."""
    by_line = _first_lines(spark, path).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {r["line"]: r["files"] for r in by_line.orderBy("line").collect()}


def read_landing(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """CSV files as text columns plus ``_broken``, the source line of a row with too few or too many fields.

    Each path is a file or a folder of files. Headers may differ from file to file: files of one header are read together and all are
    put together by name. A file that can't be read at all is one row, its name in ``_unread``; one that breaks off
    later stops the read. An empty file has no rows. Quoted fields may hold line breaks; a file is then read by one task, so keep files below
    about a gigabyte, or turn ``multi_line`` off when no field does, and large files are split.
    """
    frames, unread = [], []
    for path in [paths] if isinstance(paths, str) else paths:
        layouts = _layouts(spark, path)
        missing = layouts.pop(None, [])
        unread += missing
        for line, files in layouts.items():
            names = next(csv.reader([line.lstrip("\ufeff")]))
            schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _BROKEN]])
            frames.append(
                spark.read.schema(schema)
                .options(header=True, enforceSchema=False, quote='"', escape='"', multiLine=multi_line)
                .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, columnPruning=False)
                .csv(path if len(layouts) == 1 and not missing else files)
            )
    if not frames:
        raise ValueError(f"no header line in {paths}")
    if unread:
        frames.append(spark.createDataFrame([(file,) for file in unread], f"{_UNREAD} string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def match_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of ``schema`` found in ``df`` by name in any letter case; null where ``df`` has none."""
    present = {name.lower(): name for name in df.columns}
    found = []
    for field in schema:
        name = present.get(field.name.lower())
        cell = F.col(f"`{name}`") if name is not None else F.lit(None).cast("string")
        found.append(cell.alias(field.name))
    return found


def _number(cell: Column, to: T.DataType) -> Column:
    return try_number(cell, to.scale if isinstance(to, T.DecimalType) else 0).try_cast(to)


def coerce(df: DataFrame, schema: T.StructType, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Landing text to the types of ``schema``, with ``load_status``, ``reject_reason`` and ``reject_record``."""
    marks = [(F.col(m) if m in df.columns else F.lit(None).cast("string")).alias(m) for m in (_BROKEN, _UNREAD)]
    text = df.select(*match_columns(df, schema), *marks)
    text = text.select(*[null_tokens(F.col(f.name), tokens).alias(f.name) for f in schema], _BROKEN, _UNREAD)

    # One step per result that later ones use more than once, so that each cell is parsed once.
    numbers = {f.name: f"_number{i}" for i, f in enumerate(schema) if not isinstance(f.dataType, T.StringType)}
    parsed = text.withColumns({numbers[f.name]: _number(F.col(f.name), f.dataType) for f in schema if f.name in numbers})

    reasons = [
        F.when(F.col(_UNREAD).isNotNull(), F.lit("file without a header")),
        F.when(F.col(_BROKEN).isNotNull(), F.lit("wrong number of fields")),
    ]
    for field in schema:
        cell = F.col(field.name)
        if field.name in numbers:
            unparsed = cell.isNotNull() & F.col(numbers[field.name]).isNull()
            reasons.append(F.when(unparsed, F.lit(f"{field.name} is not a number")))
        if not field.nullable:
            reasons.append(F.when(cell.isNull(), F.lit(f"{field.name} is missing")))
    judged = parsed.withColumn(REASON, F.coalesce(*reasons))
    good = F.col(REASON).isNull()
    record = F.coalesce(F.col(_UNREAD), F.col(_BROKEN), F.to_json(F.struct(*schema.fieldNames())))
    return judged.select(
        *[F.col(numbers.get(name, name)).alias(name) for name in schema.fieldNames()],
        F.when(good, F.lit(LOADED)).otherwise(F.lit(REJECTED)).alias(STATUS),
        REASON,
        F.when(~good, record).alias(RECORD),
    )


@dataclass(frozen=True)
class Load:
    """What one load wrote: the raw table, the rows set aside, and the counts of both."""

    table: DataFrame
    rejects: DataFrame
    rows: int
    rejected: int


def load_table(landing: DataFrame, schema: T.StructType, store: Store, name: str, namespace: str = "raw") -> Load:
    """Replace a raw table by the landing rows.

    Good and bad rows are told apart in one pass and written to one table, ``<name>_load``, with their status and the
    time of the load; raw table and rejects are views of it, which skip the row groups that hold only rows of the other kind. The
    counts come with the write. So the files are read once and nothing is sorted or shuffled.
    """
    counts = Observation()
    status = F.col(STATUS)
    checked = coerce(landing, schema).withColumn(LOADED_AT, F.current_timestamp())
    checked = checked.observe(
        counts,
        F.count(F.when(status == LOADED, F.lit(1))).alias("rows"),
        F.count(F.when(status == REJECTED, F.lit(1))).alias("rejected"),
    )
    both = f"{name}_load"
    written = store.save(checked, namespace, both)
    columns, reject_columns = schema.fieldNames(), [RECORD, REASON]
    store.part_view(namespace, name, both, columns, f"{STATUS} = '{LOADED}'")
    store.part_view(namespace, f"{name}_rejects", both, reject_columns, f"{STATUS} = '{REJECTED}'")
    table = written.where(status == LOADED).select(*columns)
    rejects = written.where(status == REJECTED).select(*reject_columns)
    return Load(table, rejects, counts.get["rows"], counts.get["rejected"])


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side: one row with a column ``n_<name>`` for each."""
    counts = [df.agg(F.count(F.lit(1)).alias(f"n_{name}")) for name, df in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return stacked.agg(*[F.max(f"n_{name}").alias(f"n_{name}") for name in tables])


def load_extracts(
    spark: SparkSession, folder: str, extracts: Mapping[str, tuple[str, T.StructType]], store: Store
) -> dict[str, Load]:
    """Load every extract found in ``folder``: file or sub-folder name, plain or with ``.gz`` -> (table, schema).

    A missing folder is an error; a missing extract is logged and skipped.
    """
    if not _exists(spark, folder):
        raise MissingLanding(f"no landing folder at {folder}")
    loads = {}
    for file, (table, schema) in extracts.items():
        plain = f"{folder.rstrip('/')}/{file}"
        path = next((p for p in (plain, f"{plain}.gz") if _exists(spark, p)), None)
        if path is None:
            log.warning("skip %s: missing", file)
            continue
        loads[table] = load_table(read_landing(spark, path), schema, store, table)
        log.info("%s: %d rows, %d rejected", table, loads[table].rows, loads[table].rejected)
    return loads
