"""Raw tables to star, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import dq_report, enforce, stage
from ..sinks import Store, namespace_for, save_result, write_landing
from ..sources import INPATIENT_CHARGES, READMISSIONS, Load, load_extracts, read_pages, require_rows, source
from . import dims, facts, questions, staging
from .quality import star_checks, strict_checks

# Landing file (or folder of files) -> raw table and its schema.
EXTRACTS = {
    "inpatient_charges.csv": ("inpatient_charges", INPATIENT_CHARGES),
    "hrrp_readmissions.csv": ("hrrp_readmissions", READMISSIONS),
}


def _save_all(
    store: Store,
    models: Mapping[str, DataFrame],
    namespace: str,
    cluster_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Write independent models at the same time, so that small ones do not wait for each other."""
    clusters = cluster_by or {}
    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        saved = {
            name: pool.submit(store.save, df, namespace, name, cluster_by=clusters.get(name, ()))
            for name, df in models.items()
        }
        return {name: done.result() for name, done in saved.items()}


def build_star(
    raw_charges: DataFrame,
    raw_readmissions: DataFrame,
    store: Store,
    namespace: str | None = "marts",
    cluster_charges: bool = False,
) -> dict[str, DataFrame]:
    """Build and write the three dimensions, then the two facts; returns readers of the five tables by name.

    Staging stays lazy: each model scans only the raw columns it needs. Only the distinct hospital rows, read by two
    dimensions, are written. ``cluster_charges`` sorts the charges fact by diagnosis group over its files, at the price
    of one shuffle: worth it when most questions are about single groups, which then read only their files.
    """
    target = namespace_for(namespace, "marts")
    charges = store.view(staging.stg_inpatient_charges(raw_charges), "stg", "inpatient_charges")
    readmissions = store.view(staging.stg_readmissions(raw_readmissions), "stg", "readmissions")
    hospitals = stage(staging.stg_hospitals(raw_charges), "hospitals")
    star = _save_all(
        store,
        {
            "dim_provider": dims.dim_provider(hospitals),
            "dim_drg": dims.dim_drg(charges),
            "dim_geography": dims.dim_geography(hospitals),
        },
        target,
    )
    provider, drg, geography = star["dim_provider"], star["dim_drg"], star["dim_geography"]
    star |= _save_all(
        store,
        {
            "fact_inpatient_charges": facts.fact_inpatient_charges(charges, provider, drg, geography, own_dims=True),
            "fact_readmissions": facts.fact_readmissions(readmissions, provider, geography),
        },
        target,
        {"fact_inpatient_charges": ["drg_code", "ccn"]} if cluster_charges else None,
    )
    return star


def land_pages(spark: SparkSession, pages: str, schema: StructType, folder: str) -> None:
    """Turn the saved pages of an API answer into a CSV landing folder; an answer without rows is an error."""
    write_landing(require_rows(read_pages(spark, pages, schema), pages), folder)


@dataclass(frozen=True)
class Run:
    """The star, the loads by raw table with their counts, the report of the checks (written) and its totals."""

    star: dict[str, DataFrame]
    loads: dict[str, Load]
    report: DataFrame
    totals: dict[str, int]


def run(spark: SparkSession, landing: str, store: Store) -> dict[str, DataFrame]:
    """Load the landing folder, build the star and enforce its checks."""
    return run_reported(spark, landing, store).star


def run_reported(spark: SparkSession, landing: str, store: Store) -> Run:
    """The same with counts and report. The 19 checks stop the run when they fail; the strict ones only warn."""
    loads = load_extracts(spark, landing, EXTRACTS, store)
    tables = [table for table, _ in EXTRACTS.values()]
    missing = [table for table in tables if table not in loads]
    if missing:
        raise FileNotFoundError(f"cannot build the star without {', '.join(missing)}")
    raw = [source(spark, "raw", table) if store.catalog else loads[table].table for table in tables]
    star = build_star(*raw, store)
    report = stage(dq_report(star_checks(star), strict_checks(star)), "checks")
    return Run(star, loads, report, enforce(report))


def answer(star: Mapping[str, DataFrame], name: str | None = None) -> dict[str, DataFrame] | DataFrame:
    """The answers to all questions by name, or one of them alone, without the jobs of the others.

    Each is a handful of rows, but for the leaders.
    """
    charges, readmissions = star["fact_inpatient_charges"], star["fact_readmissions"]
    hospitals = cache(lambda: questions.provider_cost_quality(charges, readmissions))
    markup = cache(lambda: questions.markup_by_service_line(charges, star["dim_drg"]))
    quintiles = cache(lambda: questions.cost_vs_quality(hospitals()))
    answers = {
        "price_variation": lambda: questions.price_variation(charges, star["dim_drg"], star["dim_provider"]),
        "markup_by_service_line": markup,
        "markup_by_state": lambda: questions.markup_by_state(charges, star["dim_geography"]),
        "cost_vs_quality": quintiles,
        "cost_quality_corr": lambda: questions.cost_quality_corr(hospitals()),
        "headline_metrics": lambda: questions.headline_metrics(
            questions.explained_variance(hospitals()), quintiles(), markup()
        ),
        "charge_leaders": lambda: questions.charge_leaders(charges),
    }
    return {key: work() for key, work in answers.items()} if name is None else answers[name]()


def save_answers(star: Mapping[str, DataFrame], folder: str) -> None:
    """Snapshot every answer as one file under ``folder``."""
    for name, df in answer(star).items():
        save_result(df, folder, name)
