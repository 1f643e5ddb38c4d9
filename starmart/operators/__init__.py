"""Relational operators: DataFrames in, DataFrames out."""

from .asof import as_of
from .checks import (
    check_columns,
    check_freshness,
    check_grain,
    check_relationships,
    check_unique,
    dq_report,
    enforce,
)
from .differences import bag_difference, release_difference
from .distinct import distinct_in_windows, period_sketches, period_values, sketched_in_windows
from .history import change_points
from .intervals import overlapping_pairs
from .joins import attach_key
from .lattice import sum_lattice
from .leaders import leaders_per_group
from .quantiles import exact_ntile, exact_percentiles
from .ranks import rank_rows
from .sessions import sessions
from .snapshots import over_keys, over_time, periodic_snapshot, year_dimension
from .staged import cleanup, scratch_path, shared_dir, stage

__all__ = [
    "as_of",
    "attach_key",
    "bag_difference",
    "change_points",
    "check_columns",
    "check_freshness",
    "check_grain",
    "check_relationships",
    "check_unique",
    "cleanup",
    "distinct_in_windows",
    "dq_report",
    "enforce",
    "exact_ntile",
    "exact_percentiles",
    "leaders_per_group",
    "over_keys",
    "over_time",
    "overlapping_pairs",
    "period_sketches",
    "period_values",
    "periodic_snapshot",
    "rank_rows",
    "release_difference",
    "scratch_path",
    "sessions",
    "shared_dir",
    "sketched_in_windows",
    "stage",
    "sum_lattice",
    "year_dimension",
]
