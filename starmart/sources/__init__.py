"""Reading: landing files, JSON documents and declared source tables."""

from .declared import DECLARED, source
from .documents import latest_distribution, read_catalog, read_pages, require_rows, resolve_latest_csv
from .landing import Load, MissingLanding, coerce, load_audit, load_extracts, load_table, match_columns, read_landing
from .releases import ReleaseLoad, ReleaseTable
from .schemas import INPATIENT_CHARGES, READMISSIONS

__all__ = [
    "ReleaseLoad",
    "ReleaseTable",
    "DECLARED",
    "INPATIENT_CHARGES",
    "Load",
    "READMISSIONS",
    "MissingLanding",
    "coerce",
    "latest_distribution",
    "load_audit",
    "load_extracts",
    "load_table",
    "match_columns",
    "read_catalog",
    "read_landing",
    "read_pages",
    "require_rows",
    "resolve_latest_csv",
    "source",
]
