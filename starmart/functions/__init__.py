"""Column expressions: built-in Spark functions only, no Python UDFs."""

from .keys import surrogate_key
from .labels import in_list, label_by_member, label_by_range, label_by_threshold, map_values
from .numeric import guarded_ratio, ratio_of_sums, round_stable, safe_corr, try_float, try_number, weighted_avg
from .text import null_tokens, title_case

__all__ = [
    "guarded_ratio",
    "in_list",
    "label_by_member",
    "label_by_range",
    "label_by_threshold",
    "map_values",
    "null_tokens",
    "ratio_of_sums",
    "round_stable",
    "safe_corr",
    "surrogate_key",
    "title_case",
    "try_float",
    "try_number",
    "weighted_avg",
]
