"""Code-to-label expressions driven by plain Python lookups.

The argument appears once per branch: when it is costly (a parsed number), make it a column first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_match(cases: Iterable[tuple[Column, object]], default: Column) -> Column:
    """``CASE WHEN`` over ``(condition, label)`` pairs; a null condition does not match."""
    chain = reduce(lambda expr, case: expr.when(case[0], F.lit(case[1])), cases, F)
    return default if chain is F else chain.otherwise(default)


def map_values(code: Column, labels: Mapping[str, str]) -> Column:
    """Replace known codes by their label (exact, case-sensitive); others, and null, stay as they are."""
    return _first_match(((code == known, label) for known, label in labels.items()), code)


def label_by_range(number: Column, ranges: Sequence[tuple[float, float, str]], default: str) -> Column:
    """Label of the inclusive ``(low, high, label)`` range that holds the number; gaps and null get ``default``."""
    return _first_match(((number.between(low, high), label) for low, high, label in ranges), F.lit(default))


def label_by_threshold(number: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first ``(upper limit, label)`` step not exceeded; beyond the last, and null, get ``default``."""
    return _first_match(((number <= limit, label) for limit, label in steps), F.lit(default))


def label_by_member(code: Column, members: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of the list that holds the code; codes in no list, and null, get ``default``."""
    return _first_match(((code.isin(*codes), label) for label, codes in members.items()), F.lit(default))


def in_list(code: Column, codes: Sequence[str]) -> Column:
    """True or false, never null: whether the code is listed."""
    return F.coalesce(code.isin(*codes), F.lit(False))
