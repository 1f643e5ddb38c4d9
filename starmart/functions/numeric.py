"""Tolerant casts, guarded division and weighted statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal notation with an optional exponent. Spark's own casts also take forms such as '1.0d' or
# 'Infinity'; those count as unparsable here.
_NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _number_text(cell: Column) -> Column:
    return F.when(cell.rlike(_NUMBER_TEXT), F.trim(cell))


def try_number(cell: Column, scale: int = 0) -> Column:
    """Text to a whole number (``bigint``, halves rounded up) or, with ``scale``, to ``decimal(38, scale)``.

    Unparsable text gives null instead of an error.
    """
    number = _number_text(cell).try_cast(f"decimal(38,{scale})")
    return number.try_cast("bigint") if scale == 0 else number


def try_float(cell: Column) -> Column:
    """Text to double; unparsable text, 'NaN' and 'Infinity' give null."""
    return _number_text(cell).try_cast("double")


def round_stable(value: Column, digits: int) -> Column:
    """A double rounded half up, as double.

    The order in which rows are summed changes the last bits of a double and could flip a plain ``round`` near a
    half. Ten decimals are kept before the rounding, so such noise is gone and every run gives the same figure. A value too
    large for that, or not finite, is rounded as it is. ``digits`` is at most 10.
    """
    if digits > 10:
        raise ValueError("round_stable keeps ten decimals")
    return F.coalesce(F.round(value.try_cast("decimal(38,10)"), digits).cast("double"), F.round(value.cast("double"), digits))


def guarded_ratio(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """``top / bottom``, null where ``bottom`` is zero, rounded when ``digits`` is given."""
    ratio = top / F.nullif(bottom, F.lit(0))
    return ratio if digits is None else F.round(ratio, digits)


def ratio_of_sums(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """Aggregate ``sum(top) / sum(bottom)``.

    Both sums stay exact in their own type; only the division is done in double, because a quotient of two
    wide decimals would lose digits to Spark's 38-digit limit.
    """
    ratio = guarded_ratio(F.sum(top).cast("double"), F.sum(bottom).cast("double"))
    return ratio if digits is None else round_stable(ratio, digits)


def weighted_avg(value: Column, weight: Column, digits: int | None = None) -> Column:
    """Aggregate ``sum(value * weight) / sum(weight)`` over rows where both are known."""
    known = F.when(value.isNotNull(), weight)
    return ratio_of_sums(value * weight, known, digits)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation that is null, not an error, when either side does not vary.

    Pairs with a null on either side are left out.
    """
    x_paired = F.when(y.isNotNull(), x)
    y_paired = F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x_paired) * F.stddev_pop(y_paired)
    return F.covar_pop(x_paired, y_paired) / F.nullif(spread, F.lit(0.0))
