"""Scalar expressions of the data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import WEEKDAYS


def iso_weekday(day: Column | str) -> Column:
    """1 is Monday, 7 is Sunday."""
    return (F.weekday(day) + 1).cast("int")


def weekday_label(number: Column | str) -> Column:
    """Label of a weekday number, null outside 1 to 7."""
    return F.try_element_at(F.array(*[F.lit(x) for x in WEEKDAYS]), F.col(number) if isinstance(number, str) else number)


def month_code(day: Column | str) -> Column:
    """yyyymm."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def month_index(day: Column | str) -> Column:
    """Months since year zero."""
    return (F.year(day) * 12 + F.month(day)).cast("int")


def or_default(column: str, default: str) -> Column:
    """``default`` for null and the empty string; blanks stay."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


def to_scale(value: Column, log_scale: bool, floor: float) -> Column:
    """Detection scale: log10 of the value, kept away from zero, or the value itself."""
    return F.log10(F.greatest(value, F.lit(floor))) if log_scale else value


def from_scale(value: Column, log_scale: bool) -> Column:
    """Back to original units."""
    return F.pow(F.lit(10.0), value) if log_scale else value


#: Fixed value: makes the median absolute deviation comparable with a standard deviation.
MAD_SCALE = 0.6745


def robust_score(value: str, middle: str, mad: str) -> Column:
    """Modified z-score of column ``value``: 0 where half of all values are the median itself."""
    return F.coalesce((F.col(value) - F.col(middle)) * MAD_SCALE / F.nullif(F.col(mad), F.lit(0.0)), F.lit(0.0))


def pinned(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once per row.

    Adjacent projections are merged, and an expression that is then referred to
    within a lambda would be evaluated anew for each element.  A generator of one
    row stands between them, over which nothing is merged.
    """
    return frame.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
