"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(num: str | Column, den: str | Column, dp: int = 4) -> Column:
    """``num / den`` rounded half up; NULL, not an error, on a zero denominator."""
    return F.round(F.try_divide(_col(num), _col(den)), dp)


def safe_share(num: Column, den: Column, dp: int = 4) -> Column:
    """Like :func:`rate`, but 0 on a zero denominator."""
    return F.coalesce(rate(num, den, dp), F.lit(0.0))


def log_feature(value: str | Column, dp: int = 4) -> Column:
    return F.round(F.log1p(_col(value)), dp)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
