"""Event rules and rate helpers as Column expressions (JVM side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The canonical event categories and progression statuses.
SUPPORTED_CATEGORIES = (
    "user",
    "session_end",
    "business",
    "progression",
    "resource",
    "design",
    "error",
    "ad",
    "impression",
)
PROGRESSION_STATUSES = ("start", "fail", "complete")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_category(c: str | Column) -> Column:
    """``lower(trim(category))``."""
    return F.lower(F.trim(_col(c)))


def is_supported_category(c: str | Column) -> Column:
    """Case-insensitive membership in the supported set; null is not supported."""
    return F.coalesce(F.lower(_col(c)).isin(*SUPPORTED_CATEGORIES), F.lit(False))


def is_valid_progression_status(c: str | Column) -> Column:
    """Case-insensitive membership in start/fail/complete; null is not valid."""
    return F.coalesce(F.lower(_col(c)).isin(*PROGRESSION_STATUSES), F.lit(False))


def safe_rate(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` as double when the denominator is positive, else 0.0."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(0.0))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    """``round(100.0 * n / d, 2)``, 0.0 when ``d`` is 0; ``round`` takes a tie away from zero."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d != 0, F.round(F.lit(100.0) * n / d, 2)).otherwise(F.lit(0.0))
