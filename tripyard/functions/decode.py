"""Code -> label decoders as native CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripyard.schemas import TIME_PERIODS, UNKNOWN_LABEL


def decode(code: Column, labels: Mapping, default: str = UNKNOWN_LABEL) -> Column:
    """``CASE code WHEN k THEN v ... ELSE default END`` (NULL code -> default)."""
    expr = None
    for key, label in labels.items():
        expr = (F.when if expr is None else expr.when)(code == F.lit(key), F.lit(label))
    return expr.otherwise(F.lit(default))


def time_period(hour: Column) -> Column:
    """Searched CASE over hour ranges, first match wins (order preserved)."""
    expr = None
    for lo, hi, label in TIME_PERIODS:
        expr = (F.when if expr is None else expr.when)(hour.between(lo, hi), F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN_LABEL))
