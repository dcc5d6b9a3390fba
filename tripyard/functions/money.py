"""Exact money arithmetic: sums in whole numbers, rounded only at the end.

Sums of doubles depend on the order of their rows.  Here an amount is taken as whole units
and millionths of a unit (rounded to them, should it have more decimals), both added up as
BIGINT, so a sum costs about as much as the built-in one and does not depend on
partitioning.  Amounts that are no such numbers (infinite, NaN, a trillion units or more)
are added up as DOUBLE beside them.  Rounding is half away from zero, exact up to totals
of nine trillion units and in double arithmetic on the exact total beyond.

Every measure is SQL text over a column name, so that DataFrame aggregations and stored
views are made of the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts from here on are added up as DOUBLE.
_WILD = "1e12"
#: Totals up to here fit a BIGINT of millionths.
_EXACT_TOTAL = 9_000_000_000_000


def _whole(x: str) -> str:
    return f"SUM(CASE WHEN ABS(CAST({x} AS DOUBLE)) < {_WILD} THEN FLOOR(CAST({x} AS DOUBLE)) END)"


def _millionths(x: str) -> str:
    d = f"CAST({x} AS DOUBLE)"
    return f"SUM(CASE WHEN ABS({d}) < {_WILD} THEN FLOOR(({d} - FLOOR({d})) * 1e6 + 0.5D) END)"


def _wild(x: str) -> str:
    d = f"CAST({x} AS DOUBLE)"
    return f"SUM(CASE WHEN NOT ABS({d}) < {_WILD} THEN {d} END)"


def _as_double(x: str) -> str:
    return f"(COALESCE({_whole(x)}, 0) + COALESCE({_millionths(x)}, 0) / 1e6 + COALESCE({_wild(x)}, 0D))"


def _exact(x: str) -> str:
    return f"({_wild(x)} IS NULL AND ABS({_whole(x)}) < {_EXACT_TOTAL})"


def _total(x: str) -> str:
    return f"({_whole(x)} * 1000000 + {_millionths(x)})"


def _half_away(number: str, unit: str) -> str:
    """round(number / unit), halves away from zero, for BIGINT."""
    size = f"ABS({number})"
    return f"SIGN({number}) * ({size} DIV ({unit}) + CASE WHEN 2 * ({size} % ({unit})) >= ({unit}) THEN 1 ELSE 0 END)"


def _rounded(x: str, count: str) -> str:
    """ROUND(SUM(x) / count, 2); NULL without a count or an amount."""
    return (
        f"CASE WHEN {count} = 0 OR COUNT({x}) = 0 THEN NULL "
        f"WHEN {_exact(x)} THEN {_half_away(_total(x), f'10000 * {count}')} / 100D "
        f"ELSE ROUND({_as_double(x)} / {count}, 2) END"
    )


def money_sum_sql(x: str) -> str:
    """SUM, unrounded, as DOUBLE."""
    return f"CASE WHEN COUNT({x}) = 0 THEN NULL WHEN {_exact(x)} THEN {_total(x)} / 1e6 ELSE {_as_double(x)} END"


def round2_sum_sql(x: str) -> str:
    """ROUND(SUM(x), 2)."""
    return _rounded(x, "1")


def round2_mean_sql(x: str) -> str:
    """ROUND(AVG(x), 2)."""
    return _rounded(x, f"COUNT({x})")


def round2_ratio_sql(x: str, count: str) -> str:
    """ROUND(SUM(x) / SUM(count), 2) for an amount and a BIGINT count."""
    return _rounded(x, f"SUM({count})")


def money_sum(x: str) -> Column:
    return F.expr(money_sum_sql(x))


def round2_sum(x: str) -> Column:
    return F.expr(round2_sum_sql(x))


def round2_mean(x: str) -> Column:
    return F.expr(round2_mean_sql(x))


def round2_ratio(x: str, count: str) -> Column:
    return F.expr(round2_ratio_sql(x, count))


def share_pct(part: Column, whole: Column) -> Column:
    """ROUND(part / whole * 100, 2) for BIGINT part and whole, neither negative."""
    scaled, n = part.cast("decimal(20,0)") * F.lit(10000).cast("decimal(5,0)"), whole.cast("decimal(20,0)")
    up = F.when(scaled % n * 2 >= n, 1).otherwise(0)
    return F.when(whole > 0, (F.call_function("div", scaled, n) + up) / F.lit(100))
