"""Safe (null-on-failure) casts and whitespace trimming.

Casts are chosen from the *input* type at plan-build time, so the plan holds
one native expression per column and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters with the Unicode property White_Space, removed by TRIM.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_ZONED_TEXT = r"(?i)(z|utc|gmt|[+-][0-9]{2}:?[0-9]{2})\s*$"


def round_half_away(x: Column) -> Column:
    """Round a DOUBLE to the nearest BIGINT, halves away from zero.

    Exact (``x - floor(x)`` is exact in binary floating point) and cheap:
    Spark's ``round()`` on doubles goes through a BigDecimal per row.  NaN,
    infinities and values outside the BIGINT range [-2**63, 2**63) give NULL.
    """
    down, up = F.floor(x), F.ceil(x)
    return (
        F.when(F.isnan(x) | (x >= F.lit(2.0**63)) | (x < F.lit(-(2.0**63))), F.lit(None).cast("bigint"))
        .when(x >= 0, F.when(x - down >= 0.5, down + 1).otherwise(down))
        .otherwise(F.when(up - x >= 0.5, up - 1).otherwise(up))
    )


def utc_ntz_from_epoch_seconds(seconds: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ holding the UTC wall clock (no session zone)."""
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH_NTZ))


def _ltz_to_utc_ntz(ts: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH_NTZ))


def text_to_utc_ntz(text: Column) -> Column:
    """Parse '2026-06-01 10:00:00 UTC' (or zone-less / offset text) to UTC wall clock.

    Zone-less text is taken as UTC, as the warehouse does; text with an explicit
    zone or offset is converted to UTC.  Unparseable text gives NULL.
    """
    return (
        # the usual '... UTC' form is already the UTC wall clock: drop the suffix
        F.when(text.endswith(" UTC"), text.substr(F.lit(1), F.length(text) - 4).try_cast("timestamp_ntz"))
        .when(text.rlike(_ZONED_TEXT), _ltz_to_utc_ntz(text.try_cast("timestamp")))
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def safe_cast(col: Column, source: T.DataType, target: str) -> Column:
    """SAFE_CAST(col AS target) for a column whose current type is ``source``.

    * integers from fractional numbers round half away from zero first (the
      warehouse rounds, Spark's cast would truncate);
    * timestamps are TIMESTAMP_NTZ holding UTC wall-clock time;
    * any failure gives NULL.
    """
    if target == "bigint":
        if isinstance(source, (T.FloatType, T.DoubleType)):
            return round_half_away(col.cast("double"))
        if isinstance(source, T.DecimalType):
            return F.round(col).try_cast("bigint")
        if isinstance(source, T.BooleanType):
            return col.cast("bigint")
        return col.try_cast("bigint")
    if target == "double":
        return col.try_cast("double")
    if target == "timestamp":
        if isinstance(source, T.TimestampNTZType):
            return col
        if isinstance(source, T.TimestampType):
            return _ltz_to_utc_ntz(col)
        if isinstance(source, T.DateType):
            return col.cast("timestamp_ntz")
        if isinstance(source, T.StringType):
            return text_to_utc_ntz(col)
        return F.lit(None).cast("timestamp_ntz")
    if target == "string":
        return col.cast("string")
    raise ValueError(f"unsupported safe cast target: {target}")


def trim_ws(col: Column) -> Column:
    """TRIM of all leading/trailing whitespace, including tab and NBSP."""
    return F.btrim(col, F.lit(WHITESPACE))
