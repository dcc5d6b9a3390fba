"""Column-expression helpers: every function returns a native Spark Column."""

from tripyard.functions.casts import safe_cast, text_to_utc_ntz, trim_ws, utc_ntz_from_epoch_seconds
from tripyard.functions.decode import decode, time_period
from tripyard.functions.money import (
    money_sum,
    round2_mean,
    round2_ratio,
    round2_sum,
    share_pct,
)
from tripyard.functions.timeattrs import day_name, is_weekend, minutes_between, seconds_between

__all__ = [
    "day_name",
    "decode",
    "is_weekend",
    "minutes_between",
    "money_sum",
    "round2_mean",
    "round2_ratio",
    "round2_sum",
    "safe_cast",
    "seconds_between",
    "share_pct",
    "text_to_utc_ntz",
    "time_period",
    "trim_ws",
    "utc_ntz_from_epoch_seconds",
]
