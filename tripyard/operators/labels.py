"""Silver attributes: code decoders and pickup-time attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.functions.decode import decode, time_period
from tripyard.functions.timeattrs import day_name, is_weekend
from tripyard.schemas import (
    DEFAULT_PAYMENT_TYPE,
    DEFAULT_RATE_CODE,
    PAYMENT_TYPE_NAMES,
    RATE_CODE_NAMES,
    SILVER_COLUMNS,
    STORE_AND_FWD_NAMES,
    TRIP_TYPE_NAMES,
    VENDOR_NAMES,
)


def silver_projection(trips: DataFrame) -> DataFrame:
    """Project zone-enriched clean trips to the 40-column silver layout.

    The rate-code and payment-type *names* decode the raw code, while the
    output code is coalesced (99 / 5): a NULL code keeps the name 'Unknown'.
    """
    pickup = F.col("pickup_datetime")
    hour = F.hour(pickup).cast("bigint")
    derived = {
        "vendor_name": decode(F.col("vendor_id"), VENDOR_NAMES),
        "pickup_date": F.to_date(pickup),
        "pickup_day_name": day_name(pickup),
        "is_weekend": is_weekend(pickup),
        "pickup_hour": hour,
        "time_period": time_period(hour),
        "store_and_fwd_name": decode(F.col("store_and_fwd_flag"), STORE_AND_FWD_NAMES),
        "rate_code_id": F.coalesce(F.col("rate_code_id"), F.lit(DEFAULT_RATE_CODE).cast("bigint")),
        "rate_code_name": decode(F.col("rate_code_id"), RATE_CODE_NAMES),
        "payment_type": F.coalesce(
            F.col("payment_type"), F.lit(DEFAULT_PAYMENT_TYPE).cast("bigint")
        ),
        "payment_type_name": decode(F.col("payment_type"), PAYMENT_TYPE_NAMES),
        "trip_name": decode(F.col("trip_type"), TRIP_TYPE_NAMES),
    }
    return trips.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in SILVER_COLUMNS]
    )
