"""Zone dimension and the two role-playing left joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.functions.casts import safe_cast, trim_ws

ZONE_ROLES = ("pickup", "dropoff")


def build_zone_dim(lookup: DataFrame) -> DataFrame:
    """DISTINCT (location_id, trimmed borough, zone_name, service_zone), key not null.

    Deliberately not de-duplicated on the key alone: two spellings of one id
    stay two rows (checked by the ``zone_key_unique`` gate).
    """
    types = {f.name: f.dataType for f in lookup.schema.fields}
    return (
        lookup.where(F.col("LocationID").isNotNull())
        .select(
            safe_cast(F.col("LocationID"), types["LocationID"], "bigint").alias("location_id"),
            trim_ws(safe_cast(F.col("Borough"), types["Borough"], "string")).alias("borough"),
            trim_ws(safe_cast(F.col("Zone"), types["Zone"], "string")).alias("zone_name"),
            trim_ws(safe_cast(F.col("service_zone"), types["service_zone"], "string")).alias(
                "service_zone"
            ),
        )
        .distinct()
    )


def zone_role(zones: DataFrame, role: str) -> DataFrame:
    """Rename the dimension for one role so both joins have unambiguous names."""
    return zones.select(
        F.col("location_id").alias(f"_{role}_zone_key"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone_name").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def join_zone_role(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """LEFT JOIN trips to the zone dimension on ``{role}_location_id``.

    No hint: the engine broadcasts the dimension if its measured bytes are below the
    session's threshold, and else splits hot location ids in a skew join.
    """
    dim = zone_role(zones, role)
    key = f"_{role}_zone_key"
    return trips.join(dim, trips[f"{role}_location_id"] == dim[key], "left").drop(key)


def attach_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """J1 + J2: LEFT JOIN trips to zones on pickup and on dropoff location id."""
    out = trips
    for role in ZONE_ROLES:
        out = join_zone_role(out, zones, role)
    return out
