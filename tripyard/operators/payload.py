"""Event payload builder (publisher side, as column expressions).

T11 encodes an event as JSON bytes with its id as message attribute, T12 is the
fare arithmetic the publisher uses for ``total_amount`` and T13 the every-Nth
fault injection.  They are used to build replayable envelope files from a
table, not as a timed simulator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.schemas import VALID_FIELDS

TOTAL_COMPONENTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
)


def encode_event(df: DataFrame, explicit_nulls: bool = True) -> Column:
    """The 26 event fields of ``df`` as one JSON object text.

    ``explicit_nulls=True`` writes ``"field":null``; False drops null fields
    (key absent).  Cast the result to binary for an envelope's ``data``.
    """
    return F.to_json(
        F.struct(*[F.col(f) for f in VALID_FIELDS if f in df.columns]),
        {"ignoreNullFields": "false" if explicit_nulls else "true"},
    )


def trip_total(*components: Column) -> Column:
    """total = fare + extra + tax + tip + tolls + improvement + congestion + CBD, 2 dp.

    Summed as DECIMAL at full scale and rounded once.
    """
    cols = components or tuple(F.col(c) for c in TOTAL_COMPONENTS)
    total = None
    for c in cols:
        d = c.cast("decimal(23,8)")
        total = d if total is None else total + d
    return F.round(total, 2).cast("double")


def every_nth(seq: Column, n: int, offset: int, faulty: Column, normal: Column) -> Column:
    """``faulty`` when ``seq mod n == offset`` (n <= 0 disables), else ``normal``."""
    if n <= 0:
        return normal
    return F.when(F.pmod(seq, F.lit(n)) == offset % n, faulty).otherwise(normal)
