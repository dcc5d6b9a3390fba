"""Stream message validation and de-duplication (T1-T10), as native expressions.

One pure function, :func:`validate_envelopes`, serves both ``spark.read``
(batch twin) and ``spark.readStream``; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripyard.functions.casts import text_to_utc_ntz
from tripyard.schemas import (
    DEDUP_ATTRIBUTE,
    ENVELOPE_SCHEMA,
    ERROR_TYPE,
    POSITIVE_FIELDS,
    REASON_BAD_JSON,
    REASON_BAD_TYPE_PREFIX,
    REASON_MISSING_PREFIX,
    REASON_NOT_POSITIVE,
    REJECTED_FIELDS,
    VALID_EVENT_SCHEMA,
    VALID_FIELDS,
)

# Strict JSON: the parser stops where its outermost value closes, so the text is
# wrapped twice.  Trailing text can close [...] or {"p":...} early, never both.
# Every field is read as text (any JSON value renders as its text), which
# keeps "absent or null" apart from "present but not coercible"; on
# duplicate keys the last one wins, as in Python's json module.
_JSON_WRAPPED_SCHEMA = "array<struct<" + ",".join(f"`{f}`:string" for f in VALID_FIELDS) + ">>"
_JSON_PROBE_SCHEMA = "p string"
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


_JSON_NUMBER = r"^\s*-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\s*$"


def decode_payload(data: Column) -> Column:
    """Bytes -> UTF-8 text, invalid sequences replaced by U+FFFD."""
    return F.make_valid_utf8(data)


def _typed(text: Column, dtype: T.DataType) -> Column:
    """Payload text value -> table type (NULL if not coercible)."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.TimestampNTZType):
        return text_to_utc_ntz(text)
    number = F.when(text.rlike(_JSON_NUMBER), text)  # not "5d" or "Infinity", which Spark's cast would take
    if isinstance(dtype, T.LongType):
        # 1.0 is an integer, 1.5 is not
        exact = number.try_cast("decimal(38,18)")
        return F.coalesce(number.try_cast(dtype), F.when(exact == F.floor(exact), exact.try_cast(dtype)))
    x = number.try_cast(dtype)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def _names_where(preds: list[tuple[str, Column]]) -> Column:
    """Array of the names whose predicate holds, in the given order."""
    return F.filter(F.array(*[F.when(p, F.lit(n)) for n, p in preds]), lambda x: x.isNotNull())


def validate_envelopes(envelopes: DataFrame) -> DataFrame:
    """Parse and validate each message; one row out per message in.

    Output: ``raw_payload, message_id, publish_time``, the 26 typed event
    fields and ``error_reason`` (NULL for a valid event), followed by any
    input columns beyond the envelope's (carried through unchanged).
    Reasons, first match wins: invalid JSON > missing/null fields (schema
    order) > non-positive distance/fare/total > (extension) values the table
    type cannot hold.
    """
    raw = decode_payload(F.col("data"))
    carried = [c for c in envelopes.columns if c not in ENVELOPE_SCHEMA.fieldNames()]
    staged = envelopes.select(
        *carried,
        raw.alias("raw_payload"),
        F.col("message_id"),
        F.col("publish_time"),
        F.from_json(F.concat(F.lit("["), raw, F.lit("]")), _JSON_WRAPPED_SCHEMA, _JSON_OPTIONS).alias(
            "_parsed"
        ),
        # only a text with a closing bracket can close [...] early
        F.when(~raw.contains("]"), F.lit(True))
        .otherwise(F.from_json(F.concat(F.lit('{"p":'), raw, F.lit("}")), _JSON_PROBE_SCHEMA, _JSON_OPTIONS)["p"].isNotNull())
        .alias("_whole"),
    )
    parsed = F.col("_parsed")
    json_ok = F.col("_whole") & parsed.isNotNull() & (F.size(parsed) == 1) & F.get(parsed, 0).isNotNull()
    # The parsed object leaves through a one-row ``inline`` (a Generate).  A
    # filter on the outcome cannot be pushed below a generator's output, so
    # the optimizer never copies the JSON parse into pushed-down predicates:
    # each message is parsed exactly once.
    staged = staged.select(
        *carried,
        "raw_payload",
        "message_id",
        "publish_time",
        F.inline(
            F.array(F.struct(json_ok.alias("_json_ok"), F.when(json_ok, F.get(parsed, 0)).alias("_m")))
        ),
    )
    # Each field is typed once, in a projection of its own.  The lambda in ``_names_where``
    # keeps that projection out of whole-stage code, whose single method for all 26 fields
    # is too long to be compiled at run time; as a projection it runs in short methods.
    m = F.col("_m")
    typed = [_typed(m[f.name], f.dataType).alias(f.name) for f in VALID_EVENT_SCHEMA.fields]
    missing = _names_where([(f, m[f].isNull()) for f in VALID_FIELDS])
    # Typed fields also leave through a one-row ``inline``: the reason below and
    # downstream filters (valid/rejected split, trip quality filters) then
    # compare plain attributes instead of having the per-field parsing
    # expressions substituted into every pushed-down predicate.
    staged = staged.select(
        *carried,
        "raw_payload",
        "message_id",
        "publish_time",
        F.struct("_json_ok", *typed, F.concat_ws(", ", missing).alias("_missing")).alias("_event"),
    ).select(*carried, "raw_payload", "message_id", "publish_time", F.inline(F.array("_event")))
    positive = None
    for f in POSITIVE_FIELDS:
        ok = F.coalesce((F.col(f) > 0) & ~F.isnan(f), F.lit(False))
        positive = ok if positive is None else positive & ok
    # a field that is there, but of which nothing is left as its type
    bad_type = F.concat_ws(", ", *[F.when(F.col(f).isNull(), F.lit(f)) for f in VALID_FIELDS])
    reason = (
        F.when(~F.col("_json_ok"), F.lit(REASON_BAD_JSON))
        .when(F.col("_missing") != "", F.concat(F.lit(REASON_MISSING_PREFIX), F.col("_missing")))
        .when(~positive, F.lit(REASON_NOT_POSITIVE))
        .when(bad_type != "", F.concat(F.lit(REASON_BAD_TYPE_PREFIX), bad_type))
    )
    return staged.select("raw_payload", "message_id", "publish_time", *VALID_FIELDS, reason.alias("error_reason"), *carried)


def valid_events(validated: DataFrame) -> DataFrame:
    """T7 main output: valid events in the 26-field table layout."""
    return validated.where(F.col("error_reason").isNull()).select(*VALID_FIELDS)


def rejected_events(validated: DataFrame) -> DataFrame:
    """T7 side output + T8: rejected-event envelope (9 fields)."""
    cols = {
        "error_type": F.lit(ERROR_TYPE),
        "pipeline_timestamp": F.current_timestamp(),
    }
    return validated.where(F.col("error_reason").isNotNull()).select(
        *[cols[c].alias(c) if c in cols else F.col(c) for c in REJECTED_FIELDS]
    )


def dedup_key() -> Column:
    return F.col("attributes")[DEDUP_ATTRIBUTE]


def message_key() -> Column:
    """T1's key, never null: the ``event_id`` attribute, or what tells messages without one apart
    (the broker's message id, the publish time and the payload: one delivered again is the same message)."""
    own = F.sha2(
        F.concat_ws("|", F.coalesce(F.col("message_id"), F.lit("")), F.col("publish_time").cast("string"), F.sha2(F.coalesce(F.col("data"), F.lit(b"")), 256)),
        256,
    )
    return F.when(dedup_key().isNotNull(), F.concat(F.lit("k:"), dedup_key())).otherwise(F.concat(F.lit("m:"), own))


def dedup_messages(messages: DataFrame, key: Column | None = None) -> DataFrame:
    """T1 (batch twin): one message per key, the earliest delivery.

    Earliest by publish_time, then message_id.  ``min_by`` is an aggregate with a
    map-side partial step, so a hot key is combined before the shuffle instead of
    landing whole in one task.
    Give a frame with the needed columns alone, and its key, and the de-dup moves nothing else.
    """
    key = message_key() if key is None else key
    first = F.min_by(F.struct(*messages.columns), F.struct("publish_time", "message_id"))
    return messages.withColumn("_group", key).groupBy("_group").agg(first.alias("_first")).select("_first.*")
