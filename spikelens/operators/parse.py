"""Raw log rows to typed events with a reject reason. Column expressions only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.functions import idempotency_key, is_blank
from spikelens.functions.timestamps import epoch_seconds, time_pieces, trim_time
from spikelens.session import configure

# Fixed limit: the largest size that fits the audit table's DECIMAL(10,2).
MAX_VALUE = 99999999.99

# Fixed field names of the JSON payload.
FIELDS = ["user_id", "event_type", "value", "timestamp", "trace_id"]
PLAIN_FIELDS = [name for name in FIELDS if name != "timestamp"]

# Fixed reject reasons, in the order they are tested.
EMPTY = "empty"
MALFORMED = "malformed"
NO_USER = "missing user_id"
NO_TYPE = "missing event_type"
OUT_OF_RANGE = "out of range"

EVENT_COLUMNS = ["user_id", "event_type", "value", "timestamp", "trace_id"]


def _exact_names(payload: Column) -> Column:
    """Field names match without regard to case; bring odd spellings to the exact one."""
    names = "|".join(FIELDS)
    odd = rf'"(?!(?:{names})")(?i:{names})"\s*:'
    renamed = payload
    for name in FIELDS:
        renamed = F.regexp_replace(renamed, rf'"(?i:{name})"(\s*:)', f'"{name}"$1')
    # Most payloads hold no capital letter at all, which is quicker to see than the pattern.
    return F.when((F.lower(payload) != payload) & payload.rlike(odd), renamed).otherwise(payload)


def _without_nulls(payload: Column) -> Column:
    """A null leaves a text or number field as an earlier copy of it set it, so it gets another name."""
    null = rf'"(?:{"|".join(PLAIN_FIELDS)})"(\s*:\s*null\b)'
    return F.when(payload.contains("null"), F.regexp_replace(payload, null, '"_"$1')).otherwise(payload)


def _kind(name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("_doc", f"$[0].{name}", "variant"))


def _text(name: str) -> Column:
    return F.try_variant_get("_doc", f"$[0].{name}", "string")


def _string_or_absent(kind: str) -> Column:
    return F.coalesce(F.col(kind).isin("STRING", "VOID"), F.lit(True))


def _number_or_absent(kind: str) -> Column:
    plain = F.col(kind).isin("VOID", "BIGINT", "DOUBLE", "FLOAT")
    return F.coalesce(plain | F.col(kind).startswith("DECIMAL"), F.lit(True))


def parse_events(raw: DataFrame, default_ts: str | Column | None = None) -> DataFrame:
    """Parse ``value`` of a log-shaped DataFrame and say why a row cannot be used.

    ``default_ts`` (epoch seconds) stands in for a missing or unreadable event time; give a
    column that is stored with the log to make replays repeat, else the wall clock is used.
    The raw bytes stay in ``payload``. ``reject_reason`` is NULL on valid rows.
    """
    configure(raw.sparkSession)
    if default_ts is None:
        default = F.unix_timestamp()
    else:
        default = F.col(default_ts) if isinstance(default_ts, str) else default_ts
    text = F.coalesce(F.col("payload"), F.lit(""))
    # The parser ignores what follows the first JSON value. Inside [ ] such a tail breaks the
    # array unless it starts with ], and inside { } it breaks the object unless it starts with }.
    in_object = F.concat(F.lit('{"p":'), text, F.lit("}"))
    documents = (
        raw.withColumnRenamed("value", "payload")
        .withColumn("payload", F.col("payload").cast("string"))
        .withColumn("default_ts", default.cast("bigint"))
        .withColumn("_doc", F.try_parse_json(F.concat(F.lit("["), _without_nulls(_exact_names(text)), F.lit("]"))))
        .withColumn("_whole", ~text.contains("]") | F.try_parse_json(in_object).isNotNull())
        .withColumn("_root", F.ltrim(text, F.lit(" \t\n\r")))
    )
    keep = [c for c in raw.columns if c not in ("value", *EVENT_COLUMNS)]
    # A generator of one row: filters on the fields stay above it, so that no later condition
    # on the result makes the document be parsed again.
    fields = F.struct(
        F.try_variant_get("_doc", "$[1]", "variant").isNotNull().alias("_more"),
        *[_kind(name).alias(f"_{name}") for name in FIELDS],
        F.coalesce(_text("user_id"), F.lit("")).alias("user_id"),
        F.coalesce(_text("event_type"), F.lit("")).alias("event_type"),
        F.coalesce(F.try_variant_get("_doc", "$[0].value", "double"), F.lit(0.0)).alias("value"),
        _text("timestamp").alias("_time_text"),
        F.try_variant_get("_doc", "$[0].timestamp", "bigint").alias("_time_number"),
        _text("trace_id").alias("_trace_text"),
    )
    flat = documents.select(
        *keep,
        "payload",
        "default_ts",
        (
            F.col("_doc").isNotNull()
            & F.col("_whole")
            # An object, or a bare null, which counts as an object without fields.
            & (F.col("_root").startswith("{") | F.col("_root").startswith("null"))
        ).alias("_object"),
        F.inline(F.array(fields)),
    )
    # Only strings and 64-bit integers are readable event times.
    pieces = time_pieces(F.col("_time_text"))
    pieces["number"] = F.coalesce(F.col("_time_number"), pieces["number"])
    timed = flat.withColumns(
        {
            "_time_text": F.when(F.col("_timestamp") == "STRING", trim_time(F.col("_time_text"))),
            "_time_number": F.when(F.col("_timestamp") == "BIGINT", F.col("_time_number")),
        }
    ).withColumns({f"_{name}": piece for name, piece in pieces.items()})
    well_formed = (
        F.col("_object")
        & ~F.col("_more")
        & _string_or_absent("_user_id")
        & _string_or_absent("_event_type")
        & _string_or_absent("_trace_id")
        & _number_or_absent("_value")
        & (F.abs("value") < F.lit(float("inf")))
    )
    seconds = epoch_seconds(*[F.col(f"_{name}") for name in pieces], F.col("default_ts"))
    key = idempotency_key(
        F.col("_trace_text"), F.col("topic"), F.col("partition"), F.col("offset")
    )
    reason = (
        F.when(F.coalesce(F.col("payload"), F.lit("")) == "", F.lit(EMPTY))
        .when(~well_formed, F.lit(MALFORMED))
        .otherwise(reject_reason())
    )
    return timed.select(
        *keep,
        "payload",
        "user_id",
        "event_type",
        "value",
        seconds.alias("timestamp"),
        "default_ts",
        key.alias("trace_id"),
        reason.alias("reject_reason"),
    )


def reject_reason() -> Column:
    """First failing rule of an already typed event, NULL when it is valid."""
    value = F.col("value")
    return (
        F.when(is_blank(F.col("user_id")), F.lit(NO_USER))
        .when(is_blank(F.col("event_type")), F.lit(NO_TYPE))
        .when(F.isnan(value) | (F.abs(value) > F.lit(MAX_VALUE)), F.lit(OUT_OF_RANGE))
    )


def lean(parsed: DataFrame) -> DataFrame:
    """Keep the raw payload of rejected rows only."""
    return parsed.withColumn("payload", F.when(F.col("reject_reason").isNotNull(), F.col("payload")))


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "payload")


def rejects(parsed: DataFrame) -> DataFrame:
    place = [c for c in ("topic", "partition", "offset", "key") if c in parsed.columns]
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        *place, "payload", "reject_reason"
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_events(parsed), rejects(parsed)
