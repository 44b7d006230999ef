"""Event time: unit detection for epoch numbers, RFC 3339 text, and the default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spikelens.functions.text import WHITE_SPACE

# Fixed limits: an epoch number above one is in that unit; the divisor brings it to seconds.
EPOCH_UNITS = [
    (10_000_000_000_000_000, 1_000_000_000),  # nanoseconds
    (100_000_000_000_000, 1_000_000),  # microseconds
    (100_000_000_000, 1_000),  # milliseconds
]

# White space that JSON text may hold unescaped; an escaped tab or line end is not skipped.
OUTER_SPACE = "".join(c for c in WHITE_SPACE if c >= " ")
INTEGER = r"^[+-]?[0-9]+$"
RFC3339 = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{1,2}:[0-9]{2}:[0-9]{2})"
    r"(?:[.,][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
)


def trim_time(text: Column) -> Column:
    return F.btrim(text, F.lit(OUTER_SPACE))


def time_pieces(plain: Column) -> dict[str, Column]:
    """The number, or the local time and zone, in trimmed text; NULL or '' if it holds none."""
    # Only a time has a T; the test spares the pattern on plain numbers.
    timed = plain.contains("T")
    return {
        "number": F.when(plain.rlike(INTEGER), plain.try_cast("bigint")),
        "local": F.when(timed, F.regexp_extract(plain, RFC3339, 1)),
        "zone": F.when(timed, F.regexp_extract(plain, RFC3339, 2)),
    }


def epoch_seconds(number: Column, local: Column, zone: Column, default_ts: Column) -> Column:
    """Seconds since 1970 from the pieces, else ``default_ts``."""
    by_unit = [
        F.when(number > F.lit(limit), F.call_function("div", number, F.lit(divisor).cast("bigint")))
        for limit, divisor in EPOCH_UNITS
    ]
    # The fraction is left out and the zone applied by hand: any offset works, the result is a floor.
    hours = F.substring(zone, 1, 3).try_cast("bigint")
    minutes = F.concat(F.substring(zone, 1, 1), F.substring(zone, 5, 2)).try_cast("bigint")
    shift = F.when(zone == "Z", F.lit(0).cast("bigint")).when(
        (F.abs(hours) <= 24) & (F.abs(minutes) <= 60), hours * F.lit(3600) + minutes * F.lit(60)
    )
    moment = F.unix_seconds(F.concat(local, F.lit("Z")).try_cast("timestamp")) - shift
    return F.coalesce(*by_unit, number, moment, default_ts)


def normalise_ts(text: Column, default_ts: Column) -> Column:
    """Epoch seconds from the text of an epoch integer (s, ms, µs or ns) or an RFC 3339 time.

    Anything else, NULL included, gives ``default_ts``.
    """
    return epoch_seconds(**time_pieces(trim_time(text)), default_ts=default_ts)


def event_time(ts: Column, default_ts: Column) -> Column:
    """The stored event timestamp; a time that is not positive falls back to the default."""
    return F.timestamp_seconds(F.when(ts > 0, ts).otherwise(default_ts))
