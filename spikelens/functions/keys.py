"""Idempotency keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spikelens.functions.text import trim_space


def idempotency_key(trace: Column, topic: Column, partition: Column, offset: Column) -> Column:
    """The producer's trimmed key, or 32 hex digits of the SHA-256 of ``topic:partition:offset``.

    The derived key depends on the log position alone, so a replay repeats it.
    """
    place = F.concat_ws(":", topic, partition.cast("string"), offset.cast("string"))
    given = F.nullif(trim_space(trace), F.lit(""))
    return F.coalesce(given, F.substring(F.sha2(place, 256), 1, 32))


def fallback_key() -> Column:
    """32 random hex digits, for events that have neither a key nor a log position."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))
