from spikelens.sources.raw_log import (
    RAW_SCHEMA,
    keyed_messages,
    read_events_range,
    read_events_stream,
    repartition_by_key,
)
from spikelens.sources.tables import (
    read_table,
    stage,
    unstage,
    write_alerts,
    write_audit,
    write_batch,
    write_rejects,
)

__all__ = [
    "RAW_SCHEMA",
    "keyed_messages",
    "read_events_range",
    "read_events_stream",
    "read_table",
    "repartition_by_key",
    "stage",
    "unstage",
    "write_alerts",
    "write_audit",
    "write_batch",
    "write_rejects",
]
