from spikelens.functions.anomaly import avg_of_text_list, is_anomaly
from spikelens.functions.keys import fallback_key, idempotency_key
from spikelens.functions.text import is_blank, trim_space
from spikelens.functions.timestamps import event_time, normalise_ts

__all__ = [
    "avg_of_text_list",
    "event_time",
    "fallback_key",
    "idempotency_key",
    "is_anomaly",
    "is_blank",
    "normalise_ts",
    "trim_space",
]
