from spikelens.streaming.live import LiveTables, start_live
from spikelens.streaming.stateful import configure_state, score_stream

__all__ = ["LiveTables", "configure_state", "score_stream", "start_live"]
