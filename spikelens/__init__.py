"""Event surge analytics as Spark jobs: parse, de-duplicate, score, audit, reconcile."""

from spikelens.params import EngineParams
from spikelens.session import configure, shared_dir

__all__ = ["EngineParams", "configure", "shared_dir"]
