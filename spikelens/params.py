"""Scoring parameters and the rules that repair unusable settings."""

from __future__ import annotations

import math
from dataclasses import dataclass

# Fixed default values.
DEFAULT_WINDOW = 10
DEFAULT_MULTIPLIER = 1.5
DEFAULT_FALLBACK = 1000.0


def _as_float(raw) -> float | None:
    if isinstance(raw, str) and "_" in raw:
        return None
    try:
        number = float(raw)
    except (TypeError, ValueError):
        return None
    return number if math.isfinite(number) else None


def _as_int(raw) -> int | None:
    if isinstance(raw, bool) or (isinstance(raw, float) and not raw.is_integer()):
        return None
    if isinstance(raw, str) and "_" in raw:  # legal in Python, not in a setting
        return None
    try:
        return int(raw)
    except (TypeError, ValueError):
        return None


@dataclass(frozen=True)
class EngineParams:
    """Window length, surge multiplier and the static threshold used without a baseline.

    Text is accepted as well as numbers, since settings often come from a job's arguments.
    A window or multiplier that is not positive, and any value that is not a finite number,
    is replaced by its default; the fallback may be zero or negative.
    """

    window: int = DEFAULT_WINDOW
    multiplier: float = DEFAULT_MULTIPLIER
    fallback: float = DEFAULT_FALLBACK

    def __post_init__(self):
        window = _as_int(self.window)
        multiplier = _as_float(self.multiplier)
        fallback = _as_float(self.fallback)
        object.__setattr__(self, "window", window if window and window > 0 else DEFAULT_WINDOW)
        object.__setattr__(
            self, "multiplier", multiplier if multiplier and multiplier > 0 else DEFAULT_MULTIPLIER
        )
        object.__setattr__(self, "fallback", DEFAULT_FALLBACK if fallback is None else fallback)
