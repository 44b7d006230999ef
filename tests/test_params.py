import math

import pytest

from spikelens import EngineParams


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        (dict(), (10, 1.5, 1000.0)),
        (dict(window=20, multiplier=2.0, fallback=500.5), (20, 2.0, 500.5)),
        (dict(window="20", multiplier="2.0", fallback="500.5"), (20, 2.0, 500.5)),
        (dict(window=0, multiplier=-2.5, fallback=math.nan), (10, 1.5, 1000.0)),
        (dict(window="ten", multiplier="x", fallback="x"), (10, 1.5, 1000.0)),
        (dict(window=-3, multiplier=math.inf, fallback=-math.inf), (10, 1.5, 1000.0)),
        (dict(window=None, multiplier=0, fallback=0), (10, 1.5, 0.0)),
        (dict(window=math.nan), (10, 1.5, 1000.0)),
        (dict(window=math.inf), (10, 1.5, 1000.0)),
        (dict(window="1_0", fallback="1_0"), (10, 1.5, 1000.0)),
        (dict(window=20.0), (20, 1.5, 1000.0)),
        (dict(window="2.5", fallback=-7), (10, 1.5, -7.0)),
    ],
)
def test_unusable_settings_fall_back(given, expected):
    params = EngineParams(**given)
    assert (params.window, params.multiplier, params.fallback) == expected
