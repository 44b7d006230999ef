"""The two-tier surge test and the average of a cached list of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spikelens.params import EngineParams

# Decimal and exponent notation only: a cast alone would also take '1.0d' and padded text.
FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def is_anomaly(value: Column, avg: Column, params: EngineParams = EngineParams()) -> Column:
    """``value > avg * multiplier`` on a positive finite average, else ``value > fallback``."""
    usable = avg.isNotNull() & ~F.isnan(avg) & (avg > 0) & (avg < F.lit(float("inf")))
    return F.when(usable, value > avg * F.lit(params.multiplier)).otherwise(
        value > F.lit(params.fallback)
    )


def avg_of_text_list(texts: Column) -> Column:
    """Average of the finite numbers in a list of texts, summed in list order; NULL if none."""
    numbers = F.filter(
        F.transform(texts, lambda t: F.when(t.rlike(FLOAT_TEXT), t.try_cast("double"))),
        lambda d: d.isNotNull() & (F.abs(d) < F.lit(float("inf"))),
    )
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, d: acc + d)
    return F.when(F.size(numbers) > 0, total / F.size(numbers))
