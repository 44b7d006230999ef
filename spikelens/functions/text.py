"""Blank tests and trimming by Unicode white space (SQL ``trim`` knows U+0020 only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed set: the code points with the Unicode property White_Space.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])
) + "\u2028\u2029\u202f\u205f\u3000"


def is_blank(text: Column) -> Column:
    """True for NULL, '' and text of white space only."""
    return F.coalesce(trim_space(text), F.lit("")) == ""


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))
