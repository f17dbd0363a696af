"""Exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1 cuts a double into a 26 bit head and a tail.
_SPLITTER = 134217729.0
# From 2**39 on, neighbouring doubles lie further apart than 1e-4.
_COARSE = float(2**39)


def round_half_even(x: Column, places: int = 4) -> Column:
    """Round the exact binary value of a double, ties to even, as plain arithmetic.

    ``round`` and ``bround`` round the printed decimal, which is another number: 0.6667 / 2 prints
    as 0.33335 but lies below the tie. Here ``x * 10**places`` is held as two exact products, so
    the distance to the candidate integer keeps its sign. Good up to four places.
    """
    if not 0 <= places <= 4:
        raise ValueError("places must be between 0 and 4")
    scale = float(10**places)
    x = x.cast("double")
    spill = x * F.lit(_SPLITTER)
    head = spill - (spill - x)
    tail = x - head
    near = F.rint(x * F.lit(scale))
    gap = head * F.lit(scale) - near
    over = (gap - F.lit(0.5)) + tail * F.lit(scale)
    under = (gap + F.lit(0.5)) + tail * F.lit(scale)
    odd = F.abs(near % F.lit(2.0)) == 1.0
    step = (
        F.when((over > 0) | ((over == 0) & odd), 1.0)
        .when((under < 0) | ((under == 0) & odd), -1.0)
        .otherwise(0.0)
    )
    usable = F.abs(x) < F.lit(_COARSE)  # false for infinities, large values and NaN
    return F.when(usable, (near + step) / F.lit(scale)).otherwise(x)


def round_half_up(x: Column) -> Column:
    """Nearest integer, ties towards positive infinity."""
    return F.floor(x + F.lit(0.5)).cast("bigint")
