"""Price and volume expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def notional(price: Column, size: Column) -> Column:
    """Traded value; NULL when either side is."""
    return price * size


def vwap(price: Column, size: Column, paired: bool = False) -> Column:
    """Volume-weighted average price, as an aggregate expression.

    The value skips rows where either side is NULL, the volume sums every known size,
    so a trade of unknown price still weighs on the result.  ``paired=True`` gives the
    conventional form, where both sums run over complete pairs.  No volume: NULL.
    """
    weight = F.when(price.isNotNull(), size) if paired else size
    return F.try_divide(F.sum(notional(price, size)), F.sum(weight))
