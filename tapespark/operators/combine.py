"""Putting tables together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; duplicates stay, absent columns are NULL."""
    if not frames:
        raise ValueError("union_all needs at least one table")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
