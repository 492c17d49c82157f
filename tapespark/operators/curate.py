"""Curation of trade rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def curate(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value, in any column or in those of ``subset``.

    Testing every column keeps every column in the scan; name a subset where fewer do.
    """
    return df.dropna(subset=list(subset) if subset else None)
