"""Unusually large trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def large_trades(trades: DataFrame, factor: float = 5) -> DataFrame:
    """Trades larger than ``factor`` times the mean size over all rows.

    The limit is a scalar subquery: one narrow scan gives one number, and the trades
    are then filtered without a join or a shuffle.  Whole sizes exceed a limit exactly
    when they exceed its floor; compared as integers, the filter reaches the Parquet
    scan, which skips the row groups that hold no large trade.
    """
    limit = F.avg("sale_size") * F.lit(float(factor))
    if isinstance(trades.schema["sale_size"].dataType, T.IntegralType):
        limit = F.floor(limit)
    return trades.where(F.col("sale_size") > trades.select(limit).scalar())


def alert_status(trades: DataFrame, factor: float = 5) -> DataFrame:
    """ALERT when any trade is unusually large, else CLEAR.

    One exists exactly when the largest does, so one aggregate over one scan decides.
    """
    ends = trades.agg(
        F.max("sale_size").alias("largest"),
        (F.avg("sale_size") * F.lit(float(factor))).alias("threshold"),
    )
    verdict = F.when(F.col("largest") > F.col("threshold"), "ALERT").otherwise("CLEAR")
    return ends.select(verdict.alias("status"), "largest", "threshold")
