"""Risk metrics over trade rows.

Every metric is one hash aggregate.  Spark combines rows before the shuffle, so what
moves is one row per task and key, however many trades a single symbol or day holds.
Rows with a NULL key belong to no group and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapespark.functions.pricing import vwap


def with_trade_date(trades: DataFrame) -> DataFrame:
    """Add ``date``, the day of the row's timestamp."""
    return trades.withColumn("date", F.to_date("timestamp"))


def select_symbols(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Rows of the named symbols."""
    return df.where(F.col("symbol").isin(list(symbols)))


def _known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def _risk_aggregates(paired_vwap: bool) -> list[Column]:
    price, size = F.col("sale_price"), F.col("sale_size")
    return [
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total_volume"),
        F.avg(price).alias("avg_price"),
        F.count("trade_id").alias("trade_count"),
        vwap(price, size, paired_vwap).alias("vwap"),
    ]


def exposure(trades: DataFrame, paired_vwap: bool = False) -> DataFrame:
    """Volume, average price, trade count and VWAP per symbol, all days together."""
    return _known_keys(trades, ["symbol"]).groupBy("symbol").agg(*_risk_aggregates(paired_vwap))


def daily_metrics(trades: DataFrame, paired_vwap: bool = False) -> DataFrame:
    """Volume, average price, trade count and VWAP per day and symbol."""
    keys = ["date", "symbol"]
    dated = trades if "date" in trades.columns else with_trade_date(trades)
    return _known_keys(dated, keys).groupBy(*keys).agg(*_risk_aggregates(paired_vwap))


def daily_avg_price(metrics: DataFrame) -> DataFrame:
    return metrics.select("date", "symbol", "avg_price")


def daily_volume(metrics: DataFrame) -> DataFrame:
    return metrics.select("date", "symbol", "total_volume")


def daily_vwap(metrics: DataFrame) -> DataFrame:
    return metrics.select("date", "symbol", "vwap")


def trades_per_day(trades: DataFrame) -> DataFrame:
    """Trades with an id, per day."""
    dated = trades if "date" in trades.columns else with_trade_date(trades)
    return _known_keys(dated, ["date"]).groupBy("date").agg(F.count("trade_id").alias("trade_count"))


def date_range(trades: DataFrame) -> DataFrame:
    """First and last trade date."""
    return trades.agg(
        F.to_date(F.min("timestamp")).alias("min_date"),
        F.to_date(F.max("timestamp")).alias("max_date"),
    )


def symbols(trades: DataFrame) -> DataFrame:
    """Distinct symbols, leaving out NULL, which names no group."""
    return _known_keys(trades, ["symbol"]).select("symbol").distinct()


def default_symbols(trades: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` symbols to trade, ties by name."""
    first_seen = (
        _known_keys(trades, ["symbol"])
        .groupBy("symbol")
        .agg(F.min("timestamp").alias("first_seen"))
    )
    return first_seen.orderBy(F.col("first_seen").asc_nulls_last(), "symbol").limit(n).select("symbol")


def preview(df: DataFrame, n: int = 10, order_cols: Sequence[str] = ("timestamp", "trade_id")) -> DataFrame:
    """The first ``n`` rows in a stated order; each task keeps ``n`` rows, no full sort."""
    return df.orderBy(*order_cols).limit(n)


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """The table for presentation, sorted by ``keys``: date and symbol if it has them."""
    known = keys or [c for c in ("date", "trade_date", "symbol") if c in df.columns]
    return df.orderBy(*known) if known else df


def pivot_daily(metrics: DataFrame, value: str, symbols: Sequence[str]) -> DataFrame:
    """One row per date, one column per symbol; a day without the symbol is NULL.

    The symbols are given, so no extra job looks for them, and the filter on them
    reaches the trade scan through the aggregate below.
    """
    return (
        select_symbols(metrics, symbols)
        .groupBy("date")
        .pivot("symbol", list(symbols))
        .agg(F.first(value))
    )
