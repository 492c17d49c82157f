"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.functions.pricing import notional


def fct_tops(stg: DataFrame, by_type: bool = False) -> DataFrame:
    """Average price, average spread and volume per trade date and symbol.

    The plain form averages every row, the zeros of rows of another type included.
    ``by_type=True`` takes prices from trades whose price is known and spreads from quotes
    whose both sides are; the zeros that stand for what is missing do not count.
    """
    price = F.col("last_sale_price")
    spread = F.col("ask_price") - F.col("bid_price")
    if by_type:
        traded = price > 0
        sides = ("bid_size", "bid_price", "ask_size", "ask_price")
        quoted = F.lit(True)
        for side in sides:
            quoted = quoted & (F.col(side) > 0)
        price, spread = F.when(traded, price), F.when(quoted, spread)
    return stg.groupBy("trade_date", "symbol").agg(
        F.avg(price).alias("avg_price"),
        F.avg(spread).alias("avg_spread"),
        F.sum("last_sale_size").alias("total_volume"),
    )


def fct_trades(stg: DataFrame) -> DataFrame:
    """Notional and number of trades per symbol."""
    value = notional(F.col("last_sale_price"), F.col("last_sale_size"))
    return stg.groupBy("symbol").agg(
        F.sum(value).alias("notional"),
        F.count(F.lit(1)).alias("trade_count"),
    )
