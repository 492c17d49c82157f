"""Fraud scores for trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapespark.functions.network import Weights, network_score


def score(
    df: DataFrame, features_col: str, weights: Weights, output: str = "score"
) -> DataFrame:
    """Add the network's score of each row's feature array."""
    return df.withColumn(output, network_score(F.col(features_col).cast("array<double>"), weights))


def trade_features() -> Column:
    """Ten numbers of a trade row, each of order one and taken from that row alone."""
    size, price, at = F.col("sale_size"), F.col("sale_price"), F.col("timestamp")
    return F.array(*[
        part.cast("double")
        for part in (
            size / 10000.0,
            price / 1000.0,
            price * size / 1.0e7,
            F.hour(at) / 24.0,
            F.minute(at) / 60.0,
            F.floor(F.second(at)) / 60.0,
            F.weekday(at) / 7.0,
            F.dayofmonth(at) / 31.0,
            size % 100 / 100.0,
            F.length("symbol") / 10.0,
        )
    ])
