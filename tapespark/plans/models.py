"""Staging and fact tables as named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapespark.operators.marts import fct_tops, fct_trades
from tapespark.operators.staging import stg_tops, stg_trades


def models(tops: DataFrame, trades: DataFrame) -> dict[str, DataFrame]:
    """The tables ``stg_tops``, ``stg_trades``, ``fct_tops`` and ``fct_trades`` over two given ones.

    They are plans, not copies, and have no name in the session.
    """
    staged = {"stg_tops": stg_tops(tops), "stg_trades": stg_trades(trades)}
    return {**staged, "fct_tops": fct_tops(staged["stg_tops"]), "fct_trades": fct_trades(staged["stg_trades"])}


def build_models(
    spark: SparkSession, tops: str = "iex_tops", trades: str = "iex_trades", prefix: str = ""
) -> list[str]:
    """Views of the ``models`` over two named tables, named with ``prefix`` and the model's name.

    A query on a fact is optimised down to the scan of its source.
    """
    built = models(spark.table(tops), spark.table(trades))
    for name, table in built.items():
        table.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in built]
