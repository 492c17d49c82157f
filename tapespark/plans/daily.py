"""Raw CSV to scored trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tapespark.functions.network import Weights
from tapespark.operators.curate import curate
from tapespark.operators.scoring import score, trade_features
from tapespark.sinks.writers import write_parquet
from tapespark.sources.files import read_parquet, read_trades_csv


def run_daily(
    spark: SparkSession,
    raw: str,
    parquet: str,
    curated: str,
    scored: str,
    weights: Weights,
    features: Column | None = None,
) -> DataFrame:
    """Ingest, curate and score; each stage is stored, so any of them can be re-run."""
    write_parquet(read_trades_csv(spark, raw), parquet)
    write_parquet(curate(read_parquet(spark, parquet)), curated)
    chosen = trade_features() if features is None else features
    with_features = read_parquet(spark, curated).withColumn("features", chosen)
    write_parquet(score(with_features, "features", weights).drop("features"), scored)
    return read_parquet(spark, scored)
