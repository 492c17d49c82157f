"""Staging views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.schemas import STG_TOPS_SCHEMA


def stg_tops(raw: DataFrame) -> DataFrame:
    """Typed quote+trade rows with a trade date and a trade flag.

    ``ts`` and ``date`` are used where the source has them; otherwise they come from
    ``timestamp``.  Prices are double, not 32-bit float.
    """
    ts = F.col("ts" if "ts" in raw.columns else "timestamp").cast("timestamp_ntz")
    day = F.col("date") if "date" in raw.columns else ts
    made = {
        "ts": ts,
        "trade_date": day.cast("date"),
        "is_trade": F.when(F.col("last_sale_size") > 0, 1).otherwise(0),
    }
    return raw.select(*[
        made.get(field.name, F.col(field.name)).cast(field.dataType).alias(field.name)
        for field in STG_TOPS_SCHEMA.fields
    ])


def stg_trades(raw: DataFrame) -> DataFrame:
    """The raw trades, with sale columns under the names the facts read."""
    bridge = {"sale_size": "last_sale_size", "sale_price": "last_sale_price"}
    return raw.withColumnsRenamed({old: new for old, new in bridge.items() if new not in raw.columns})
