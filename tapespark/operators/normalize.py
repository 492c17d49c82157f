"""Raw messages and payload text to typed trade and quote rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapespark.functions.casting import conform, safe_cast
from tapespark.schemas import MESSAGE_SCHEMA, TRADE_SCHEMA

TRADE = "trade_report"
QUOTE = "quote_update"

# What counts as white space around a payload.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def to_trades(messages: DataFrame) -> DataFrame:
    """Trade reports as trade rows: sizes and prices renamed, ids as text."""
    trades = (
        messages.where(F.col("type") == TRADE)
        .withColumnsRenamed({"size": "sale_size", "price": "sale_price"})
    )
    return conform(trades, TRADE_SCHEMA)


def _only_for(kind: str, value: str, target: str) -> Column:
    zero = F.lit(0).cast(target)
    return F.when(F.col("type") == kind, F.coalesce(F.col(value), zero)).otherwise(zero)


def to_tops(messages: DataFrame) -> DataFrame:
    """Quotes and trades side by side; what does not apply to a row's type is zero.

    Messages without a symbol or a timestamp are dropped, other types stay as zeros.
    """
    known = conform(messages, MESSAGE_SCHEMA).where(
        F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()
    )
    return known.select(
        "type",
        "timestamp",
        "symbol",
        _only_for(QUOTE, "bid_size", "bigint").alias("bid_size"),
        _only_for(QUOTE, "bid_price", "double").alias("bid_price"),
        _only_for(QUOTE, "ask_size", "bigint").alias("ask_size"),
        _only_for(QUOTE, "ask_price", "double").alias("ask_price"),
        _only_for(TRADE, "size", "bigint").alias("last_sale_size"),
        _only_for(TRADE, "price", "double").alias("last_sale_price"),
    )


def parse_payload(df: DataFrame, col: str = "value") -> DataFrame:
    """Typed trade fields of the ``trade_report,...`` payloads.

    Other payloads are left out.  ``reason`` says why a payload is malformed and is
    NULL for a good one; columns besides ``col`` are carried along.  An empty field is
    a missing value, not an error.
    """
    carried = [F.col(f"`{name}`") for name in df.columns if name != col]
    width = len(TRADE_SCHEMA.fields)
    text, blanks = F.col(f"`{col}`"), F.lit(BLANKS)
    # Exploding a one-element array keeps the optimiser from repeating the split in
    # every expression below, and in filters on them.
    split = (
        df.where(F.ltrim(text, blanks).startswith(TRADE))
        .select(*carried, F.btrim(text, blanks).alias("payload"))
        .select(*carried, "payload", F.explode(F.array(F.split("payload", ","))).alias("parts"))
    )
    texts = {
        field.name: F.nullif(F.get("parts", F.lit(at)), F.lit(""))
        for at, field in enumerate(TRADE_SCHEMA.fields)
    }
    reason = F.when(F.size("parts") != width, F.lit("field count"))
    for name in ("timestamp", "sale_size", "sale_price"):
        text, kind = texts[name], TRADE_SCHEMA[name].dataType
        reason = reason.when(text.isNotNull() & text.try_cast(kind).isNull(), F.lit(f"bad {name}"))
    return split.select(
        *carried,
        *[safe_cast(texts[field.name], field.dataType).alias(field.name) for field in TRADE_SCHEMA.fields],
        "payload",
        reason.alias("reason"),
    )


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rejected payloads with the reason for each."""
    good = parsed.where(F.col("reason").isNull()).drop("payload", "reason")
    carried = [c for c in good.columns if c not in TRADE_SCHEMA.names]
    bad = parsed.where(F.col("reason").isNotNull()).select(*carried, "payload", "reason")
    return good, bad
