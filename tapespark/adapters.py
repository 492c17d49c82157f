"""The given tables seen as feed messages, trades and payload text.

The tables hold no quotes, no missing values and no feed files, so these views derive
them row by row: remainders of the event number decide where a value is missing or a
payload is damaged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.functions.feed import feed_file_name
from tapespark.operators.normalize import to_trades

# Number of symbols the events are spread over.
SYMBOL_COUNT = 20
SYMBOLS = [f"SYM{i}" for i in range(SYMBOL_COUNT)]


def messages_from_events(events: DataFrame) -> DataFrame:
    """Trade, quote and status messages; some symbols, sizes and prices are missing."""
    return events.selectExpr(
        """case event_type when 'purchase' then 'trade_report'
                when 'click' then 'quote_update' when 'view' then 'quote_update'
                else 'trading_status' end as type""",
        "ts as timestamp",
        f"if(event_id % 19 <> 0, 'SYM' || (user_id % {SYMBOL_COUNT}), null) as symbol",
        "if(event_id % 23 <> 0, cast(floor(value * 100) as bigint), null) as size",
        "if(event_id % 17 <> 0, value + 10, null) as price",
        "cast(event_id as string) as trade_id",
        "event_id % 500 + 1 as bid_size",
        "value + 10 as bid_price",
        "event_id % 300 + 1 as ask_size",
        "value + 10 + event_id % 7 * 0.25d as ask_price",
    )


def trades_from_events(events: DataFrame) -> DataFrame:
    """The purchases as trades; the filter on the stored column reaches the scan."""
    return to_trades(messages_from_events(events.where("event_type = 'purchase'")))


def encoded_messages_from_events(events: DataFrame) -> DataFrame:
    """Messages as another feed sends them: symbols as bytes, some of them damaged, decimal
    prices, and times as text, some with an offset from UTC."""
    stamp = """date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")"""
    number = "cast(trade_id as bigint)"
    return messages_from_events(events).selectExpr(
        "type",
        f"""case {number} % 3 when 0 then {stamp} when 1 then {stamp} || '-05:00'
                else {stamp} || 'Z' end as timestamp""",
        f"if({number} % 13 = 0, unhex('41FF42'), encode(symbol, 'UTF-8')) as symbol",
        "size",
        "cast(round(price, 4) as decimal(18, 4)) as price",
        "trade_id",
        "bid_size", "bid_price", "ask_size", "ask_price",
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The largest table as complete trades: one per line, suppliers as symbols."""
    return lineitem.selectExpr(
        "'trade_report' as type",
        "l_shipdate as timestamp",
        "'S' || l_suppkey as symbol",
        "cast(l_quantity as bigint) as sale_size",
        "l_extendedprice as sale_price",
        "l_orderkey || '-' || l_linenumber as trade_id",
    )


def payloads_from_events(events: DataFrame) -> DataFrame:
    """``date_str``, feed file name and payload text of every event.

    Some payloads lack a field, have one too many, hold text for a number, or are
    padded; events other than purchases carry another message type.
    """
    day = F.date_format("ts", "yyyyMMdd")
    parts = events.selectExpr(
        "ts",
        "event_id",
        f"""concat_ws(',', if(event_type = 'purchase', 'trade_report', 'quote_update'),
                      if(event_id % 41 = 0, 'noon', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
                      'SYM' || (user_id % {SYMBOL_COUNT}),
                      case when event_id % 23 = 0 then '' when event_id % 37 = 0 then 'many'
                           else cast(cast(floor(value * 100) as bigint) as string) end,
                      case when event_id % 17 = 0 then '' when event_id % 47 = 0 then 'n/a'
                           else cast(value as string) end) as head""",
    )
    bodies = parts.selectExpr(
        "ts",
        "event_id",
        """case when event_id % 29 = 0 then head
                when event_id % 31 = 0 then concat_ws(',', head, event_id, 'extra')
                else concat_ws(',', head, event_id) end as body""",
    )
    return bodies.select(
        day.alias("date_str"),
        feed_file_name(day).alias("feed"),
        F.expr("if(event_id % 43 = 0, ' \t' || body || ' ', body)").alias("value"),
    )


def write_feeds(payloads: DataFrame, root: str) -> str:
    """Store payloads as one gzipped feed per day; the prefix under which to find them.

    A feed is a folder of part files, so a heavy day decodes in parallel.
    """
    (
        payloads.select("feed", "value")
        .hint("rebalance", F.col("feed"))
        .write.partitionBy("feed")
        .option("compression", "gzip")
        .text(root)
    )
    return f"{root}/feed="


def training_rows(embeddings: DataFrame, labels: DataFrame) -> DataFrame:
    """Vectors as features and the toxicity flag as label."""
    features = F.col("embedding").cast("array<double>")
    return embeddings.join(labels, F.col("vec_id") == F.col("doc_id")).select(
        "vec_id", features.alias("features"), F.col("toxic").alias("label")
    )
