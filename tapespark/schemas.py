"""Declared schemas of the tables which the operators read and write.

Feed timestamps carry no zone, so they are ``timestamp_ntz``: trade dates then do
not depend on the session's time zone.  The operators also accept ``timestamp``.
"""

from pyspark.sql import types as T


def _struct(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec.items()])


_text, _long, _int, _double = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_time, _date = T.TimestampNTZType(), T.DateType()

MESSAGE_SCHEMA = _struct({
    "type": _text, "timestamp": _time, "symbol": _text,
    "size": _long, "price": _double, "trade_id": _text,
    "bid_size": _long, "bid_price": _double,
    "ask_size": _long, "ask_price": _double,
})

TRADE_SCHEMA = _struct({
    "type": _text, "timestamp": _time, "symbol": _text,
    "sale_size": _long, "sale_price": _double, "trade_id": _text,
})

TOPS_SCHEMA = _struct({
    "type": _text, "timestamp": _time, "symbol": _text,
    "bid_size": _long, "bid_price": _double,
    "ask_size": _long, "ask_price": _double,
    "last_sale_size": _long, "last_sale_price": _double,
})

STG_TOPS_SCHEMA = _struct({
    "symbol": _text, "ts": _time, "trade_date": _date,
    "bid_price": _double, "ask_price": _double, "last_sale_price": _double,
    "bid_size": _long, "ask_size": _long, "last_sale_size": _long,
    "is_trade": _int,
})

CALENDAR_SCHEMA = _struct({
    "trade_date": _date, "date_str": _text, "version": _text,
    "file_name": _text, "input_path": _text, "output_path": _text,
})

OUTCOME_SCHEMA = _struct({
    "date_str": _text, "status": _text, "rows": _long, "reason": _text,
})

WEIGHTS_SCHEMA = _struct({
    "layer": _text, "rows": _int, "cols": _int, "values": T.ArrayType(_double),
})


def with_date(schema: T.StructType) -> T.StructType:
    """The schema plus the ``date`` partition column of a daily dataset."""
    return T.StructType([*schema.fields, T.StructField("date", T.DateType(), True)])
