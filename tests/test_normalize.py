import datetime as dt
from decimal import Decimal

import pytest

from tapespark.functions import conform
from tapespark.operators.normalize import parse_payload, split_malformed, to_tops, to_trades
from tapespark.schemas import MESSAGE_SCHEMA, TRADE_SCHEMA
from tapespark.sources import read_feed_text

AT = dt.datetime(2024, 1, 1, 9, 30)


def test_trades_from_encoded_messages(spark):
    messages = spark.createDataFrame(
        [
            ("trade_report", AT, bytearray(b"ABC"), 5, Decimal("1.25"), 77),
            ("trade_report", AT, bytearray(b"ABC"), None, None, None),
            ("quote_update", AT, bytearray(b"ABC"), 5, Decimal("1.25"), 78),
        ],
        "type string, timestamp timestamp_ntz, symbol binary, size bigint, price decimal(10,4), trade_id bigint",
    )
    trades = to_trades(messages)
    assert trades.schema.names == TRADE_SCHEMA.names
    assert [tuple(r) for r in trades.collect()] == [
        ("trade_report", AT, "ABC", 5, 1.25, "77"),
        ("trade_report", AT, "ABC", None, None, None),
    ]


def test_tops_zero_what_does_not_apply(spark):
    messages = spark.createDataFrame(
        [
            ("trade_report", AT, "A", 5, 1.5, "1", 9, 9.0, 9, 9.0),
            ("quote_update", AT, "A", 5, 1.5, "2", 1, 2.0, None, 4.0),
            ("trading_status", AT, "A", 5, 1.5, "3", 9, 9.0, 9, 9.0),
            (None, AT, "A", 5, 1.5, "4", 9, 9.0, 9, 9.0),
            ("trade_report", AT, None, 5, 1.5, "5", 9, 9.0, 9, 9.0),
            ("trade_report", None, "A", 5, 1.5, "6", 9, 9.0, 9, 9.0),
        ],
        MESSAGE_SCHEMA,
    )
    rows = [tuple(r)[3:] for r in to_tops(messages).collect()]
    assert rows == [
        (0, 0.0, 0, 0.0, 5, 1.5),
        (1, 2.0, 0, 4.0, 0, 0.0),
        (0, 0.0, 0, 0.0, 0, 0.0),
        (0, 0.0, 0, 0.0, 0, 0.0),
    ]


@pytest.fixture
def parsed(spark):
    def parse(*payloads):
        return parse_payload(spark.createDataFrame([(p,) for p in payloads], "value string"))

    return parse


def test_good_payloads(parsed):
    good, bad = split_malformed(
        parsed(
            " \ttrade_report,2024-01-01T09:30:00,A,5,1.5,1\r",
            "trade_report,2024-01-01T09:30:00.000250+00:00,A,,,",
            "trade_report_x,2024-01-01T09:30:00,A,5,nan,1",
            "quote_update,2024-01-01T09:30:00,A,5,1.5,1",
            "",
        )
    )
    assert bad.count() == 0
    assert [tuple(r) for r in good.collect()] == [
        ("trade_report", AT, "A", 5, 1.5, "1"),
        ("trade_report", AT.replace(microsecond=250), "A", None, None, None),
        ("trade_report_x", AT, "A", 5, None, "1"),
    ]


def test_malformed_payloads_are_kept_with_a_reason(parsed):
    good, bad = split_malformed(
        parsed(
            "trade_report",
            "trade_report,2024-01-01T09:30:00,A,5,1.5",
            "trade_report,2024-01-01T09:30:00,A,5,1.5,1,2",
            "trade_report,yesterday,A,5,1.5,1",
            "trade_report,2024-01-01T09:30:00,A,many,1.5,1",
            "trade_report,2024-01-01T09:30:00,A,5,cheap,1",
        )
    )
    assert good.count() == 0
    assert [r.reason for r in bad.collect()] == ["field count"] * 3 + [
        "bad timestamp", "bad sale_size", "bad sale_price",
    ]


def test_invalid_bytes_are_dropped(spark, tmp_path):
    (tmp_path / "feed.txt").write_bytes(
        b"trade_report,2024-01-01T09:30:00,A\xff\xfeB,5,1.5,1\n"
        + "trade_report,2024-01-01T09:30:00,Ä�,5,1.5,2\n".encode()
    )
    good, _ = split_malformed(parse_payload(read_feed_text(spark, str(tmp_path / "feed.txt"))))
    assert [r.symbol for r in good.collect()] == ["AB", "Ä�"]


def test_conform_converts_and_fills(spark):
    df = spark.createDataFrame([("x", "7", "NaN")], "symbol string, sale_size string, sale_price string")
    assert tuple(conform(df, TRADE_SCHEMA).first()) == (None, None, "x", 7, None, None)
    bad = spark.createDataFrame([("x",)], "sale_size string")
    assert conform(bad, TRADE_SCHEMA).first().sale_size is None


def test_damaged_bytes_and_offsets(spark):
    """Bytes that are not text leave no symbol; times with an offset are brought to UTC."""
    messages = spark.sql("""
        select 'trade_report' as type, t as timestamp, unhex(s) as symbol, 1L as size,
               cast(1.2500 as decimal(18, 4)) as price, i as trade_id
        from values ('1', '2024-01-01T20:00:00-05:00', '41FF42'), ('2', '2024-01-01T20:00:00.25', '414243'),
                    ('3', '2024-01-01 20:00:00Z', 'C3A9'), ('4', 'noon', null) as v(i, t, s)""")
    for zone in ("UTC", "America/New_York"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = {r.trade_id: r for r in to_trades(messages).collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        assert [got[k].symbol for k in "1234"] == [None, "ABC", "é", None]
        assert [str(got[k].timestamp) for k in "123"] == [
            "2024-01-02 01:00:00", "2024-01-01 20:00:00.250000", "2024-01-01 20:00:00"
        ]
        assert got["4"].timestamp is None and got["2"].sale_price == 1.25
