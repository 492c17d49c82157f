import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapespark.functions.pricing import vwap
from tapespark.operators import alerts, marts, metrics, staging
from tapespark.operators.combine import union_all
from tapespark.operators.curate import curate
from tapespark.schemas import TOPS_SCHEMA, TRADE_SCHEMA

DAY, NEXT = dt.datetime(2024, 1, 1, 9, 30), dt.datetime(2024, 1, 2, 9, 30)


def trade(symbol, size, price, at=DAY, trade_id="1"):
    return ("trade_report", at, symbol, size, price, trade_id)


@pytest.fixture
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), TRADE_SCHEMA)


def test_unknown_price_weighs_on_vwap_and_unknown_size_does_not(frame):
    trades = frame(trade("A", 10, 1.0), trade("A", 20, None), trade("A", None, 5.0))
    row = metrics.exposure(trades).first()
    assert row.vwap == pytest.approx(10 / 30)
    assert row.avg_price == pytest.approx(3.0)
    assert metrics.exposure(trades, paired_vwap=True).first().vwap == pytest.approx(1.0)


def test_no_volume(frame):
    rows = {
        r.symbol: r
        for r in metrics.exposure(
            frame(trade("A", None, 1.0), trade("B", 0, 1.0, trade_id=None))
        ).collect()
    }
    assert (rows["A"].total_volume, rows["A"].vwap, rows["A"].trade_count) == (0, None, 1)
    assert (rows["B"].total_volume, rows["B"].vwap, rows["B"].trade_count) == (0, None, 0)


def test_null_symbol_and_null_time_belong_nowhere(frame):
    trades = frame(trade(None, 1, 1.0), trade("A", 1, 1.0, at=None), trade("B", 1, 1.0))
    assert [r.symbol for r in metrics.symbols(trades).orderBy("symbol").collect()] == ["A", "B"]
    assert {r.symbol for r in metrics.exposure(trades).collect()} == {"A", "B"}
    assert [r.symbol for r in metrics.daily_metrics(trades).collect()] == ["B"]
    assert [r.trade_count for r in metrics.trades_per_day(trades).collect()] == [2]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(0, 3),
            st.one_of(st.none(), st.integers(0, 1000)),
            st.one_of(st.none(), st.integers(1, 10**6).map(lambda cents: cents / 100)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_vwap_against_its_definition(spark, rows):
    df = spark.createDataFrame(rows, "key int, size bigint, price double")
    got = {r.key: r.vwap for r in df.groupBy("key").agg(vwap(F.col("price"), F.col("size")).alias("vwap")).collect()}
    for key in {k for k, _, _ in rows}:
        value = [p * s for k, s, p in rows if k == key and None not in (s, p)]
        volume = [s for k, s, _ in rows if k == key and s is not None]
        if not value or not sum(volume):
            assert got[key] is None
        else:
            assert got[key] == pytest.approx(sum(value) / sum(volume))


def test_alert_is_strict(frame):
    # The mean is 100: five times that is the limit itself.
    sizes = [500] + [0] * 4
    calm = frame(*[trade("A", size, 1.0) for size in sizes])
    assert metrics.exposure(calm).first().total_volume == 500
    assert alerts.large_trades(calm).count() == 0
    assert alerts.alert_status(calm).first().status == "CLEAR"
    loud = frame(*[trade("A", size, 1.0) for size in [506] + [1] * 5], trade("A", None, 1.0))
    assert [r.sale_size for r in alerts.large_trades(loud).collect()] == [506]
    assert alerts.alert_status(loud).first().status == "ALERT"


def test_no_trades_give_no_alert(frame):
    empty = frame()
    assert alerts.large_trades(empty).count() == 0
    assert alerts.alert_status(empty).first().status == "CLEAR"


def test_pivot_leaves_absent_cells_null_and_drops_other_symbols(frame):
    trades = frame(
        trade("A", 1, 2.0), trade("B", 1, 3.0), trade("A", 1, 4.0, at=NEXT), trade("C", 1, 9.0)
    )
    daily = metrics.daily_metrics(trades)
    table = metrics.pivot_daily(daily, "avg_price", ["A", "B"]).orderBy("date")
    assert table.columns == ["date", "A", "B"]
    assert [(r.A, r.B) for r in table.collect()] == [(2.0, 3.0), (4.0, None)]


def test_range_of_one_day_and_of_several(frame):
    assert metrics.date_range(frame(trade("A", 1, 1.0))).first().min_date == dt.date(2024, 1, 1)
    several = metrics.date_range(frame(trade("A", 1, 1.0), trade("A", 1, 1.0, at=NEXT))).first()
    assert several.max_date == dt.date(2024, 1, 2)


def test_default_symbol_is_the_first_to_trade(frame):
    trades = frame(trade("A", 1, 1.0, at=NEXT), trade("B", 1, 1.0), trade(None, 1, 1.0))
    assert [r.symbol for r in metrics.default_symbols(trades).collect()] == ["B"]


def test_preview_is_ordered(frame):
    trades = frame(*[trade("A", n, 1.0, trade_id=str(n)) for n in (3, 1, 2)])
    assert [r.trade_id for r in metrics.preview(trades, 2).collect()] == ["1", "2"]


def test_union_keeps_duplicates_and_fills_gaps(spark):
    left = spark.createDataFrame([("A", 1)], "symbol string, size int")
    right = spark.createDataFrame([(1, "A")], "size int, symbol string")
    short = spark.createDataFrame([("B",)], "symbol string")
    rows = sorted(map(tuple, union_all([left, right, short]).collect()))
    assert rows == [("A", 1), ("A", 1), ("B", None)]
    with pytest.raises(ValueError):
        union_all([])


def test_curate_all_columns_or_some(frame):
    trades = frame(trade("A", 1, None), trade("A", 1, 1.0), trade(None, 1, 1.0))
    assert curate(trades).count() == 1
    assert curate(trades, ["symbol"]).count() == 2


def test_facts_by_type_leave_out_the_zeros(spark):
    tops = spark.createDataFrame(
        [
            ("trade_report", DAY, "A", 0, 0.0, 0, 0.0, 100, 10.0),
            ("quote_update", DAY, "A", 5, 9.0, 5, 11.0, 0, 0.0),
            ("trading_status", DAY, "A", 0, 0.0, 0, 0.0, 0, 0.0),
        ],
        TOPS_SCHEMA,
    )
    stg = staging.stg_tops(tops)
    plain, typed = marts.fct_tops(stg).first(), marts.fct_tops(stg, by_type=True).first()
    assert (plain.avg_price, plain.avg_spread) == pytest.approx((10 / 3, 2 / 3))
    assert (typed.avg_price, typed.avg_spread) == (10.0, 2.0)
    assert plain.total_volume == typed.total_volume == 100


def test_staging_takes_ts_and_date_where_given(spark):
    raw = spark.createDataFrame(
        [("A", DAY, dt.date(2020, 2, 2), 1.0, 2.0, 3.0, 1, 2, None)],
        "symbol string, ts timestamp_ntz, date date, bid_price double, ask_price double,"
        " last_sale_price double, bid_size bigint, ask_size bigint, last_sale_size bigint",
    )
    row = staging.stg_tops(raw).first()
    assert (row.trade_date, row.is_trade) == (dt.date(2020, 2, 2), 0)


def test_ordered_sorts_by_the_keys_there_are(spark):
    table = spark.createDataFrame([(2, "b"), (1, "c"), (1, "a")], "date int, symbol string").repartition(3)
    assert [tuple(r) for r in metrics.ordered(table).collect()] == [(1, "a"), (1, "c"), (2, "b")]
    assert [r.symbol for r in metrics.ordered(table, "symbol").collect()] == ["a", "b", "c"]


def test_facts_by_type_leave_out_what_is_not_known(spark):
    """Trades (5, 10), (5, none), (none, 20) and a one-sided quote: 15 and no spread from it."""
    rows = [("A", *quote, *trade) for quote, trade in [
        ((0, 0.0, 0, 0.0), (5, 10.0)), ((0, 0.0, 0, 0.0), (5, 0.0)), ((0, 0.0, 0, 0.0), (0, 20.0)),
        ((1, 9.0, 1, 11.0), (0, 0.0)), ((0, 0.0, 1, 11.0), (0, 0.0)),
    ]]
    names = "symbol string, bid_size long, bid_price double, ask_size long, ask_price double, last_sale_size long, last_sale_price double"
    stg = spark.createDataFrame(rows, names).selectExpr("*", "date'2024-01-01' as trade_date", "int(last_sale_size > 0) as is_trade")
    [got] = marts.fct_tops(stg, by_type=True).collect()
    assert (got.avg_price, got.avg_spread, got.total_volume) == (15.0, 2.0, 10)
