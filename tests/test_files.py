import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from tapespark.functions.feed import feed_date
from tapespark.operators.metrics import with_trade_date
from tapespark.schemas import TRADE_SCHEMA
from tapespark.sinks import write_counted, write_csv, write_daily
from tapespark.sources.files import file_headers
from tapespark.sources import csv_rejects, read_daily, read_many_csv, read_trades_csv

DAY, NEXT = dt.datetime(2024, 1, 1, 9, 30), dt.datetime(2024, 1, 2, 9, 30, 0, 250)


def rows(spark, *values):
    return spark.createDataFrame(
        [("trade_report", at, "A", size, 1.5, str(size)) for at, size in values], TRADE_SCHEMA
    )


def test_times_with_and_without_a_fraction_in_one_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "type,timestamp,symbol,sale_size,sale_price,trade_id\n"
        "trade_report,2024-01-01T09:30:00,A,1,1.5,1\n"
        "trade_report,2024-01-02T09:30:00.000250,A,2,,2\n"
    )
    got = read_trades_csv(spark, str(tmp_path / "t.csv")).orderBy("trade_id").collect()
    assert [r.timestamp for r in got] == [DAY, NEXT]
    assert got[1].sale_price is None


def test_microseconds_survive_csv(spark, tmp_path):
    write_csv(rows(spark, (NEXT, 1)), str(tmp_path / "out"))
    assert read_trades_csv(spark, str(tmp_path / "out")).first().timestamp == NEXT


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("symbol,sale_size\nA,1\n")
    (tmp_path / "b.csv").write_text("sale_size,symbol\n2,B\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    got = read_many_csv(spark, paths).orderBy("symbol").collect()
    assert [(r.symbol, r.sale_size) for r in got] == [("A", 1), ("B", 2)]


def test_one_scan_per_header(spark, tmp_path):
    for k in range(30):
        columns, row = ("symbol,sale_size", f"A,{k}") if k % 2 else ("sale_size,symbol", f"{k},A")
        (tmp_path / f"{k}.csv").write_text(f"{columns}\n{row}\n")
    got = read_many_csv(spark, [str(tmp_path / f"{k}.csv") for k in range(30)])
    assert sorted(r.sale_size for r in got.collect()) == list(range(30))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_csv_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("symbol,sale_size,sale_price\nA,1,2.5\nB,many,x\nC,,\n")
    [row] = csv_rejects(spark, str(tmp_path / "a.csv")).collect()
    assert row.columns == ["sale_size", "sale_price"]
    assert '"symbol":"B"' in row.row


@pytest.mark.parametrize("values", [[], [(DAY, 1), (DAY, 2), (NEXT, 3)]])
def test_counted_write(spark, tmp_path, values):
    path = str(tmp_path / "out")
    assert write_counted(rows(spark, *values), path) == len(values)
    assert (tmp_path / "out" / "_SUCCESS").exists()
    assert spark.read.schema(TRADE_SCHEMA).parquet(path).count() == len(values)


def test_a_later_write_replaces_only_its_dates(spark, tmp_path):
    root = str(tmp_path / "daily")
    write_daily(with_trade_date(rows(spark, (DAY, 1), (NEXT, 2))), root)
    write_daily(with_trade_date(rows(spark, (NEXT, 3))), root)
    got = read_daily(spark, root).orderBy("date").collect()
    assert [(r.date, r.sale_size) for r in got] == [(DAY.date(), 1), (NEXT.date(), 3)]


def test_a_heavy_date_is_split_over_tasks(spark, tmp_path):
    """Most rows on one date: the rebalance spreads them over several files."""
    root = str(tmp_path / "daily")
    n = 60_000
    heavy = spark.range(n).selectExpr(
        "'trade_report' as type", "timestamp_ntz'2024-01-01 09:30:00' as timestamp",
        "md5(cast(id as string)) as symbol", "id as sale_size", "rand(1) as sale_price",
        "md5(cast(id + 1 as string)) as trade_id",
        "if(id % 10 = 0, date'2024-01-02', date'2024-01-01') as date",
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "512k")
    try:
        write_daily(heavy, root)
    finally:
        spark.conf.set(setting, before)
    assert read_daily(spark, root).count() == n
    assert len(list((tmp_path / "daily" / "date=2024-01-01").glob("*.parquet"))) > 1


def test_feed_date_takes_the_last_match(spark):
    paths = [
        ("s3://raw/data_feeds_20160101_x/data_feeds_20171031_20171031_IEXTP1_TOPS1.5.pcap.gz",),
        ("s3://raw/data_feeds/20161212.pcap.gz",),
        ("data_feeds_20171399_20171399_IEXTP1_TOPS1.5.pcap.gz",),
    ]
    dated = spark.createDataFrame(paths, "p string").select(feed_date(F.col("p")).alias("d"))
    assert [r.d for r in dated.collect()] == [dt.date(2017, 10, 31), None, None]


def test_headers_are_read_alone(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("symbol,sale_size\nA,1\n" + "B,2\n" * 100_000)
    (folder / "b.csv").write_bytes("﻿symbol,sale_size\nÄ,3\n".encode())
    (folder / "c.csv").write_text("")
    with gzip.open(folder / "d.csv.gz", "wt") as out:
        out.write("\n\nsale_size,symbol\n4,D\n")
    heads = file_headers(spark, [str(folder)])
    assert sorted((p.rsplit("/", 1)[1], h) for p, h in heads.items()) == [
        ("a.csv", "symbol,sale_size"), ("b.csv", "symbol,sale_size"), ("d.csv.gz", "sale_size,symbol"),
    ]
    got = read_many_csv(spark, [str(folder)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("FileScan csv") == 2
    assert got.count() == 100_003 and got.where("symbol = 'D'").first().sale_size == 4


def test_files_without_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n \n")
    got = read_many_csv(spark, [str(tmp_path / "a.csv")])
    assert got.count() == 0 and got.columns == TRADE_SCHEMA.names
