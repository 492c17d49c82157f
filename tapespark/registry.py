"""Every operator as a query over the given tables.

Aggregates of doubles are rounded here, not in the operators: engines add in different
orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapespark import adapters
from tapespark.functions import conform, feed_file_name
from tapespark.functions.network import HIDDEN, INPUTS, Weights
from tapespark.operators import alerts, marts, metrics, normalize, outcomes, staging, training
from tapespark.operators.combine import union_all
from tapespark.operators.curate import curate
from tapespark.operators.scoring import score
from tapespark.plans.daily import run_daily
from tapespark.plans.ingest import ingest_day, ingest_range, read_outcomes, read_rejects, read_trades
from tapespark.plans.models import build_models
from tapespark.schemas import TRADE_SCHEMA
from tapespark.session import scratch_path
from tapespark.sinks import write_counted, write_csv, write_daily, write_parquet, write_summary
from tapespark.sources import csv_rejects as rejects_of_csv
from tapespark.sources import (
    calendar_of,
    read_daily,
    read_feed_text,
    read_many_csv,
    read_parquet,
    read_trades_csv,
    trading_days,
    with_file_date,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RAW_PREFIX, OUT_PREFIX = "/feeds/", "/trades/"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.messages_from_events(_table(spark, sf_dir, "events"))


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.trades_from_events(_table(spark, sf_dir, "events"))


def _bulk_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.trades_from_lineitem(_table(spark, sf_dir, "lineitem"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.payloads_from_events(_table(spark, sf_dir, "events"))


def _rounded(df: DataFrame, digits: int = 6, **digits_of: int) -> DataFrame:
    """Doubles rounded, to ``digits`` unless the column is named."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, digits_of.get(name, digits)) for name in doubles})


# Metrics

@query
def daily_metrics(spark, sf_dir):
    return _rounded(metrics.daily_metrics(_trades(spark, sf_dir)))


@query
def daily_metrics_bulk(spark, sf_dir):
    return _rounded(metrics.daily_metrics(_bulk_trades(spark, sf_dir)))


@query
def daily_metrics_paired(spark, sf_dir):
    return _rounded(metrics.daily_metrics(_trades(spark, sf_dir), paired_vwap=True))


@query
def exposure(spark, sf_dir):
    return _rounded(metrics.exposure(_trades(spark, sf_dir)))


@query
def exposure_bulk(spark, sf_dir):
    return _rounded(metrics.exposure(_bulk_trades(spark, sf_dir)))


@query
def trades_per_day(spark, sf_dir):
    return metrics.trades_per_day(_trades(spark, sf_dir))


@query
def date_range(spark, sf_dir):
    return metrics.date_range(_trades(spark, sf_dir))


@query
def symbols(spark, sf_dir):
    return metrics.symbols(_trades(spark, sf_dir))


@query
def default_symbols(spark, sf_dir):
    return metrics.default_symbols(_trades(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return metrics.preview(_trades(spark, sf_dir), 10)


@query
def preview_head(spark, sf_dir):
    return metrics.preview(metrics.with_trade_date(_trades(spark, sf_dir)), 5)


@query
def pivot_avg_price(spark, sf_dir):
    daily = metrics.daily_avg_price(metrics.daily_metrics(_trades(spark, sf_dir)))
    return _rounded(metrics.pivot_daily(daily, "avg_price", adapters.SYMBOLS))


@query
def pivot_volume(spark, sf_dir):
    daily = metrics.daily_volume(metrics.daily_metrics(_trades(spark, sf_dir)))
    return metrics.pivot_daily(daily, "total_volume", adapters.SYMBOLS)


@query
def pivot_vwap(spark, sf_dir):
    daily = metrics.daily_vwap(metrics.daily_metrics(_trades(spark, sf_dir)))
    return _rounded(metrics.pivot_daily(daily, "vwap", adapters.SYMBOLS))


@query
def large_trades(spark, sf_dir):
    return alerts.large_trades(metrics.with_trade_date(_trades(spark, sf_dir)))


@query
def alert_status(spark, sf_dir):
    return _rounded(alerts.alert_status(_trades(spark, sf_dir)))


@query
def alert_status_clear(spark, sf_dir):
    """Line items hold no trade that stands out."""
    return _rounded(alerts.alert_status(_bulk_trades(spark, sf_dir)))


@query
def daily_metrics_ordered(spark, sf_dir):
    """The metrics sorted for presentation."""
    return _rounded(metrics.ordered(metrics.daily_metrics(_trades(spark, sf_dir))))


@query
def union_days(spark, sf_dir):
    without_ids = _bulk_trades(spark, sf_dir).drop("trade_id")
    return union_all([_trades(spark, sf_dir), without_ids])


# Normalization, staging, facts

@query
def trade_reports(spark, sf_dir):
    return normalize.to_trades(_messages(spark, sf_dir))


@query
def encoded_messages(spark, sf_dir):
    """Trades from messages of bytes, decimals and times with offsets."""
    return normalize.to_trades(adapters.encoded_messages_from_events(_table(spark, sf_dir, "events")))


@query
def tops_normalized(spark, sf_dir):
    return normalize.to_tops(_messages(spark, sf_dir))


@query
def stg_tops(spark, sf_dir):
    return staging.stg_tops(normalize.to_tops(_messages(spark, sf_dir)))


@query
def stg_trades(spark, sf_dir):
    return staging.stg_trades(_trades(spark, sf_dir))


def _models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The models over named sources, whose names are this call's own and gone after it."""
    own = f"q{uuid.uuid4().hex}_"
    sources = {"iex_tops": normalize.to_tops(_messages(spark, sf_dir)), "iex_trades": _trades(spark, sf_dir)}
    for name, table in sources.items():
        table.createOrReplaceTempView(own + name)
    built = build_models(spark, f"{own}iex_tops", f"{own}iex_trades", own)
    tables = {name.removeprefix(own): spark.table(name) for name in built}
    for name in (*(own + name for name in sources), *built):
        spark.catalog.dropTempView(name)
    return tables


@query
def fct_tops(spark, sf_dir):
    return _rounded(_models(spark, sf_dir)["fct_tops"])


@query
def fct_tops_by_type(spark, sf_dir):
    return _rounded(marts.fct_tops(_models(spark, sf_dir)["stg_tops"], by_type=True))


@query
def fct_trades(spark, sf_dir):
    return _rounded(_models(spark, sf_dir)["fct_trades"], notional=2)


@query
def fct_trades_bulk(spark, sf_dir):
    return _rounded(marts.fct_trades(staging.stg_trades(_bulk_trades(spark, sf_dir))), notional=2)


# Sources and sinks

@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(_trades(spark, sf_dir), path)
    return read_trades_csv(spark, f"{path}/*.csv")


@query
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(_trades(spark, sf_dir), path)
    return conform(read_trades_csv(spark, path, schema=None), TRADE_SCHEMA)


@query
def csv_many(spark, sf_dir):
    root = scratch_path(spark, "csv")
    write_csv(_trades(spark, sf_dir), f"{root}/a")
    write_csv(_bulk_trades(spark, sf_dir).select("symbol", "timestamp", "sale_price", "sale_size"), f"{root}/b")
    return read_many_csv(spark, [f"{root}/a", f"{root}/b"])


@query
def csv_rejects(spark, sf_dir):
    """Trades whose sizes were written as words on every eleventh row."""
    path = scratch_path(spark, "csv")
    worded = _trades(spark, sf_dir).withColumn(
        "sale_size", F.when(F.col("trade_id").cast("long") % 11 == 0, "many").otherwise(F.col("sale_size").cast("string"))
    )
    write_csv(worded, path)
    return rejects_of_csv(spark, path).select(
        F.get_json_object("row", "$.trade_id").alias("trade_id"), F.array_join("columns", ",").alias("columns")
    )


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(_trades(spark, sf_dir), path)
    return read_parquet(spark, path)


@query
def daily_partitions(spark, sf_dir):
    root = scratch_path(spark, "daily")
    write_daily(metrics.with_trade_date(_trades(spark, sf_dir)), root)
    return read_daily(spark, root)


@query
def counted_write(spark, sf_dir):
    path = scratch_path(spark, "counted")
    rows = write_counted(_trades(spark, sf_dir), path)
    return read_parquet(spark, path).agg(F.count(F.lit(1)).alias("stored")).withColumn(
        "reported", F.lit(rows).cast("bigint")
    )


@query
def curated_trades(spark, sf_dir):
    return curate(_trades(spark, sf_dir))


# Feed text

@query
def feed_payload_parse(spark, sf_dir):
    good, _ = normalize.split_malformed(normalize.parse_payload(_payloads(spark, sf_dir).select("value")))
    return good


@query
def malformed_rows(spark, sf_dir):
    _, bad = normalize.split_malformed(normalize.parse_payload(_payloads(spark, sf_dir).select("value")))
    return bad


@query
def file_date(spark, sf_dir):
    prefix = adapters.write_feeds(_payloads(spark, sf_dir), scratch_path(spark, "feeds"))
    dated = with_file_date(read_feed_text(spark, f"{prefix}data_feeds_*"))
    return dated.groupBy("date").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters")
    )


# Calendar and outcomes

def _calendar(spark: SparkSession, sf_dir: str, table: str, moment: str, years: int = 0) -> DataFrame:
    """Calendar from the first to the last day in a table, moved on by some years."""
    def end(extreme: Column) -> Column:
        return F.add_months(F.to_date(extreme), 12 * years)

    bounds = _table(spark, sf_dir, table).agg(
        end(F.min(moment)).alias("first_day"), end(F.max(moment)).alias("last_day")
    )
    return calendar_of(trading_days(bounds), RAW_PREFIX, OUT_PREFIX)


@query
def feed_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir, "lineitem", "l_shipdate", years=20)


def _event_dates(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    """(date_str, rows) of the days with events that fit; days are told apart before they are
    written out."""
    days = _table(spark, sf_dir, "events").where(condition).groupBy(F.to_date("ts").alias("day"))
    return days.agg(F.count(F.lit(1)).alias("rows")).select(
        F.date_format("day", "yyyyMMdd").alias("date_str"), "rows"
    )


def _completed(spark, sf_dir):
    return _event_dates(spark, sf_dir, "day(ts) % 5 = 0").select("date_str")


def _files(spark, sf_dir):
    dates = _event_dates(spark, sf_dir, "day(ts) % 7 <> 2")
    return dates.select(feed_file_name(F.col("date_str")).alias("file_name"))


def _counts(spark, sf_dir):
    return _event_dates(spark, sf_dir, "event_type = 'purchase' and day(ts) % 11 <> 0")


@query
def pending_dates(spark, sf_dir):
    return outcomes.pending(_calendar(spark, sf_dir, "events", "ts"), _completed(spark, sf_dir))


@query
def skipped_dates(spark, sf_dir):
    return outcomes.skipped(_calendar(spark, sf_dir, "events", "ts"), _completed(spark, sf_dir))


@query
def missing_inputs(spark, sf_dir):
    return outcomes.missing(_calendar(spark, sf_dir, "events", "ts"), _files(spark, sf_dir))


@query
def ingest_outcomes(spark, sf_dir):
    return outcomes.outcomes(
        _calendar(spark, sf_dir, "events", "ts"),
        _completed(spark, sf_dir),
        _files(spark, sf_dir),
        _counts(spark, sf_dir),
    )


@query
def run_summary(spark, sf_dir):
    summary = outcomes.run_summary(ingest_outcomes(spark, sf_dir))
    return summary.select(
        "status", "dates", "total_rows", F.array_join("entries.date", ",").alias("listed")
    )


@query
def summary_file(spark, sf_dir):
    path = scratch_path(spark, "summary")
    write_summary(ingest_outcomes(spark, sf_dir), path)
    bucket = "array<struct<date: string, rows: bigint, reason: string>>"
    document = spark.read.schema(f"success {bucket}, failed {bucket}, skipped {bucket}").json(path)
    return union_all([
        document.select(F.lit(name).alias("bucket"), F.explode(name).alias("entry")).select("bucket", "entry.*")
        for name in ("success", "failed", "skipped")
    ])


# Jobs

def _stored_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Feed files of the events, lacking those of some days."""
    return adapters.write_feeds(
        _payloads(spark, sf_dir).where("cast(substr(date_str, 7, 2) as int) % 7 <> 2"),
        scratch_path(spark, "feeds"),
    )


@query
def range_ingest(spark, sf_dir):
    """Two overlapping runs: the second skips what the first has finished."""
    prefix, out = _stored_feeds(spark, sf_dir), scratch_path(spark, "out")
    ends = metrics.date_range(_trades(spark, sf_dir)).first()
    middle = ends.min_date + (ends.max_date - ends.min_date) / 2
    ingest_range(spark, ends.min_date, middle, prefix, out)
    ingest_range(spark, ends.min_date, ends.max_date, prefix, out)
    return read_outcomes(spark, out).select("date_str", "status", "rows", "reason", "rejected")


@query
def range_ingest_trades(spark, sf_dir):
    prefix, out = _stored_feeds(spark, sf_dir), scratch_path(spark, "out")
    ends = metrics.date_range(_trades(spark, sf_dir)).first()
    ingest_range(spark, ends.min_date, ends.max_date, prefix, out)
    return read_trades(spark, out)


@query
def range_ingest_rejects(spark, sf_dir):
    prefix, out = _stored_feeds(spark, sf_dir), scratch_path(spark, "out")
    ends = metrics.date_range(_trades(spark, sf_dir)).first()
    ingest_range(spark, ends.min_date, ends.max_date, prefix, out)
    return read_rejects(spark, out)


@query
def day_ingest(spark, sf_dir):
    """All payloads as the single feed of the last day."""
    root, out = scratch_path(spark, "feeds"), scratch_path(spark, "out")
    payloads = _payloads(spark, sf_dir)
    last = payloads.agg(F.max("feed").alias("feed")).first().feed
    prefix = adapters.write_feeds(payloads.withColumn("feed", F.lit(last)), root)
    ingest_day(spark, f"{prefix}{last}", out)
    return read_trades(spark, out)


# Model

#: Numbers of a vector, all of which the network takes.
WIDTH = 64


def _weights(inputs: int = INPUTS) -> Weights:
    """Small regular weights which another engine can state as well."""
    unit, given = np.arange(HIDDEN), np.arange(inputs)
    return Weights(
        ((31 * unit[:, None] + 17 * given) % 13 - 6) / 10,
        (unit % 5 - 2) / 10,
        (7 * unit % 11 - 5) / 10,
        0.1,
    )


@query
def fraud_score(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"))
    return _rounded(score(vectors, "features", _weights(WIDTH)).drop("features"))


@query
def stored_weights(spark, sf_dir):
    """Weights fitted for one epoch, saved, loaded and applied."""
    path = scratch_path(spark, "weights")
    fitted, _ = training.fit(
        _training_table(spark, sf_dir), "features", "label", epochs=1, start=_weights(WIDTH)
    )
    training.save_weights(spark, fitted, path)
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"))
    return _rounded(score(vectors, "features", training.load_weights(spark, path)).drop("features"))


@query
def scored_trades(spark, sf_dir):
    root = scratch_path(spark, "daily")
    write_csv(_trades(spark, sf_dir), f"{root}/raw")
    scored = run_daily(
        spark, f"{root}/raw", f"{root}/parquet", f"{root}/curated", f"{root}/scored", _weights()
    )
    return scored.withColumn("score", F.round("score", 6))


def _training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and labels, stored: training scans them once per epoch."""
    path = scratch_path(spark, "training")
    write_parquet(
        adapters.training_rows(_table(spark, sf_dir, "embeddings"), _table(spark, sf_dir, "labels")), path
    )
    return read_parquet(spark, path)


@query
def fraud_gradient(spark, sf_dir):
    rows = adapters.training_rows(_table(spark, sf_dir, "embeddings"), _table(spark, sf_dir, "labels"))
    return _rounded(training.gradient(rows, "features", "label", _weights(WIDTH)), 9)


@query
def fraud_fit_losses(spark, sf_dir):
    _, losses = training.fit(_training_table(spark, sf_dir), "features", "label", start=_weights(WIDTH))
    return _rounded(spark.createDataFrame(list(enumerate(losses, 1)), "epoch int, loss double"), 9)
