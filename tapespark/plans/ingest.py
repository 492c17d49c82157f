"""Feed files to daily trade folders, with an outcome per date.

An attempt at a day adds files of its own to the day's folder, good and malformed payloads
side by side, every row with the number of the run.  Nothing of it is seen until the run's
ledger, written last, names the run: readers take of a date only the rows of the run that
counts, so neither a run that died nor one that is under way shows.
"""

from __future__ import annotations

import datetime as dt
import uuid
import time
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapespark.functions.feed import FEED_STEM
from tapespark.operators.normalize import parse_payload
from tapespark.operators.outcomes import SUCCESS, outcomes, pending, present
from tapespark.schemas import OUTCOME_SCHEMA, TRADE_SCHEMA, with_date
from tapespark.sinks.writers import write_summary
from tapespark.sources.calendar import as_date, calendar_of, feed_calendar, normal_prefix
from tapespark.sources.feed import list_feed_files, path_exists, read_feed_text

_LEDGER_SCHEMA = T.StructType([
    *OUTCOME_SCHEMA.fields,
    T.StructField("rejected", T.LongType(), True),
    T.StructField("recorded", T.LongType(), True),
    T.StructField("run", T.StringType(), True),
])

#: Rows of a day as stored: trades, and payloads with the reason why they are none.
_STORED_SCHEMA = T.StructType([
    *TRADE_SCHEMA.fields,
    T.StructField("payload", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("run", T.StringType(), True),
])


def trades_root(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/trades"


def outcomes_root(out_root: str) -> str:
    return f"{out_root.rstrip('/')}/outcomes"


def read_outcomes(spark: SparkSession, out_root: str) -> DataFrame:
    """Outcomes of all runs so far, with the run each belongs to and when it was recorded."""
    return spark.read.schema(_LEDGER_SCHEMA).parquet(outcomes_root(out_root))


def _record(outcomes: DataFrame, out_root: str) -> None:
    """Add outcomes to those on record.

    Runs add up: a finished date must stay on record when a later run skips it.
    """
    outcomes.write.mode("append").partitionBy("run").parquet(outcomes_root(out_root))


def completed_dates(spark: SparkSession, out_root: str) -> DataFrame:
    """Dates which some run has finished.

    Outcomes are written after the trades are committed.  A date whose run died in
    between counts as unfinished and is loaded by the next run.
    """
    done = read_outcomes(spark, out_root).where(F.col("status") == SUCCESS)
    return done.select("date_str").distinct()


def counting_runs(spark: SparkSession, out_root: str) -> DataFrame:
    """(date, run, finished): the run that counts for each date that was ever loaded.

    It is the last that finished the date, or if none did the last that tried.
    """
    loaded = read_outcomes(spark, out_root).where(F.col("rejected").isNotNull())
    finished = F.col("status") == SUCCESS
    last = Window.partitionBy("date_str").orderBy(finished.desc(), F.col("recorded").desc(), F.col("run").desc())
    return loaded.withColumn("place", F.row_number().over(last)).where("place = 1").select(
        F.to_date("date_str", "yyyyMMdd").alias("date"), "run", finished.alias("finished")
    )


def _stored(spark: SparkSession, out_root: str, runs: DataFrame) -> DataFrame:
    """Rows of the runs that count; none where nothing was stored yet."""
    schema, root = with_date(_STORED_SCHEMA), trades_root(out_root)
    if not path_exists(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root).join(runs.select("date", "run"), ["date", "run"], "left_semi")


def read_trades(spark: SparkSession, out_root: str) -> DataFrame:
    """Stored trades of the dates on record as finished; what a died run left is not seen."""
    runs = counting_runs(spark, out_root).where("finished")
    return _stored(spark, out_root, runs).where("reason is null").select(*TRADE_SCHEMA.names, "date")


def read_rejects(spark: SparkSession, out_root: str) -> DataFrame:
    """Malformed payloads with the reason for each and the date of the feed they came in.

    Of every date those of the run that counts: a date that is loaded again brings its own.
    """
    runs = counting_runs(spark, out_root)
    return _stored(spark, out_root, runs).where("reason is not null").select("payload", "reason", "date")


def _load(spark: SparkSession, path: str, day: dt.date, out_root: str, run: str) -> tuple[int, int]:
    """Add one day's trades and rejects to its folder in one pass; how many there are."""
    parsed = parse_payload(read_feed_text(spark, [path]).select("value"))
    bad = F.col("reason").isNotNull()
    seen = Observation()
    counted = parsed.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    # A reject keeps its payload only, a trade its fields only.
    rows = counted.select(
        *(F.when(~bad, F.col(name)).alias(name) for name in TRADE_SCHEMA.names),
        F.when(bad, F.col("payload")).alias("payload"), "reason", F.lit(run).alias("run"),
    )
    rows.write.mode("append").parquet(f"{trades_root(out_root)}/date={day}")
    told = seen.get
    return told["good"], told["bad"]


def _try_load(spark: SparkSession, path: str, day: dt.date, out_root: str, run: str) -> tuple[int, int, str | None]:
    # Under the fair scheduler every day gets its share of the slots.
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"day-{day}")
    try:
        return *_load(spark, path, day, out_root, run), None
    except (PySparkException, Py4JJavaError) as failure:
        if "FAILED_READ_FILE" not in str(failure):
            raise
        return 0, 0, f"unreadable file {path}"


def slots(spark: SparkSession) -> int:
    """Tasks that the cluster runs at a time, as far as the scheduler knows."""
    return max(1, spark.sparkContext.defaultParallelism)


def _load_all(spark: SparkSession, inputs: dict[str, str], out_root: str, run: str, at_once: int) -> list[tuple]:
    """(date_str, rows, rejected, error) of every input, ``at_once`` days at a time.

    Every day is a write of its own with its own marker and counts, so an unreadable file
    costs its own day only.
    """
    if not inputs:
        return []
    load = inheritable_thread_target(spark)(_try_load)
    with ThreadPoolExecutor(min(at_once, len(inputs))) as pool:
        runs = {
            day: pool.submit(load, spark, path, as_date(day), out_root, run) for day, path in inputs.items()
        }
        return [(day, *run.result()) for day, run in runs.items()]


def _ingest(
    spark: SparkSession, calendar: DataFrame, files: DataFrame, out_root: str, name: str,
    at_once: int | None, again: bool,
) -> DataFrame:
    _record(spark.createDataFrame([], _LEDGER_SCHEMA), out_root)
    done = completed_dates(spark, out_root)
    if again:
        done = done.limit(0)
    due = present(pending(calendar, done), files).select("date_str", "input_path")
    # One path per weekday of the calendar.
    inputs = {row.date_str: row.input_path for row in due.collect()}

    run = f"{name}-{uuid.uuid4().hex}"
    loaded = spark.createDataFrame(
        _load_all(spark, inputs, out_root, run, at_once or slots(spark)),
        "date_str string, rows long, rejected long, error string",
    )
    result = outcomes(
        calendar, done, files, loaded.select("date_str", "rows"),
        loaded.select("date_str", "error").where("error is not null"),
    ).join(loaded.select("date_str", "rejected"), "date_str", "left")

    _record(result.withColumns({"recorded": F.lit(time.time_ns() // 1000), "run": F.lit(run)}), out_root)
    ours = read_outcomes(spark, out_root).where(F.col("run") == run).drop("run", "recorded")
    write_summary(ours, f"{out_root.rstrip('/')}/summary_{name}.json")
    return ours


def ingest_range(
    spark: SparkSession,
    start: dt.date | str,
    end: dt.date | str,
    raw_prefix: str,
    out_root: str,
    at_once: int | None = None,
    again: bool = False,
) -> DataFrame:
    """Ingest the feed files of all weekdays in [start, end]; the outcome of each date.

    Trades and malformed payloads land in ``<out_root>/trades/date=…``, outcomes in
    ``<out_root>/outcomes`` and the summary in ``<out_root>/summary_<start>_<end>.json``;
    ``read_trades`` and ``read_rejects`` tell what counts.  Missing, empty and unreadable files
    fail their own date only.  ``rejected`` counts a date's malformed payloads.

    ``at_once``: days loaded at the same time, as many as the cluster has slots if unset, as a
    day's gzip is one task.  Finished dates are skipped, or with ``again`` loaded once more:
    readers see the old rows until the new ones are on record.
    """
    first, last = as_date(start), as_date(end)
    raw_prefix = normal_prefix(raw_prefix)
    calendar = feed_calendar(spark, first, last, raw_prefix, f"{trades_root(out_root)}/")
    files = list_feed_files(spark, raw_prefix)
    return _ingest(spark, calendar, files, out_root, f"{first:%Y%m%d}_{last:%Y%m%d}", at_once, again)


def ingest_day(spark: SparkSession, path: str, out_root: str, again: bool = False) -> DataFrame:
    """Ingest one feed file, the day being that in its name; its outcome.

    The file is taken as it is named, whatever protocol its name tells.
    """
    _, stem, name = path.rpartition(FEED_STEM)
    if not stem:
        raise ValueError(f"no trading day in the file name: {path}")
    day = as_date(name.split("_")[0])
    days = spark.range(1).select(F.lit(day).alias("trade_date"))
    calendar = calendar_of(days, "", f"{trades_root(out_root)}/").withColumns(
        {"file_name": F.lit(f"{stem}{name}"), "input_path": F.lit(path)}
    )
    there = [(f"{stem}{name}",)] if path_exists(spark, path) else []
    files = spark.createDataFrame(there, "file_name string")
    return _ingest(spark, calendar, files, out_root, f"{day:%Y%m%d}_{day:%Y%m%d}", None, again)
