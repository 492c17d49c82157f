"""The feed calendar: which file belongs to which trading day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapespark.functions.feed import feed_file_name, protocol_version

# weekday() counts from Monday = 0.
SATURDAY = 5


def trading_days(bounds: DataFrame) -> DataFrame:
    """Weekdays from ``first_day`` to ``last_day``, both included, of each row."""
    spanned = bounds.where(F.col("first_day") <= F.col("last_day"))
    days = spanned.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("trade_date")
    )
    return days.where(F.weekday("trade_date") < SATURDAY)


def calendar_of(days: DataFrame, raw_prefix: str, out_prefix: str) -> DataFrame:
    """Version, file name, input path and output path of each ``trade_date``."""
    date_str = F.col("date_str")
    return (
        days.select("trade_date", F.date_format("trade_date", "yyyyMMdd").alias("date_str"))
        .select(
            "trade_date",
            "date_str",
            protocol_version(date_str).alias("version"),
            feed_file_name(date_str).alias("file_name"),
        )
        .select(
            "*",
            F.concat(F.lit(raw_prefix), "file_name").alias("input_path"),
            F.concat(F.lit(out_prefix), F.lit("date="), F.col("trade_date").cast("string")).alias("output_path"),
        )
    )


def normal_prefix(prefix: str) -> str:
    """A folder's prefix: trimmed, with one slash at its end.

    A prefix that ends in ``=`` names the folders of a partitioned dataset and stays.
    """
    prefix = prefix.strip()
    return prefix if not prefix or prefix.endswith("=") else f"{prefix.rstrip('/')}/"


def as_date(value: dt.date | str) -> dt.date:
    """A date from ``yyyyMMdd`` text, or the date itself."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.datetime.strptime(value, "%Y%m%d").date()


def feed_calendar(
    spark: SparkSession,
    start: dt.date | str,
    end: dt.date | str,
    raw_prefix: str,
    out_prefix: str,
) -> DataFrame:
    """One row per weekday of [start, end]; an inverted range gives no rows."""
    first, last = as_date(start), as_date(end)
    days = (
        spark.range(max((last - first).days + 1, 0))
        .select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("trade_date"))
        .where(F.weekday("trade_date") < SATURDAY)
    )
    return calendar_of(days, raw_prefix, out_prefix)
