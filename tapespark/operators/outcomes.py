"""Which dates to ingest, and what became of each.

Every table here has one row per trading day of a calendar.  No join is hinted: Spark
broadcasts a side when its own size check allows and shuffles both otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"


def pending(calendar: DataFrame, completed: DataFrame) -> DataFrame:
    """Calendar rows whose date is not complete yet."""
    return calendar.join(completed.select("date_str"), "date_str", "left_anti")


def skipped(calendar: DataFrame, completed: DataFrame) -> DataFrame:
    """Calendar rows whose date is complete."""
    return calendar.join(completed.select("date_str"), "date_str", "left_semi")


def missing(calendar: DataFrame, files: DataFrame) -> DataFrame:
    """Calendar rows whose input file is absent."""
    return calendar.join(files.select("file_name"), "file_name", "left_anti")


def present(calendar: DataFrame, files: DataFrame) -> DataFrame:
    """Calendar rows whose input file is there."""
    return calendar.join(files.select("file_name"), "file_name", "left_semi")


def outcomes(
    calendar: DataFrame,
    completed: DataFrame,
    files: DataFrame,
    counts: DataFrame,
    errors: DataFrame | None = None,
) -> DataFrame:
    """One outcome per calendar date.

    Completion is looked at first, so a complete date whose input has gone is skipped.
    ``counts`` holds (date_str, rows), ``errors`` (date_str, error) of unreadable files;
    each has at most one row per date.
    """
    done = completed.select("date_str").distinct().withColumn("is_done", F.lit(True))
    there = files.select("file_name").distinct().withColumn("is_there", F.lit(True))
    joined = (
        calendar.join(done, "date_str", "left")
        .join(there, "file_name", "left")
        .join(counts.select("date_str", F.col("rows").alias("counted")), "date_str", "left")
    )
    if errors is None:
        joined = joined.withColumn("error", F.lit(None).cast("string"))
    else:
        joined = joined.join(errors.select("date_str", "error"), "date_str", "left")

    def ladder(done: object, missing: object, broken: object, empty: object, good: object) -> Column:
        return (
            F.when(F.col("is_done"), done)
            .when(F.col("is_there").isNull(), missing)
            .when(F.col("error").isNotNull(), broken)
            .when(F.coalesce("counted", F.lit(0)) == 0, empty)
            .otherwise(good)
        )

    none = F.lit(None)
    return joined.select(
        "date_str",
        ladder(SKIPPED, FAILED, FAILED, FAILED, F.lit(SUCCESS)).alias("status"),
        ladder(none, none, none, none, F.col("counted")).cast("bigint").alias("rows"),
        ladder(
            F.lit("already exists"), F.lit("missing file"), F.col("error"),
            F.lit("no trade_report rows"), none,
        ).cast("string").alias("reason"),
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Per status: dates, rows and the sorted entries (date, rows, reason).

    A status lists at most the calendar's dates, a few hundred per year.
    """
    entry = F.struct(F.col("date_str").alias("date"), "rows", "reason")
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("dates"),
        F.sum("rows").alias("total_rows"),
        F.sort_array(F.collect_list(entry)).alias("entries"),
    )


def summary_document(outcomes: DataFrame) -> DataFrame:
    """One row with the arrays ``success``, ``failed`` and ``skipped``."""

    def bucket(status: str, detail: str) -> Column:
        entry = F.struct(F.col("date_str").alias("date"), F.col(detail))
        return F.sort_array(F.collect_list(F.when(F.col("status") == status, entry)))

    return outcomes.agg(
        bucket(SUCCESS, "rows").alias("success"),
        bucket(FAILED, "reason").alias("failed"),
        bucket(SKIPPED, "reason").alias("skipped"),
    )
