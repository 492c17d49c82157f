"""CSV, Parquet and JSON writes.

Spark's committer names the parts and leaves ``_SUCCESS`` behind, so a write which
died half way is never taken for a finished one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tapespark.operators.outcomes import summary_document

# Spark's default drops the microseconds.
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (
        df.write.mode(mode)
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .csv(path, header=True, timestampFormat=CSV_TIMESTAMP)
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write Parquet and return the rows written, counted on the way.

    The count sits on top of the plan, hence in the writing stage, where Spark takes
    each partition once even if tasks are retried.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]


def write_daily(
    df: DataFrame, root: str, clustered: bool = False, rows_per_file: int = 0
) -> None:
    """One folder per ``date``; only the dates present in ``df`` are replaced.

    Rows are brought together by date with a rebalance: adaptive execution joins small
    dates into one task and splits a date which outgrows a task, so neither many tiny
    files nor one overlong task results.  ``clustered=True`` skips that shuffle, for
    input whose tasks hold few dates each, such as one feed file per day.
    ``rows_per_file`` bounds the files; 0 sets no bound.
    """
    rows = df if clustered else df.hint("rebalance", F.col("date"))
    (
        rows.write.mode("overwrite")
        .partitionBy("date")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(root)
    )


def write_summary(outcomes: DataFrame, path: str) -> None:
    """The run summary as one JSON document of success, failed and skipped dates."""
    summary_document(outcomes).write.mode("overwrite").json(path)
