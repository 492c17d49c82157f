"""Feed files holding text payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapespark.functions.feed import FEED_FILE_PATTERN, FEED_STEM, feed_date, valid_text


def read_feed_text(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Payload lines and the path of the file each came from.

    Gzip is undone by the reader, but a gzip file does not split: one file is one task.
    A day may also be a folder which bears the feed file's name and holds any number of
    part files; those are decoded in parallel.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        valid_text(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
    )


def with_file_date(df: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Add ``date``, the trading day in the source file's name."""
    return df.withColumn("date", feed_date(F.col(path_col)))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; no content is read."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def list_feed_files(spark: SparkSession, raw_prefix: str) -> DataFrame:
    """Distinct names of the feed files under a path prefix; no content is read."""
    try:
        found = spark.read.format("binaryFile").load(f"{raw_prefix}{FEED_STEM}*")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file_name string")
    name = F.regexp_extract(F.col("_metadata.file_path"), f".*({FEED_FILE_PATTERN})", 1)
    return found.select(name.alias("file_name")).where("file_name <> ''").distinct()
