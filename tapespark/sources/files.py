"""CSV and Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapespark.functions.casting import conform, safe_cast
from tapespark.operators.combine import union_all
from tapespark.schemas import TRADE_SCHEMA, with_date

#: Files whose first lines are read at the same time.
HEADS_AT_ONCE = 16


def read_trades_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = TRADE_SCHEMA,
) -> DataFrame:
    """CSV with a header; ``path`` may be a file, a folder, a glob or a list of them.

    With a schema (the default) the columns are found by header name and converted,
    which reads the data once.  ``schema=None`` infers the types and costs a second
    pass over the files.
    """
    paths = path if isinstance(path, str) else list(path)
    if schema is None:
        return spark.read.csv(paths, header=True, inferSchema=True)
    return conform(spark.read.csv(paths, header=True, enforceSchema=False), schema)


def read_many_csv(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = TRADE_SCHEMA,
) -> DataFrame:
    """Several trade files as one table, matched by column name; absent columns are NULL.

    The first line of every file is read beforehand, and nothing else of it; files with the
    same header are one scan, so the plan is as wide as there are different headers.  Files
    without any line give no rows.
    """
    groups: dict[str, list[str]] = {}
    for path, header in file_headers(spark, paths).items():
        groups.setdefault(header, []).append(path)
    if not groups:
        return spark.createDataFrame([], schema or T.StructType())
    return union_all([read_trades_csv(spark, sorted(groups[header]), schema) for header in sorted(groups)])


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line with text of every file that the paths (files, folders, globs) name.

    Read through Hadoop's file systems by a bounded pool of threads, a buffer of each file.
    """
    files = sorted(spark.read.text(list(paths)).inputFiles())
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        heads = pool.map(inheritable_thread_target(spark)(lambda path: _first_line(spark, path)), files)
        return {path: head for path, head in zip(files, heads) if head is not None}


def _first_line(spark: SparkSession, path: str) -> str | None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        lines = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        )
        while (line := lines.readLine()) is not None:
            if line.removeprefix("\ufeff").strip():
                return line.removeprefix("\ufeff")
        return None
    finally:
        stream.close()


def csv_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = TRADE_SCHEMA) -> DataFrame:
    """Rows of CSV files whose text does not convert: the row as JSON and the columns at fault.

    ``read_trades_csv`` has NULL in those columns.
    """
    raw = spark.read.csv(path if isinstance(path, str) else list(path), header=True, enforceSchema=False)
    bad = F.array_compact(F.array(*[
        F.when(F.col(f.name).isNotNull() & safe_cast(F.col(f.name), f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields if f.name in raw.columns
    ]))
    return raw.select(F.to_json(F.struct("*")).alias("row"), bad.alias("columns")).where(F.size("columns") > 0)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_daily(
    spark: SparkSession, root: str, schema: T.StructType = TRADE_SCHEMA
) -> DataFrame:
    """A dataset kept one folder per day; a filter on ``date`` prunes folders."""
    return spark.read.schema(with_date(schema)).parquet(root)
