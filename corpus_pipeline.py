"""A corpus made ready for training, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, which are
written as Parquet and read again for the next.  All but the last return the columns of
documents; the last adds the pieces of each text.

Nulls: a null text counts as an empty one; rows without doc_id go through all stages, as
nothing can stand for them and no overlap names them.  Ties and repeated rows: equal texts share their fate,
and of the rows of one near-duplicate group the smallest doc_id stays, once.  Very long texts
are taken whole.  Empty tables give empty results.  Columns beyond those of documents are
carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapespark.llm import decontaminate, jaccard, pieces, pii, quality
from tapespark.llm.common import table
from tapespark.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and n_chars of the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, their number, and whether they decode to the text."""
    return (
        pieces.encode(docs, decoded="decoded")
        .withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("same", F.col("decoded") == F.coalesce("text", F.lit("")))
        .drop("decoded")
    )


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("PII", hide_personal_data),
    ("SentencePiece encoding and decoding", to_pieces),
]

#: The trees, the tokenizer and the components are not expressed in SQL; tests hold the rows
#: against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table documents."""
    root = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        schema = done.schema
        done.write.parquet(f"{root}/{at}")
        docs = spark.read.schema(schema).parquet(f"{root}/{at}")
    return docs
