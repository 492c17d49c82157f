"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapespark.llm import (
    decontaminate, fingerprints, html, jaccard, licences, packing, pieces, pii, quality, repair, toxicity, urls,
    vectors,
)
from tapespark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notices of every document."""
    return licences.report(table(spark, sf_dir, "documents"))


@query
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, and whether they decode to its text."""
    return pieces.round_trip(table(spark, sf_dir, "documents"))


@query
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url under the standing rules."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.standing_rules(spark))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlaps of every document with the benchmark's items."""
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside its edited text's and its successor's."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and the component that its links lead to."""
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document and the sequences they are packed into."""
    return packing.report(table(spark, sf_dir, "documents"))


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation after planted damage."""
    return repair.report(repair.damage(table(spark, sf_dir, "conversations")))


@query
def op13_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector and what it loses."""
    return vectors.report(table(spark, sf_dir, "embeddings"))


#: SQL counterparts, for the queries that SQL can express.
ORACLES: dict[str, str] = {"op7_urls": urls.ORACLE, "op10_jaccard": jaccard.ORACLE}
