"""Connected components of a graph that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.session import scratch_path

LABELS = "node long, label long"
#: A key is frequent with more than FEW rows and more than one in MOST of all, so at most MOST are.
FEW, MOST = 500, 1000


def frequent(rows: DataFrame, key: str) -> list[int]:
    """The keys that so many rows hold that one task should not take all of them; at most MOST."""
    bound = max(FEW, rows.count() // MOST)
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    return [r[key] for r in counts.where(F.col("count") > bound).select(key).collect()]


def join_unique(rows: DataFrame, facts: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` (a stored table) with what ``facts`` tell of their ``key``, which is unique in them.

    Rows of frequent keys stay where they are: the facts about those few keys are sent to them.
    """
    hot = frequent(rows, key)
    if not hot:
        return rows.join(facts, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    sent = rows.where(is_hot).join(F.broadcast(facts.where(is_hot)), key, how)
    return sent.unionByName(rows.where(~is_hot).join(facts.where(~is_hot), key, how))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``links``: label is the smallest node it reaches.

    Every round, each node takes the smallest label beside it and then that label's own
    label.  Rounds are written to the shared folder, which cuts the lineage.  Null ends and
    loops say nothing; no links give no nodes.
    """
    spark = links.sparkSession
    root = scratch_path(spark, "components")
    ends = links.where(f"{a} is not null and {b} is not null")
    both = ends.select(F.col(a).alias("node"), F.col(b).alias("other")).union(
        ends.select(F.col(b).alias("node"), F.col(a).alias("other"))
    )
    both.distinct().write.parquet(f"{root}/edges")
    edges = spark.read.schema("node long, other long").parquet(f"{root}/edges")
    edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")).write.parquet(
        f"{root}/labels-0"
    )
    turn = 0
    while True:
        labels = spark.read.schema(LABELS).parquet(f"{root}/labels-{turn}")
        beside = (
            join_unique(edges, labels.withColumnRenamed("node", "other"), "other", "inner")
            .groupBy("node").agg(F.min("label").alias("beside"))
        )
        labels.join(beside, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "beside").alias("label")
        ).write.parquet(f"{root}/nearer-{turn}")
        nearer = spark.read.schema("node long, before long, label long").parquet(f"{root}/nearer-{turn}")
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        turn += 1
        join_unique(nearer, further, "label").select(
            "node", "before", F.least("label", "further").alias("label")
        ).write.parquet(f"{root}/labels-{turn}")
        after = spark.read.schema(LABELS + ", before long").parquet(f"{root}/labels-{turn}")
        if not after.where("label <> before").take(1):
            return after.select("node", "label")
