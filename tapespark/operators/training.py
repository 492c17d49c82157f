"""Fitting the fraud network on the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapespark.functions.network import HIDDEN, INPUTS, Weights, batch_sums, matrix_of
from tapespark.schemas import WEIGHTS_SCHEMA

# Groups of tasks whose sums are added up together.
GROUPS = 8
# The optimiser's decay rates and the guard against division by zero.
DECAY_MEAN, DECAY_SQUARE, TINY = 0.9, 0.999, 1e-8


def gradient(df: DataFrame, features_col: str, label_col: str, weights: Weights) -> DataFrame:
    """(slot, mean): mean gradient per weight in flat order; the last slot is the mean loss.

    Each task adds up its own rows and emits one number per slot, so what is shuffled
    depends on the number of tasks, not of rows.  Rows without a label or without a
    complete feature array do not count.
    """
    rows = df.select(
        F.col(features_col).cast("array<double>").alias("features"),
        F.col(label_col).cast("double").alias("label"),
    ).where("label is not null")

    def task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(len(weights.flat()) + 1), 0
        for batch in batches:
            x, kept = matrix_of(batch.column("features"), weights.inputs)
            total += batch_sums(x, batch.column("label").to_numpy()[kept], weights)
            count += len(x)
        if count:
            yield pa.RecordBatch.from_pydict({"parts": [total.tolist()], "rows": [count]})

    def group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, 0
        for batch in batches:
            for parts, rows_of_task in zip(batch.column("parts"), batch.column("rows").to_pylist()):
                values = parts.values.to_numpy()
                total = values.copy() if total is None else total + values
                count += rows_of_task
        if count:
            yield pa.RecordBatch.from_pydict({"parts": [total.tolist()], "rows": [count]})

    # Every task sends one array; groups of tasks add theirs up before the slots are told apart.
    sums = rows.mapInArrow(task_sums, "parts array<double>, rows bigint")
    groups = sums.repartition(GROUPS).mapInArrow(group_sums, "parts array<double>, rows bigint")
    slots = groups.select("rows", F.posexplode("parts").alias("slot", "part"))
    return slots.groupBy("slot").agg((F.sum("part") / F.sum("rows")).alias("mean"))


def fit(
    df: DataFrame,
    features_col: str,
    label_col: str,
    epochs: int = 10,
    lr: float = 1e-3,
    seed: int = 0,
    start: Weights | None = None,
    inputs: int = INPUTS,
    hidden: int = HIDDEN,
) -> tuple[Weights, list[float]]:
    """Full-batch binary cross-entropy with Adam; the weights and the loss per epoch.

    Every epoch is one Spark job over all rows.  Only the mean gradient reaches the
    driver, which makes the step; it has one number per weight, whatever the data's size.
    ``df`` is scanned once per epoch: pass a stored table, not a costly plan.
    """
    weights = start or Weights.random(seed, inputs, hidden)
    values = weights.flat()
    mean, square = np.zeros_like(values), np.zeros_like(values)
    losses = []
    for epoch in range(1, epochs + 1):
        means = sorted(gradient(df, features_col, label_col, weights).collect())
        if not means:
            raise ValueError("no row has both a label and complete features")
        *slope, loss = (row.mean for row in means)
        losses.append(loss)
        slope = np.array(slope)
        mean = DECAY_MEAN * mean + (1 - DECAY_MEAN) * slope
        square = DECAY_SQUARE * square + (1 - DECAY_SQUARE) * slope**2
        unbiased_mean = mean / (1 - DECAY_MEAN**epoch)
        unbiased_square = square / (1 - DECAY_SQUARE**epoch)
        values = values - lr * unbiased_mean / (np.sqrt(unbiased_square) + TINY)
        weights = Weights.from_flat(values, weights.inputs)
    return weights, losses


def save_weights(spark: SparkSession, weights: Weights, path: str) -> None:
    """One row per layer array: name, shape and values."""
    layers = {"w1": weights.w1, "b1": weights.b1, "w2": weights.w2, "b2": np.array([weights.b2])}
    rows = [
        (name, values.shape[0], values.shape[1] if values.ndim > 1 else 1, values.ravel().tolist())
        for name, values in layers.items()
    ]
    spark.createDataFrame(rows, WEIGHTS_SCHEMA).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> Weights:
    layers = {row.layer: row for row in spark.read.schema(WEIGHTS_SCHEMA).parquet(path).collect()}
    w1 = layers["w1"]
    return Weights(
        np.array(w1["values"]).reshape(w1["rows"], w1["cols"]),
        np.array(layers["b1"]["values"]),
        np.array(layers["w2"]["values"]),
        float(layers["b2"]["values"][0]),
    )
