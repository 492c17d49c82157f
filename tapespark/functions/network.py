"""The fraud network: any number of inputs, one hidden ReLU layer, a sigmoid output.

The numpy helpers see one Arrow batch at a time, inside Spark tasks.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tasks carry this module's code with them: executors need numpy and pyarrow, not the
# package itself.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

INPUTS = 10
HIDDEN = 32

# Fixed value: logarithms in the loss are not taken below this.
LOG_FLOOR = -100.0


@dataclass(frozen=True)
class Weights:
    """``w1`` is hidden × inputs, ``b1`` and ``w2`` one per hidden unit, ``b2`` one number."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    @property
    def inputs(self) -> int:
        return self.w1.shape[1]

    @classmethod
    def random(cls, seed: int, inputs: int = INPUTS, hidden: int = HIDDEN) -> Weights:
        """Uniform within ±1/√(inputs of the layer), weights and biases alike."""
        draws = np.random.default_rng(seed)
        near, far = inputs**-0.5, hidden**-0.5
        return cls(
            draws.uniform(-near, near, (hidden, inputs)),
            draws.uniform(-near, near, hidden),
            draws.uniform(-far, far, hidden),
            float(draws.uniform(-far, far)),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w1.ravel(), self.b1, self.w2, [self.b2]])

    @classmethod
    def from_flat(cls, values: np.ndarray, inputs: int = INPUTS) -> Weights:
        hidden = (len(values) - 1) // (inputs + 2)
        w1, b1, w2, b2 = np.split(values, np.cumsum([hidden * inputs, hidden, hidden]))
        return cls(w1.reshape(hidden, inputs), b1, w2, float(b2[0]))


def forward(x: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Hidden activations and scores of a batch of rows."""
    hidden = np.maximum(x @ weights.w1.T + weights.b1, 0.0)
    with np.errstate(over="ignore"):
        return hidden, 1.0 / (1.0 + np.exp(-(hidden @ weights.w2 + weights.b2)))


def batch_sums(x: np.ndarray, y: np.ndarray, weights: Weights) -> np.ndarray:
    """Sums over a batch: the gradient in flat order, then the loss."""
    total = np.zeros(weights.flat().size + 1)
    # Pieces of this size stay in the processor's cache.
    for at in range(0, len(x), 2048):
        total += _piece_sums(x[at : at + 2048], y[at : at + 2048], weights)
    return total


def _piece_sums(x: np.ndarray, y: np.ndarray, weights: Weights) -> np.ndarray:
    hidden, p = forward(x, weights)
    with np.errstate(divide="ignore"):
        loss = -(
            y * np.maximum(np.log(p), LOG_FLOOR)
            + (1.0 - y) * np.maximum(np.log1p(-p), LOG_FLOOR)
        )
    slope = p - y
    active = (hidden > 0.0) * slope[:, None]
    return np.concatenate([
        ((active.T @ x) * weights.w2[:, None]).ravel(), active.sum(axis=0) * weights.w2,
        hidden.T @ slope, [slope.sum(), loss.sum()],
    ])


def matrix_of(features: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows × width numbers of a list column, and which rows are complete."""
    complete = pc.fill_null(pc.equal(pc.list_value_length(features), width), False)
    values = features.filter(complete).flatten()
    kept = complete.to_numpy(zero_copy_only=False)
    if values.null_count:
        whole = ~values.is_null().to_numpy(zero_copy_only=False).reshape(-1, width).any(axis=1)
        kept[kept] = whole
        values = values.fill_null(0.0)
        return values.to_numpy().reshape(-1, width)[whole], kept
    return values.to_numpy().reshape(-1, width), kept


def network_score(features: Column, weights: Weights) -> Column:
    """Score of an ``array<double>``; NULL unless it holds one number per input.

    One matrix product per Arrow batch.  The same net written out as Column arithmetic
    or with higher-order functions stays in the JVM but runs several times slower: the
    """

    @F.arrow_udf("double")
    def scored(batch: pa.Array) -> pa.Array:
        x, kept = matrix_of(batch, weights.inputs)
        result = np.zeros(len(batch))
        result[kept] = forward(x, weights)[1]
        return pa.array(result, mask=~kept)

    return scored(features)
