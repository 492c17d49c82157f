import numpy as np
import pytest

from tapespark.functions.network import Weights, forward
from tapespark.operators.scoring import score
from tapespark.operators.training import fit, gradient, load_weights, save_weights


def loss_of(x, y, weights):
    p = forward(x, weights)[1]
    return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))


@pytest.fixture(scope="module")
def sample():
    draws = np.random.default_rng(3)
    return draws.normal(size=(200, 10)), draws.integers(0, 2, 200).astype(float)


@pytest.fixture
def table(spark, sample):
    x, y = sample
    rows = [(row.tolist(), float(label)) for row, label in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(5)


def test_gradient_against_differences(table, sample):
    x, y = sample
    weights = Weights.random(1)
    got = {r.slot: r.mean for r in gradient(table, "features", "label", weights).collect()}
    flat = weights.flat()
    assert len(got) == len(flat) + 1
    assert got[len(flat)] == pytest.approx(loss_of(x, y, weights), abs=1e-12)
    for slot in (0, 7, 123, 319, 325, 360, 384):
        nudge = np.zeros_like(flat)
        nudge[slot] = 1e-6
        up, down = (loss_of(x, y, Weights.from_flat(flat + s * nudge)) for s in (1, -1))
        assert got[slot] == pytest.approx((up - down) / 2e-6, abs=1e-7)


def test_fit_against_one_process(table, sample):
    x, y = sample
    weights = Weights.random(0)
    flat = weights.flat()
    mean = square = np.zeros_like(flat)
    expected = []
    for epoch in range(1, 11):
        w = Weights.from_flat(flat)
        hidden, p = forward(x, w)
        expected.append(loss_of(x, y, w))
        slope = (p - y)[:, None] / len(y)
        back = slope * w.w2 * (hidden > 0)
        g = np.concatenate([(back.T @ x).ravel(), back.sum(0), (hidden * slope).sum(0), slope.sum(0)])
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        flat = flat - 0.001 * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
    fitted, losses = fit(table, "features", "label", seed=0)
    assert losses == pytest.approx(expected, abs=1e-12)
    assert fitted.flat() == pytest.approx(flat, abs=1e-9)
    assert losses[-1] < losses[0]


def test_incomplete_rows_do_not_count(spark, table, sample):
    extra = spark.createDataFrame(
        [(None, 1.0), ([1.0], 0.0), ([1.0] * 9 + [None], 1.0), ([1.0] * 10, None)], table.schema
    )
    weights = Weights.random(1)
    plain = {r.slot: r.mean for r in gradient(table, "features", "label", weights).collect()}
    mixed = {r.slot: r.mean for r in gradient(table.union(extra), "features", "label", weights).collect()}
    assert plain == pytest.approx(mixed, abs=1e-12)
    with pytest.raises(ValueError):
        fit(extra, "features", "label", epochs=1)


def test_scores(spark, sample):
    x, _ = sample
    weights = Weights.random(1)
    rows = [(i, row.tolist()) for i, row in enumerate(x)]
    rows += [(1000, None), (1001, [1.0]), (1002, [None] * 10), (1003, [1e6] * 10), (1004, [-1e6] * 10)]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    got = {r.id: r.score for r in score(df, "features", weights).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(list(forward(x, weights)[1]), abs=1e-12)
    assert got[1000] is got[1001] is got[1002] is None
    assert all(0.0 <= got[i] <= 1.0 for i in (1003, 1004))


def test_weights_are_stored(spark, tmp_path):
    weights = Weights.random(5, inputs=4, hidden=3)
    save_weights(spark, weights, str(tmp_path / "w"))
    loaded = load_weights(spark, str(tmp_path / "w"))
    assert loaded.w1.shape == (3, 4)
    assert np.array_equal(loaded.flat(), weights.flat())
