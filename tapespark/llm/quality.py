"""Quality classifier: histogram gradient-boosted trees over statistics of each text.

Spark computes the statistics of all documents in one pass and keeps them; the trees are
fitted on a bounded sample of labelled rows (``SAMPLE``) and flattened into arrays, with which
whole batches are walked level by level in numpy.

Nulls count as empty texts, whose statistics are all zero and which get a score like any
other; very long texts are measured whole.  Only the text is read for a score, whatever other
columns there are.  Repeated rows are scored alike; labels repeated for one document count as
their largest; empty tables give empty results.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.llm.common import held_out, tidy
from tapespark.session import scratch_path

#: Most labelled rows that the trees are fitted on, taken by the hash of their id.
SAMPLE = 20_000
THRESHOLD = 0.5

STATISTICS = (
    "chars", "words", "mean_word", "long_words", "short_words", "upper", "digits", "symbols",
    "inner_punctuation", "spaces", "lines", "mean_line", "distinct_words", "top_word",
    "repeated_neighbours", "repeated_pairs", "repeated_lines", "ended_lines", "commas",
    "capital_words", "bare_symbols", "symbol_words", "compression", "non_ascii",
)
#: Bytes of a text that are compressed at a time.
CHUNK = 1 << 16

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_COMMON = np.zeros(256, dtype=bool)
_COMMON[list(b".,;:'\"-!?()")] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[33:127] = True
_SYMBOL[48:58] = _SYMBOL[65:91] = _SYMBOL[97:123] = False


def _log(x: float) -> float:
    return float(np.log1p(x))


def statistics(text: str | None) -> list[float]:
    """The numbers named in STATISTICS, over the whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n, total = len(words), len(data)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    seen = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    pairs = set(zip(words, words[1:]))
    symbols = counts[_SYMBOL].sum()
    common = counts[_COMMON].sum()
    bare = [w for w in words if not any(_ALNUM[b] for b in w[:1] + w[-1:])]
    packed = sum(
        len(zlib.compress(data[k:k + CHUNK], 1)) for k in range(0, total, CHUNK)
    )
    return [
        _log(total), _log(n), float(lengths.mean()), float((lengths > 12).mean()),
        float((lengths < 3).mean()), counts[_UPPER].sum() / total, counts[_DIGIT].sum() / total,
        (symbols - common) / total, common / total, counts[_SPACE].sum() / total,
        len(lines) / n, _log(total / len(lines)), len(seen) / n, max(seen.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(pairs) / max(1, n - 1),
        1 - len(set(lines)) / len(lines),
        sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines),
        counts[44] / n, sum(_UPPER[w[0]] for w in words) / n, len(bare) / n,
        sum(w[-1] in b"#$%&*!|" for w in words) / n, packed / total,
        counts[128:].sum() / total,
    ]


_ALNUM = ~_SYMBOL


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        values = [statistics(texts[k].as_py()) for k in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(values, pa.list_(pa.float64()))],
            names=["doc_id", "stats"],
        )


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array of double) for every row."""
    return docs.select("doc_id", "text").mapInArrow(_measured, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Trees:
    """Complete binary trees in arrays: node k has the children 2k+1 and 2k+2."""

    column: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of ``x``, all trees walked level by level at once."""
        trees = np.arange(len(self.column))[None, :]
        rows = np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(self.column)), dtype=np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.column[trees, at]] > self.cut[trees, at])
        total = self.base + self.value[trees, at - (2 ** self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cut points per column: midpoints between neighbouring quantiles."""
    # One mark fewer than intervals, so that every column has at most ``bins`` bins.
    marks = np.quantile(x, np.linspace(0, 1, bins), axis=0, method="lower")
    found = []
    for k in range(x.shape[1]):
        values = np.unique(marks[:, k])
        found.append((values[1:] + values[:-1]) / 2)
    return found


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 1.0, least: int = 5,
) -> Trees:
    """Boosted trees for 0/1 labels by histograms of gradients.

    Without rows of both labels the trees are empty and every score is the share of ones
    (one half without rows).
    """
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)),
                     np.zeros((0, leaves)), base, depth)
    edges = _edges(x, bins)
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    total = np.full(len(y), base)
    columns, cuts, values = [], [], []
    offsets = np.arange(x.shape[1]) * bins
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        column, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            keys = ((node - first)[:, None] * x.shape[1] * bins + offsets + binned).ravel()
            size = width * x.shape[1] * bins
            shape = (width, x.shape[1], bins)
            sums = [
                np.bincount(keys, np.repeat(v, x.shape[1]), size).reshape(shape).cumsum(axis=2)
                for v in (gradient, weight, np.ones(len(y)))
            ]
            (gl, hl, nl), (g, h, n) = sums, (s[:, :1, -1:] for s in sums)
            gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
            gain[(nl < least) | (n - nl < least)] = -np.inf
            for k, e in enumerate(edges):
                gain[:, k, len(e):] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                if gain[k].ravel()[best[k]] > 1e-9:
                    column[first + k] = best[k] // bins
                    cut[first + k] = edges[best[k] // bins][best[k] % bins]
            node = 2 * node + 1 + (x[np.arange(len(y)), column[node]] > cut[node])
        leaf = node - inner
        g = np.bincount(leaf, gradient, leaves)
        h = np.bincount(leaf, weight, leaves)
        value = rate * g / (h + ridge)
        total += value[leaf]
        columns.append(column)
        cuts.append(cut)
        values.append(value)
    return Trees(np.array(columns), np.array(cuts), np.array(values), base, depth)


def _scored(trees: Trees):
    def run(batches):
        for batch in batches:
            stats = batch.column("stats")
            x = np.array(stats.to_pylist(), dtype=float).reshape(batch.num_rows, len(STATISTICS))
            scores = trees.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
            )

    return run


def learn(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from the measured rows whose label may be learnt from, at most ``sample`` of them."""
    known = (
        labels.where("quality is not null and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = stats.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    rows = rows.orderBy("doc_id").limit(sample).collect()
    x = np.array([r["stats"] for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r["quality"] for r in rows], dtype=float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    spark = docs.sparkSession
    kept = scratch_path(spark, "quality")
    measure(docs).write.parquet(kept)
    stats = spark.read.schema("doc_id long, stats array<double>").parquet(kept)
    scored = stats.mapInArrow(_scored(learn(stats, labels)), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _accepting(trees: Trees, threshold: float):
    def run(batches):
        for batch in batches:
            x = np.array(
                [statistics(batch.column("text")[k].as_py()) for k in range(batch.num_rows)],
                dtype=float,
            ).reshape(batch.num_rows, len(STATISTICS))
            yield batch.filter(pa.array(trees.score(x) >= threshold))

    return run


def accept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns.

    The trees are fitted from the sample's own statistics, so only its texts are read twice.
    """
    known = labels.where("quality is not null and doc_id is not null").select("doc_id")
    known = known.where(~held_out(F.col("doc_id"))).distinct()
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left_semi")
    trees = learn(measure(sample), labels)
    return docs.mapInArrow(tidy(_accepting(trees, threshold)), docs.schema)
