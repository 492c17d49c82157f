import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tapespark.llm import queries, vectors

PATH = "/root/testdata/sf0.01"


def brute(rows):
    """{row: (vec_id, code, error, label_error, digest)} by plain comparison with every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    data = np.array([[math.floor(1024 * x) for x in r[1]] for r in kept], dtype=np.int64)
    width = data.shape[1] // 4
    parts = data.reshape(len(kept), 4, width)
    books = parts[:256].transpose(1, 0, 2).copy()

    def assign(p):
        distances = ((parts[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
        found = distances.argmin(axis=1)
        return found, distances[np.arange(len(kept)), found]

    for _ in range(4):
        for p in range(4):
            found, _ = assign(p)
            for e in set(found):
                books[p, e] = parts[found == e, p].sum(axis=0) // (found == e).sum()
    codes, errors = [""] * len(kept), np.zeros(len(kept), dtype=np.int64)
    for p in range(4):
        found, distance = assign(p)
        codes = [c + f"{e:02x}" for c, e in zip(codes, found)]
        errors += distance
    totals = Counter()
    for r, e in zip(kept, errors):
        totals[r[2]] += int(e)
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    return Counter((r[0], c, int(e), totals[r[2]], digest) for r, c, e in zip(kept, codes, errors))


def rows_of(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, label int"


def given(spark, rows, more=False):
    if more:
        return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", row long, part string").repartition(4)
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def as_float(x):
    return float(np.float32(x))


def test_query_matches_brute_force(spark):
    table = spark.read.parquet(f"{PATH}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert rows_of(queries.QUERIES["op13_vectors"](spark, PATH)) == brute([tuple(r) for r in table.collect()])


@pytest.mark.parametrize("wide, scale, n", [(8, 0.02, 900), (4, 3.0, 300), (12, 3e4, 400), (64, 0.3, 40)])
def test_ties_copies_and_nulls(spark, wide, scale, n):
    draw = random.Random(wide)
    rows = []
    for k in range(n):
        vector = [as_float(round(draw.gauss(0, scale), 3)) for _ in range(wide)]
        rows.append((k, vector, draw.choice([None, 1, 2])))
    rows += [(10_000 + k, rows[5][1], 1) for k in range(n // 3)]
    rows += [(3, rows[3][1], 1), (None, rows[4][1], None)]
    bad = [(-1, None, 1), (-2, [None] * wide, 1), (-3, [float("nan")] * wide, 1), (-4, [float("inf")] + [0.0] * (wide - 1), 2)]
    assert rows_of(vectors.report(given(spark, rows + bad, more=True))) == brute(rows)


def test_edges(spark):
    assert vectors.report(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = vectors.report(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert nothing.count() == 0 and nothing.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    odd = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.0, 3.5], 1), (3, [1.0], 1), (4, [], 1)]
    assert [(r.vec_id, r.code, r.error) for r in vectors.report(spark.createDataFrame(odd, SCHEMA)).orderBy("vec_id").collect()] == [
        (1, "00000000", 0), (2, "00000100", 0)]
    huge = [(1, [3e38] * 4, 1), (2, [-3e38] * 4, 1)]
    assert vectors.report(spark.createDataFrame(huge, SCHEMA)).count() == 2
    empty = vectors.report(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)).collect()
    assert [r.code for r in empty] == ["00000000"] * 2


def test_codes_decode_to_the_nearest_entries(spark):
    draw = random.Random(1)
    rows = [(k, [as_float(draw.uniform(-1, 1)) for _ in range(8)], 1) for k in range(400)]
    made = vectors.compress(given(spark, rows))
    for r in made.codes.collect():
        whole = [math.floor(1024 * x) for x in rows[r.vec_id][1]]
        assert sum((a - b) ** 2 for a, b in zip(whole, made.decode(r.code))) == r.error


def test_the_curve_visits_neighbours():
    side = 8
    points = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    places = vectors.hilbert(points, 3)
    assert sorted(places) == list(range(side ** 3))
    walk = points[np.argsort(places)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_keep_the_nearest():
    draw = np.random.default_rng(3)
    entries = draw.integers(-50, 50, (40, 3))
    dropped = 0
    for _ in range(50):
        members = draw.integers(-50, 50, 3) + draw.integers(-6, 7, (20, 3))
        listed = vectors.shortlists(members.min(axis=0)[None], members.max(axis=0)[None], entries)[0]
        found, distance = vectors.nearest(members, entries)
        assert listed[found].all()
        again, same = vectors.nearest(members, entries[listed])
        assert (np.flatnonzero(listed)[again] == found).all() and (same == distance).all()
        big, far = vectors.nearest(members * 2 ** 30, entries * 2 ** 30)
        assert (big == found).all() and (far == distance * 2 ** 60).all() if distance.max() < 8 else True
        dropped += (~listed).sum()
    assert dropped > 500
