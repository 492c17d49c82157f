import random
from collections import Counter

import numpy as np
import pytest
from checker import compare, connect

from tapespark.llm import components, jaccard, queries


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """{doc_id: (set size, component)} by comparing all sets that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    holders = {}
    for d in sorted(sets):
        met = Counter(e for s in sets[d] for e in holders.get(s, ()))
        for e, shared in met.items():
            if 100 * shared >= 75 * (len(sets[d]) + len(sets[e]) - shared):
                a, b = root(d), root(e)
                up[max(a, b)] = min(a, b)
        for s in sets[d]:
            holders.setdefault(s, []).append(d)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def near_copies(seed, groups, size):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    common = [draw.choice(words) for _ in range(60)]
    rows = []
    for _ in range(groups):
        base = [draw.choice(words) for _ in range(draw.randint(6, 160))] + (common if draw.random() < 0.5 else [])
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(copy) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("block", [1 << 20, 600])
def test_components_match_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(3, 25, 8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_long_lists_are_cut(spark, monkeypatch):
    rows = near_copies(11, 40, 5)
    # One passage is in every text, so its shingles' lists make their buckets overfull.
    rows = [(d, t + " this passage is in every single text") for d, t in rows]
    want = brute(rows)
    for bins, per_bucket in ((512, 300), (4, 100)):
        monkeypatch.setattr(jaccard, "BINS", bins)
        monkeypatch.setattr(jaccard, "PER_BUCKET", per_bucket)
        monkeypatch.setattr(jaccard, "CHUNK", 2000)
        counts = {}
        for _, t in rows:
            for b in jaccard.bucket_of(jaccard.shingle_set(t), bins):
                counts[int(b)] = counts.get(int(b), 0) + 1
        buckets, parts = jaccard.plan_buckets(counts)
        assert buckets > 4 and (bins > 4 or parts.max() > 1)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, rows)).collect()}
        assert got == want


def test_different_sets_with_one_number_are_told_apart(spark, monkeypatch):
    whole = jaccard.class_of
    monkeypatch.setattr(jaccard, "class_of", lambda entries: (whole(entries)[0] % 5, whole(entries)[1]))
    rows = near_copies(13, 6, 4) + [(100, None), (101, "a b"), (102, "A  b")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(components, "FEW", 5)
    monkeypatch.setattr(components, "MOST", 50)
    draw = random.Random(4)
    pairs = [(1, k) for k in range(2, 60)] + [(200 + k, 201 + k) for k in range(40)] + [(draw.randint(300, 400), draw.randint(300, 400)) for _ in range(60)]
    pairs += [(7, 7), (None, 3), (500, None)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.label for r in components.components(links).collect()}
    assert got == {x: root(x) for x in up}
    assert components.components(links.limit(0)).count() == 0


def test_links_among_join_what_is_linked():
    rows = near_copies(5, 1, 60)
    sets = [np.array(sorted(abs(hash(s)) for s in shingles(t)), dtype=np.uint64) for _, t in rows]
    links = jaccard.links_among(np.array([len(s) for s in sets]), sets)
    assert len(links) < len(sets)
    for a, b in links:
        shared = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "É a b c d"), (8, "é a b c d"),
            (9, "z " * 20_000), (10, "z " * 20_003)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, rows)).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 7), 8: (1, 8), 9: (1, 9), 10: (1, 9)}
    assert jaccard.join(frame(spark, [])).count() == 0


def test_keep_one(spark):
    rows = [(2, "a b c d e f", "n"), (1, "a b c d e f", "n"), (1, "a b c d e f", "n"), (3, None, "e"), (None, "a b c d e f", "x"), (None, None, "x"), (4, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.label) for r in kept.collect()) == [(0, "x"), (0, "x"), (1, "n"), (3, "e"), (4, "e")]


def test_keep_one_drops_no_text_for_its_id(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    rows = [
        (1, "a b c d e f", 1), (1, "totally other words that nothing stands for", 1), (1, "a b c d e f", 1),
        (2, "totally other words that nothing stands for", 2), (3, long, 3), (3, long + " eighteen", 3), (4, long, 4),
        (5, None, 5), (5, "", 5), (6, "x y", 6), (None, "x y", 7), (None, "x y", 7),
    ]
    schema = "doc_id long, text string, `set` long"
    more = [(*r, r[0], "n", 1.5, True, "k", "h") for r in rows]
    docs = spark.createDataFrame(more, schema + ", `__nameless` long, class string, of double, stays boolean, `a.b` string, several string")
    kept = jaccard.keep_one(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    third = [r for r in got if r[0] == 3]
    assert len(third) == 1 and third[0][1].startswith(long)
    assert [r for r in got if r[0] != 3] == [
        (0, "x y"), (0, "x y"), (1, "a b c d e f"), (1, "totally other words that nothing stands for"), (5, ""), (6, "x y"),
    ]
    assert all(r["__nameless"] == r.doc_id and r["a.b"] == "k" and r["set"] in (r.doc_id, 7) for r in kept.collect())
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_query_matches_plain_version(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op10_jaccard"](spark, path).collect()}
    assert got == brute(rows)


def test_query_matches_its_sql(spark):
    path = "/root/testdata/sf0.001"
    assert compare(queries.QUERIES["op10_jaccard"](spark, path), connect(path), queries.ORACLES["op10_jaccard"]) == []
