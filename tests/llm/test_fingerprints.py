import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tapespark.llm import fingerprints as fp
from tapespark.llm import queries

SHORT = st.text("ab", max_size=30)


@given(SHORT, SHORT, st.integers(0, 30), st.integers(0, 30))
@settings(max_examples=200, deadline=None)
def test_common_extension(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    want = 0
    while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
        want += 1
    left, right = fp.Prefix(fp.code_points(a)), fp.Prefix(fp.code_points(b))
    assert fp.common_extension(left, i, right, j) == want
    assert fp.spans_equal(left, i, right, j, want)


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edit = text[:len(text) - cut] + after[:cut]
        yield (doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest(), fp.fingerprint(text), fp.fingerprint(edit),
               fp.likeness(fp.fingerprint(text), fp.fingerprint(edit)), fp.likeness(fp.fingerprint(text), fp.fingerprint(after)))


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r)[:7] for r in fp.compare_with_next(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows)))


def test_edges(spark):
    check(spark, [(5, "only one")])
    check(spark, [(1, None), (2, ""), (3, "é😀abc" * 40), (4, "ab"), (7, "x" * 70_000), (7, "x" * 70_000), (7, "y"), (None, "nameless text " * 9)])
    assert fp.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_matches_plain_version(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op9_fingerprints"](spark, path).collect()
    assert sorted(repr(tuple(r)[:7]) for r in got) == sorted(map(repr, brute(rows)))
    long = [r for r in got if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.3
    assert all(r.common_start >= r.n_chars - r.n_chars // 3 for r in got)
