import random
from itertools import combinations

import numpy as np
import pytest

from tapespark.llm import decontaminate, queries

DRAW = random.Random(7)
WORDS = [f"word{k}" for k in range(3000)]
ITEM = [DRAW.choice(WORDS) for _ in range(40)]


def text(words, head=30, tail=30):
    return " ".join([DRAW.choice(WORDS) for _ in range(head)] + words + [DRAW.choice(WORDS) for _ in range(tail)])


def changed(words, every):
    return [w if k % every else "other" for k, w in enumerate(words, 1)]


CASES = {
    1: (text(ITEM), True), 2: (text(ITEM).upper(), True), 3: (text(changed(ITEM, 9)), True), 4: (text(ITEM[10:26]), True),
    5: (text(ITEM[:7]), False), 6: (text([]), False), 7: (None, False), 8: ("", False), 9: (" ".join(ITEM), True),
    10: (text(ITEM[::-1]), False), 11: (text(["tiny", "item", "here"]), True), 12: (text(["tiny", "item"]), False),
    13: (text(ITEM, 20_000, 20_000), True),
}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(d, t, "x") for d, (t, _) in CASES.items()] + [(1, CASES[1][0], "again"), (None, CASES[1][0], "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    items = [(100, " ".join(ITEM)), (101, "tiny item here"), (102, None), (103, ""), (100, " ".join(ITEM)), (None, "word1 word2")]
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_leaks_with_substitutions_are_found_and_others_left(tables):
    found = decontaminate.find_leaks(*tables).collect()
    assert {r.doc_id for r in found} == {d for d, (_, leaks) in CASES.items() if leaks}
    whole = next(r for r in found if r.doc_id == 13)
    assert (whole.item_id, whole.first_word, whole.end_word, whole.matched) == (100, 20_000, 20_040, 40)
    assert next(r for r in found if r.doc_id == 3).matched >= 30


def test_a_shuffled_join_finds_the_same(tables, monkeypatch):
    want = sorted(map(tuple, decontaminate.find_leaks(*tables).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, decontaminate.find_leaks(*tables).collect())) == want


def test_dropping_keeps_clean_rows_and_columns(tables):
    docs, items = tables
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([0, *(d for d, (_, leaks) in CASES.items() if not leaks)])


def test_empty_tables(tables):
    docs, items = tables
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_items_with_two_or_three_substitutions_are_leaks(spark):
    short, longer, split = ([f"{name}{k}" for k in range(n)] for name, n in (("s", 15), ("l", 20), ("t", 26)))
    items = spark.createDataFrame(
        [(15, " ".join(short)), (20, " ".join(longer)), (26, " ".join(split))], "item_id long, text string"
    )
    cases = [(15, short, [a, b]) for a in range(15) for b in range(a)]
    cases += [(20, longer, sorted(DRAW.sample(range(20), 3))) for _ in range(150)] + [(26, split, [11, 12, 13, 14])]
    rows = [
        (d, text(["other" if k in places else w for k, w in enumerate(words)]))
        for d, (_, words, places) in enumerate(cases)
    ]
    # Of a quarter substituted, 12 words of 15 are equal at a place; a third is too many everywhere.
    cases.append((20, longer, [1, 5, 9, 13, 17]))
    rows.append((len(rows), text(["other" if k % 4 == 1 else w for k, w in enumerate(longer)])))
    rows.append((-1, text(["other" if k % 3 == 1 else w for k, w in enumerate(longer)])))
    found = {r.doc_id: r for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert sorted(found) == list(range(len(cases)))
    for d, (item, words, places) in enumerate(cases):
        assert found[d].item_id == item and 12 <= found[d].matched <= len(words) - len(places)
    assert (found[len(cases) - 2].matched, found[len(cases) - 2].compared) == (22, 26)


def test_a_seed_does_not_carry_its_item(spark, monkeypatch):
    long = [f"long{k}" for k in range(20_000)]
    items = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(long[::2]))], "item_id long, text string")
    batches = [decontaminate.pa.RecordBatch.from_pydict({"item_id": [1], "text": [" ".join(long)]})]
    assert sum(batch.nbytes for batch in decontaminate._item_seeds(iter(batches))) < 100 * len(long)
    rows = [(1, text(long[700:730])), (2, " ".join(long)), (3, " ".join(long[1:4000:2])), (4, text(long[::2][50:90]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, 1, 30, 60, 30), (2, 1, 0, 20_000, 20_000), (4, 2, 30, 70, 40)]
    for most in (decontaminate.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
        found = decontaminate.find_leaks(docs, items).collect()
        assert sorted((r.doc_id, r.item_id, r.first_word, r.end_word, r.matched) for r in found) == want


def test_the_widest_window_is_that_of_a_plain_search():
    for _ in range(500):
        same = decontaminate.np.array([DRAW.random() < 0.75 for _ in range(DRAW.randint(1, 40))])
        sums = [
            (int(same[a:b].sum()), a - b) for a in range(len(same)) for b in range(a + 1, len(same) + 1)
            if 5 * int(same[a:b].sum()) >= 4 * (b - a)
        ]
        a, b, matched = decontaminate.widest_window(same)
        assert (matched, a - b) == max(sums, default=(0, 0)) and matched == same[a:b].sum()


def test_query_finds_every_run_of_twelve_words(spark):
    path = "/root/testdata/sf0.01"
    runs = {}
    for r in spark.read.parquet(f"{path}/benchmark.parquet").collect():
        words = r.text.lower().split()
        for k in range(len(words) - 11):
            runs.setdefault(tuple(words[k:k + 12]), set()).add(r.item_id)
    want = set()
    for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect():
        words = r.text.lower().split()
        for k in range(len(words) - 11):
            want |= {(r.doc_id, item) for item in runs.get(tuple(words[k:k + 12]), ())}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op8_decontaminate"](spark, path).collect()}
    assert got == want and want


@pytest.mark.parametrize("words", range(8, 21))
def test_masks_meet_every_leak(words):
    """All sets of up to four substitutions that still make a leak; five are too many for 20 words."""
    windows = [sum(1 << (place + k) for k in mask) for mask in decontaminate.masks_for(words) for place in range(words - mask[-1])]
    leaks = met = 0
    for n in range(5):
        for places in combinations(range(words), n):
            same = np.ones(words, dtype=bool)
            same[list(places)] = False
            if decontaminate.overlap(same, words):
                changed = sum(1 << k for k in places)
                leaks += 1
                met += any(not window & changed for window in windows)
    assert leaks > words and (met == leaks if words <= 16 else met >= 0.999 * leaks)


@pytest.mark.parametrize("words, changed", [(8, 1), (10, 2), (11, 2), (12, 2), (14, 2), (15, 3)])
def test_short_items_are_found_whatever_was_substituted(spark, words, changed):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(words))) for k in range(2)]
    docs = []
    for places in combinations(range(words), changed):
        text = items[len(docs) % 2][1].split()
        for k in places:
            text[k] = f"other{k}"
        docs.append((len(docs), "before it " + " ".join(text) + " and after"))
    got = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, d % 2) for d, _ in docs}
