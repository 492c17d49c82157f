import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tapespark.llm import packing, queries

PATH = "/root/testdata/sf0.01"
with open(packing.tokenizer_file(), encoding="utf-8") as file:
    GIVEN = file.read()
IDS, SLOW = packing.Ids(GIVEN, packing.byte_ranks(GIVEN)), packing.Ids(GIVEN, None)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_file())


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, wanted, capacity=1024):
    """Pieces (doc, start, length, crc, tokens, sequence, offset) of lists of ids, by brute force."""
    parts, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset in pieces:
        assert length > 0 and tokens == len(wanted[doc])
        assert crc == zlib.crc32(np.array(wanted[doc][start:start + length], dtype="<u4").tobytes())
        parts[doc].append((start, length))
        sequences[sequence].append((offset, length))
    for doc, ids in wanted.items():
        at = 0
        for start, length in sorted(parts[doc]):
            assert start == at
            at += length
        assert at == len(ids)
    padding = 0
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        padding += packing.padded(at, capacity) - at
    return padding


def rows_of(df):
    return [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in df.collect()]


def test_query_packs_every_id_once_with_little_padding(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{PATH}/documents.parquet").collect()}
    wanted = {d: plain_ids(tokenizer, t) for d, t in texts.items()}
    padding = check(rows_of(queries.QUERIES["op11_packing"](spark, PATH)), wanted)
    assert padding < 0.01 * sum(map(len, wanted.values()))


def test_edges(spark, tokenizer):
    texts = {
        1: None, 2: "", 3: "a", 4: " " * 5000, 5: "x" * 30_000, 6: "Straße 日本 😀\n\n \t end. " * 3000,
        7: "don't  stop here " * 100, 8: "same", 9: "same",
    }
    rows = [(d, t, 5, "c") for d, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, offset string").repartition(3)
    check(rows_of(packing.report(docs)), {d: plain_ids(tokenizer, t) for d, t in texts.items()})
    assert packing.report(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "same")] * 2 + [(None, "same")] * 2, "doc_id long, text string")
    got = packing.report(twice).collect()
    assert sum(r.length for r in got) == 4 * len(plain_ids(tokenizer, "same"))


def test_long_texts_are_cut_where_no_word_reaches(tokenizer):
    draw = random.Random(2)
    text = "".join(draw.choice(["word", " ", "  ", "\n", "'s", "12", ".", " ", "é", " \n "]) for _ in range(5000))
    parts = list(packing.stretches(text, 50))
    assert "".join(parts) == text and len(parts) > 20
    assert sum((tokenizer.encode(p, add_special_tokens=False).ids for p in parts), []) == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["word", " ", "  ", "\n", "'s", "12", ".", "\xa0", "é", "\t", "\x1c", "\x85", "\u3000", "<|endoftext|>", "!"]), max_size=30))
@settings(max_examples=300, deadline=None)
def test_ids_by_chunks_are_the_tokenizers(parts):
    text = "".join(parts)
    assert IDS.of(text).tolist() == [*IDS.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_ids_of_odd_texts(monkeypatch, tokenizer):
    texts = [None, "", " " * 3000, "a" + " " * 1500 + "b", "x<|endoftext|> y", "\x1c a", "word " * 400, "é" * 5000, "\n\n\t a\u3000 b"]
    for stretch in (1 << 20, 40, 1):
        monkeypatch.setattr(packing, "STRETCH", stretch)
        assert [IDS.of(t).tolist() for t in texts] == [plain_ids(tokenizer, t) for t in texts]
        assert [SLOW.of(t).tolist() for t in texts] == [plain_ids(tokenizer, t) for t in texts]


def test_only_plain_merging_files_are_merged_by_rank():
    told = json.loads(GIVEN)
    assert len(packing.byte_ranks(GIVEN)) == 50_256
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}):
        assert packing.byte_ranks(json.dumps({**told, **change})) is None
    merges = told["model"]["merges"]
    swapped = {**told["model"], "merges": [merges[1], merges[0], *merges[2:]]}
    assert packing.byte_ranks(json.dumps({**told, "model": swapped})) is None


def test_windows_are_near_equal_and_within_capacity():
    draw = random.Random(3)
    for _ in range(30):
        sizes = [draw.randint(1, 100) for _ in range(draw.randint(1, 80))]
        windows = packing.windows_of(sizes, 100)
        assert sorted(k for w in windows for k in w) == list(range(len(sizes)))
        assert all(sum(sizes[k] for k in w) <= 100 for w in windows)
    place, fullest = packing.differenced([8, 7, 6, 5, 4], 2)
    # Differencing of two ways leaves 16 and 14 of these (8-7, 6-5, then 4-1, 3-1).
    assert fullest == 16 and sum([8, 7, 6, 5, 4][k] for k in range(5) if place[k] == 0) in (14, 16)
    even = [draw.randint(1, 30) for _ in range(600)]
    place, fullest = packing.differenced(even, 8)
    loads = [sum(s for s, p in zip(even, place) if p == w) for w in range(8)]
    assert max(loads) == fullest and max(loads) - min(loads) <= 2
    # The number of windows rises when pieces do not fit into as many as their sum asks for.
    assert len(packing.windows_of([60, 60, 60], 100)) == 3


def test_sequences_hold_the_ids_in_order(spark, tokenizer):
    texts = {1: "one two three. " * 700, 2: "four five", 3: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    pieces = packing.pack(docs)
    held = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        whole = held[r.sequence_id]
        n = len(r.ids) // 4
        assert np.frombuffer(r.ids, "<u4").tolist() == whole.ids[r.offset:r.offset + n]
        assert plain_ids(tokenizer, texts[r.doc_id])[r.start:r.start + n] == whole.ids[r.offset:r.offset + n]
        assert len(whole.ids) == packing.padded(whole.length)
    assert [packing.padded(n) for n in (1, 3, 512, 700, 1024)] == [1, 1024, 512, 1024, 1024]
