import random

import pytest
import sentencepiece

from tapespark.llm import pieces, queries

TEXTS = [
    None, "", "x", "Hello  world\n\tfoo ﬁ é 日本 😀԰ ", "   a    b", "x" * 3000, " ", "\n\n", "ab" * 200, "antidisestablishment" * 6,
    "The cat sat. " * 3000,
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_ids_are_the_librarys_and_decode_to_the_text(spark, model):
    rows = [(k, t, 1, "b") for k, t in enumerate(TEXTS)] + [(2, "x", 2, "b"), (None, "no id", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, block string").repartition(3)
    got = pieces.decode(pieces.encode(docs, blocks=4)).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "block", "ids", "decoded"}
    for r in got:
        assert r.ids == model.encode(r.text or "")
        assert r.decoded == (r.text or "")
    assert pieces.encode(docs.limit(0)).count() == 0


def test_columns_of_any_name_repeats_and_small_packs(spark, model, monkeypatch):
    monkeypatch.setattr(pieces, "PACK", 1)
    monkeypatch.setattr(pieces, "REPEATS", 2)
    rows = [(k % 3, TEXTS[k % len(TEXTS)], k, "p", None, 1, k, "h", True) for k in range(40)] + [(7, "again and again", 1, None, "w", 2, 3, "x", None)] * 30
    schema = "doc_id long, text string, `__block` int, pack string, word string, block int, h int, `a.b` string, own boolean"
    got = pieces.encode(spark.createDataFrame(rows, schema).repartition(3), blocks=5).collect()
    assert sorted(map(repr, (tuple(r)[:-1] for r in got))) == sorted(map(repr, rows))
    assert all(r.ids == model.encode(r.text or "") for r in got)


def test_many_long_words(spark, model):
    draw = random.Random(8)
    texts = ["".join(draw.choice("etaoin shrdlu") for _ in range(draw.randint(0, 400))) for _ in range(50)]
    texts += ["".join(draw.choice("etaoins") for _ in range(n)) for n in (119, 120, 121, 60, 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.ids == model.encode(r.text) for r in pieces.encode(docs).collect())


def test_the_sign_itself_decodes_as_a_space(spark, model):
    docs = spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")
    row = pieces.round_trip(docs).first()
    assert (row.ids, row.same) == (model.encode("a▁b"), False)


def test_viterbi_finds_the_cheapest_path(spark):
    draw = random.Random(4)
    table = {"a": 9, "b": 8, "ab": 11, "ba": 12, "aba": 20, "bb": 30, "abab": 25}
    words = ["".join(draw.choice("ab") for _ in range(n)) for n in range(1, 12)]
    told = {p: (k + 10, -float(rank)) for k, (p, rank) in enumerate(table.items())}
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    got = pieces.encode_words(rows, pieces.piece_table(spark, {**told, "z": (1, 0.0)}), 4, 100, fold=pieces.viterbi).collect()

    def cheapest(word):
        best = [0]
        for end in range(1, len(word) + 1):
            best.append(min(best[s] + table[word[s:end]] for s in range(max(0, end - 4), end) if word[s:end] in table))
        return best[-1]

    named = {k: p for p, (k, _) in told.items()}
    for r in got:
        path = [named[k] for k in r.ids]
        assert "".join(path) == r.word and sum(table[p] for p in path) == cheapest(r.word)


def test_query_matches_the_library(spark, model):
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_pieces"](spark, path).collect()
    assert len(rows) == len(texts)
    assert all(r.same and r.ids == model.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in rows)
