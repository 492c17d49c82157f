"""The pipeline against its stages' plain versions, on the smallest table with enough labels."""

import sentencepiece

import corpus_pipeline
from tapespark.llm import common, pieces, quality
from test_jaccard import brute as plain_components
from test_pii import brute as plain_spans

PATH = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_rows_match_plain_version(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    labels = spark.read.parquet(f"{PATH}/labels.parquet")
    good = {r.doc_id for r in quality.score(docs, labels).where("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    single = {d for d, (n, least) in plain_components(list(texts.items())).items() if d == least or not n}
    runs = set()
    for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect():
        words = r.text.lower().split()
        runs |= {tuple(words[k:k + 12]) for k in range(len(words) - 11)}

    def leaks(text):
        words = text.lower().split()
        return any(tuple(words[k:k + 12]) in runs for k in range(len(words) - 11))

    want = {d for d in single if not leaks(texts[d])}
    rows = corpus_pipeline.run(spark, PATH).collect()
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for r in rows:
        assert not plain_spans(r.text)
        assert r.text == texts[r.doc_id] or plain_spans(texts[r.doc_id])
        assert r.n_chars == len(r.text)
        assert r.same and r.ids == model.encode(r.text)


def test_stages_take_edges(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "w " * 30_000, "en", "s", 60_000), (4, "a b c", "en", "s", 5), (4, "a b c", "en", "s", 5), (None, "a b c", None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)

    def told(out):
        return sorted((tuple(r)[:5] for r in out.collect()), key=repr)

    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), PATH)
        out = stage(spark, docs, PATH)
        assert empty.count() == 0 and empty.columns == out.columns and out.columns[:5] == COLUMNS, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == COLUMNS
        got = told(out)
        if name == "quality classifier":
            # Rows stay as they are, and equal texts share their fate.
            assert all(r in rows for r in got)
            for text in {r[1] for r in rows}:
                assert sum(r[1] == text for r in got) in (0, sum(r[1] == text for r in rows))
        elif name == "n-gram Jaccard join":
            # Of the repeated row one stays; rows without words or doc_id have nothing that stands for them.
            assert got == sorted([*rows[:4], rows[5]], key=repr)
        elif name == "benchmark decontamination":
            assert got == sorted(rows, key=repr)
        elif name == "PII":
            assert got == sorted(rows, key=repr)
        else:
            assert got == sorted(rows, key=repr)
            for r in out.collect():
                assert r.ids == model.encode(r.text or "") and r.n_tokens == len(r.ids)
                assert r.same == (r.text is None or model.decode(r.ids) == r.text)


def test_every_stage_is_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece encoding and decoding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_workers_hand_memory_back_after_their_batches():
    seen = []
    assert list(common.tidy(lambda batches: (seen.append(b) or b for b in batches))(iter([1, 2]))) == [1, 2]
    common.release()
    assert seen == [1, 2]
