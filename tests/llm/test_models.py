"""Quality and toxicity: held-out accuracy on the given tables, and edges."""

import numpy as np
import pytest

from tapespark.llm import quality, queries, toxicity

PATH = "/root/testdata/sf0.1"


def auc(rows, label):
    ones = np.array([r.score for r in rows if r[label] == 1])
    zeros = np.array([r.score for r in rows if r[label] == 0])
    return np.mean([(zeros < s).mean() + (zeros == s).mean() / 2 for s in ones])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{PATH}/labels.parquet")


@pytest.mark.parametrize(("query", "label", "least"), [("op1_quality", "quality", 0.99), ("op2_toxicity", "toxic", 0.93)])
def test_held_out_scores(spark, labels, query, label, least):
    got = queries.QUERIES[query](spark, PATH)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 1000 and auc(rows, label) > least
    assert all(0 <= r.score <= 1 for r in rows)
    if label == "toxic":
        assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(rows)


EDGES = [(1, None), (2, ""), (3, " \n "), (4, "a " * 50_000), (5, "plain text."), (5, "plain text."), (None, "plain text.")]


@pytest.mark.parametrize("module", [quality, toxicity])
@pytest.mark.parametrize("labelled", [[], [(5, 1, 1)], [(2, 0, 0), (3, None, None), (5, 1, 1), (5, 0, 0), (None, 1, 1)]])
def test_edges(spark, module, labelled):
    docs = spark.createDataFrame([(d, t, 0.5) for d, t in EDGES], "doc_id long, text string, score double")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    rows = module.score(docs, labels).collect()
    assert len(rows) == len(EDGES)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= module.THRESHOLD) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert module.score(docs.limit(0), labels).count() == 0


def test_accept_keeps_columns_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = quality.accept(docs, labels)
    assert kept.schema == docs.schema
    rows = kept.join(labels, "doc_id").collect()
    assert all(r.quality for r in rows) and len(rows) == labels.where("quality = 1").count()


def test_trees_walk_like_their_nodes():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, len(quality.STATISTICS)))
    trees = quality.fit(x, ((x[:, 2] > 0) ^ (x[:, 5] > 0.5)).astype(float), rounds=20)

    def walk(row):
        total = trees.base
        for column, cut, value in zip(trees.column, trees.cut, trees.value):
            node = 0
            for _ in range(trees.depth):
                node = 2 * node + 1 + int(row[column[node]] > cut[node])
            total += value[node - (2 ** trees.depth - 1)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(row) for row in x])
    assert ((trees.score(x) > 0.5) == ((x[:, 2] > 0) ^ (x[:, 5] > 0.5))).mean() > 0.97


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        row, last = [i], row
        for j, d in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def test_automaton_finds_terms_within_one_edit():
    terms = ["worthless", "stupid", "idiot", "stupids"]
    lexicon = toxicity.Lexicon.of(terms, terms)
    draw = np.random.default_rng(2)
    for _ in range(3000):
        word = list(terms[draw.integers(len(terms))])
        for _ in range(draw.integers(0, 3)):
            at = draw.integers(len(word))
            word[at:at + draw.integers(0, 2)] = list("abc" if draw.integers(2) else "u")[:draw.integers(0, 2)]
        word = "".join(word)
        near = any(edits(word, t) <= 1 for t in terms)
        assert (toxicity.within_one_edit(word, lexicon.trie) is not None) == near
        assert (toxicity.match(word, lexicon) > 0) == near


def test_quoted_hits_are_told_from_direct_ones():
    matcher = toxicity.Matcher(toxicity.Lexicon.of(["idiot"], ["idiot"]))
    assert matcher.hits("You idiot, you idi0t and more words follow here")[:3] == [1.0, 1.0, 0.0]
    assert matcher.hits('the “idiot” of the play')[:3] == [0.0, 0.0, 1.0]
    assert matcher.hits("he said idiot twice")[:3] == [0.0, 0.0, 1.0]


def swaps_and_edits(a, b):
    """Letters left out, put in, replaced or swapped with the next, no place being edited twice."""
    rows = [list(range(len(b) + 1))]
    for i, c in enumerate(a, 1):
        rows.append([i])
        for j, d in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (c != d))
            if i > 1 and j > 1 and c == b[j - 2] and a[i - 2] == d:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i].append(best)
    return rows[-1][-1]


def test_automaton_finds_terms_with_swaps_and_two_edits():
    terms = ["worthless", "stupid", "scum", "idiot", "disgusting"]
    lexicon = toxicity.Lexicon.of(terms, terms, swaps=True)
    draw = np.random.default_rng(3)
    found = 0
    for _ in range(4000):
        word = list(terms[draw.integers(len(terms))])
        for _ in range(draw.integers(0, 4)):
            at = int(draw.integers(len(word)))
            if draw.integers(2) and at + 1 < len(word):
                word[at], word[at + 1] = word[at + 1], word[at]
            else:
                word[at:at + draw.integers(0, 2)] = list("abc" if draw.integers(2) else "u")[:draw.integers(0, 2)]
        word = "".join(word)
        near = any(swaps_and_edits(word, t) <= toxicity.allowed(t) for t in terms)
        assert (toxicity.nearest_term(word, lexicon.trie) is not None) == near
        assert (toxicity.match(word, lexicon) > 0) == near
        found += near
    assert found > 1000
    matcher = toxicity.Matcher(lexicon)
    assert matcher.hits("wrothless idoit wortless scvm")[:3] == [0.0, 4.0, 0.0]


def test_tokens_walk_the_trie_together_as_they_do_alone(monkeypatch):
    """Many tokens in one walk: the first term of each as alone, and a walk of its own for long ones only."""
    draw = np.random.default_rng(4)
    syllables = ["an", "don", "re", "chl", "la", "ör", "ó", "th", "ing", "𝒳", "ß", "e"]
    terms = sorted({"".join(draw.choice(syllables, draw.integers(2, 6))) for _ in range(80)} | {"longest" * 10, "scum", "scam"})
    words = {"".join(draw.choice(syllables, draw.integers(1, 7))) for _ in range(20_000)}
    words |= {"longset" + "longest" * 9, "longest" * 9, "scm", "sucm", "scümm", "x" * 200}
    lexicon = toxicity.Lexicon.of(terms, terms, swaps=True)
    alone = {w: toxicity.nearest_term(w, lexicon.trie) for w in words}
    assert 100 < sum(t is not None for t in alone.values()) < len(words) / 2
    walked, one = [], toxicity.nearest_term
    monkeypatch.setattr(toxicity, "nearest_term", lambda token, trie: walked.append(token) or one(token, trie))
    exact = sum(w in lexicon.words for w in words)
    near = sum(t is not None and w not in lexicon.words for w, t in alone.items())
    hits = toxicity.Matcher(lexicon).hits(" ".join(sorted(words)) + " (SCUM)")
    assert hits == [float(exact + 1), float(near), 0.0, float(len(words) + 1)]
    assert len(walked) <= 2 and all(len(w) > 60 for w in walked)
    assert toxicity.misspelt(sorted(words), lexicon) == {w: t for w, t in alone.items() if t}
    monkeypatch.setattr(toxicity, "SETS", 5_000)
    assert toxicity.misspelt(sorted(words), lexicon) == {w: t for w, t in alone.items() if t}


def test_texts_together_have_the_hits_that_each_has_alone(monkeypatch):
    lexicon = toxicity.Lexicon.of(["idiot", "worthless", "scum"], ["idiot", "worthless"], swaps=True)
    texts = [None, "", "You idiot, you wrothless", '"an idoit" said so', "plain words", "scum " * 50, None]
    alone = [toxicity.Matcher(lexicon).hits(t) for t in texts]
    assert alone[2][:3] == [1.0, 1.0, 0.0] and alone[3][:3] == [0.0, 0.0, 1.0] and alone[5][0] == 50.0
    for held, remembered in ((1 << 22, 1 << 19), (1, 1), (20, 3)):
        monkeypatch.setattr(toxicity, "HELD", held)
        monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
        matcher = toxicity.Matcher(lexicon)
        assert list(matcher.all_hits(texts)) == alone and list(matcher.all_hits(texts[::-1])) == alone[::-1]
    assert list(toxicity.Matcher(lexicon).all_hits([])) == []


def test_quotations_over_several_words():
    matcher = toxicity.Matcher(toxicity.Lexicon.of(["idiot", "worthless"], [], swaps=True))
    assert matcher.hits('"you are a worthless idiot" was on the wall')[:3] == [0.0, 0.0, 2.0]
    assert matcher.hits("“worthless idiot” was there, (‘an idiot’).")[:3] == [0.0, 0.0, 3.0]
    assert matcher.hits('„you idiot“ and «du idiot», idiot')[:3] == [1.0, 0.0, 2.0]
    assert matcher.hits('an open " stands alone, you worthless idiot')[:3] == [2.0, 0.0, 0.0]
    assert matcher.hits('"open ' + "so " * 70 + 'idiot" end')[:3] == [1.0, 0.0, 0.0]
    assert matcher.hits("the dogs' idiot isn't 'it")[:3] == [1.0, 0.0, 0.0]


def test_toxicity_query_scores_as_its_model_does(spark, labels):
    """The query against the model applied to every text in one place, hits found by comparing all terms."""
    path = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, marks)
    terms = [t for t in toxicity_terms(model.lexicon.trie)]
    kinds = {}

    def kind(token):
        core = toxicity.EDGES.sub("", token.lower())
        if core not in kinds:
            exact = core in model.lexicon.words or any(core[:k] in model.lexicon.stems for k in toxicity.STEMS)
            near = [t for t in terms if abs(len(t) - len(core)) <= 2 and swaps_and_edits(core, t) <= toxicity.allowed(t)]
            kinds[core] = 1 if core and exact else 2 if core and near else 0
        return kinds[core]

    rows = {r.doc_id: r for r in queries.QUERIES["op2_toxicity"](spark, path).collect()}
    texts = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for doc_id, text in texts[:150]:
        told = [kind(t) for t in text.split()]
        r = rows[doc_id]
        assert r.n_exact + r.n_misspelt + r.n_quoted == sum(k > 0 for k in told)
        assert r.n_exact <= told.count(1) and r.n_misspelt <= told.count(2)
        direct = r.n_exact + model.fuzzy_worth * r.n_misspelt
        x = model.weights @ [1, np.log1p(direct), min(direct, 1), np.log1p(r.n_quoted)]
        assert abs(r.score - 1 / (1 + np.exp(-x))) < 1e-9


def toxicity_terms(trie):
    for c, below in trie.items():
        if c == "":
            yield below
        else:
            yield from toxicity_terms(below)


def test_quality_query_scores_as_its_trees_do(spark):
    """The query against a walk from node to node over statistics taken text by text."""
    path = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.learn(quality.measure(docs), marks)
    rows = {r.doc_id: r for r in queries.QUERIES["op1_quality"](spark, path).collect()}
    for r in docs.select("doc_id", "text").collect():
        row = np.asarray(quality.statistics(r.text))
        total = trees.base
        for column, cut, value in zip(trees.column, trees.cut, trees.value):
            node = 0
            for _ in range(trees.depth):
                node = 2 * node + 1 + int(row[column[node]] > cut[node])
            total += value[node - (2 ** trees.depth - 1)]
        assert abs(rows[r.doc_id].score - 1 / (1 + np.exp(-total))) < 1e-9
