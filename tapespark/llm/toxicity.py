"""Toxicity: a learnt lexicon, matched exactly and with misspellings, read in its context.

Terms are words and word beginnings that Spark counts in a bounded sample of labelled
documents (``TOXIC_SAMPLE``, ``CLEAN_SAMPLE``); those are kept that toxic texts hold too often
for chance, copies of one text counted once.  Texts are matched token by token: a Levenshtein
automaton of the token, kept as bit sets, is intersected with the trie of the terms, so all
terms near it are found in one walk, which the new tokens of several texts make together.  Letters
left out, put in, replaced or swapped with the next are one edit each; terms of SHORTEST letters and
more may have one, those of FAR and more two, but for terms that clean texts come so near to.  A hit
that stands in an open quotation, or beside a word of reporting, counts as quoted.  A logistic model
over a text's hits gives the score.

Nulls count as empty texts; a text without hits has the score of no hits; very long texts are
read whole.  Only the text is read for a score, whatever other columns there are.  Repeated rows
are scored alike, labels repeated for one document count as their largest, and empty tables
give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.llm.common import held_out
from tapespark.session import scratch_path

#: Most labelled documents of either kind that are learnt from, taken by the hash of their id.
TOXIC_SAMPLE, CLEAN_SAMPLE = 4_000, 8_000
THRESHOLD = 0.7
#: Lengths of word beginnings that may become terms.
STEMS = (4, 5, 6)
#: Texts with this many telling words in common count as copies of each other.
COPIES = 20
#: Terms expected to pass by chance among all that are equally frequent.
CHANCE = 0.3
#: Terms of this length or more are also matched within one edit.
FUZZY_LENGTH = 5
#: With swaps and two edits: the shortest terms that may be misspelt, and those that may be twice.
SHORTEST, FAR = 4, 8
#: Tokens after which a quotation that is not closed was none.
QUOTED = 60
#: Tokens on either side that count as context.
CONTEXT = 5
#: Tokens remembered per worker, which bounds its memory.
REMEMBERED = 1 << 19
#: Characters from which on no further text's tokens are held beside those at hand; words that
#: walk through the trie together, and sets of places, one for a letter and word, that they may have.
HELD, TOGETHER, SETS = 1 << 20, 1 << 14, 1 << 22
#: Letters of the longest words whose sets of places fit a 64-bit number, two edits behind them included.
PLACES = 60

#: Words that introduce someone else's words.
REPORTING = frozenset(
    "said says say called calls wrote writes quote quoted quotes word term phrase slur dijo "
    "palabra mot terme wort sagte genannt".split()
)
QUOTES = "\"'«»“”„‘’‹›"
CLOSING = {'"': '"', "'": "'", "«": "»", "»": "«", "“": "”", "”": "”", "„": "“”", "‘": "’", "’": "’", "‹": "›", "›": "‹"}
TOKEN = re.compile(r"\S+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def core_of(token: str) -> str:
    """A token without its outer punctuation, in lower case."""
    low = token.lower()
    return low if low.isalnum() else EDGES.sub("", low)


def allowed(term: str) -> int:
    """Edits within which a term counts as misspelt, swaps being one."""
    return 0 if len(term) < SHORTEST else 1 if len(term) < FAR else 2


def code_points(words: list[str]) -> np.ndarray:
    """The code points of ``words``, one word behind the other."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def letters(words: list[str]) -> np.ndarray:
    """For each word, none of them empty, a bit for every letter, by its number modulo 64."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    bits = np.uint64(1) << (code_points(words) & np.uint32(63)).astype(np.uint64)
    return np.bitwise_or.reduceat(bits, np.concatenate([[0], ends[:-1]]))


def letters_by_length(terms: list[str]) -> dict[int, list[tuple[np.uint64, int]]]:
    """By length of a token: the letters of terms that it may misspell, and how many may come or go."""
    found: dict[int, set[tuple[np.uint64, int]]] = {}
    for term, mask in zip(terms, letters(terms)):
        edits = allowed(term)
        for length in range(len(term) - edits, len(term) + edits + 1):
            found.setdefault(length, set()).add((mask, edits))
    return {length: sorted(pairs) for length, pairs in found.items()}


@dataclass(frozen=True)
class Lexicon:
    """Whole words and word beginnings; the trie of the words long enough for an edit.

    ``swaps``: misspellings are those of ``allowed``; else one edit, without swaps, of words of
    FUZZY_LENGTH letters and more.
    """

    words: frozenset[str]
    stems: frozenset[str]
    trie: dict = field(compare=False, default_factory=dict)
    halves: frozenset[str] = frozenset()
    swaps: bool = False
    near: dict = field(compare=False, default_factory=dict)

    @classmethod
    def of(cls, terms: list[str], loose: list[str], swaps: bool = False) -> Lexicon:
        """``terms``: words, and beginnings written with a final ``*``; ``loose``: those that
        are also matched with misspellings."""
        words = frozenset(t for t in terms if not t.endswith("*"))
        trie: dict = {}
        halves = set()
        for word in loose:
            if len(word) < (SHORTEST if swaps else FUZZY_LENGTH) or word.endswith("*"):
                continue
            node = trie
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word
            # One edit leaves the first or the last half of a term as it is.
            halves |= {word[:len(word) // 2], "$" + word[len(word) // 2:]}
        stems = frozenset(t[:-1] for t in terms if t.endswith("*"))
        near = letters_by_length([t for t in loose if not t.endswith("*") and allowed(t)]) if swaps else {}
        return cls(words, stems, trie, frozenset(halves), swaps, near)


def within_one_edit(token: str, trie: dict) -> str | None:
    """The first term of the trie at distance 0 or 1 from ``token``.

    Bit i of a set says that i characters of the token are used up; ``same`` with no edit
    yet, ``once`` with one.
    """
    places: dict[str, int] = {}
    for i, c in enumerate(token):
        places[c] = places.get(c, 0) | (2 << i)
    end = 1 << len(token)
    full = (end << 1) - 1
    stack = [(trie, 1, 3)]
    while stack:
        node, same, once = stack.pop()
        for c, below in node.items():
            if c == "":
                if (same | once) & end:
                    return below
                continue
            at = places.get(c, 0)
            same_now = (same << 1) & at
            once_now = (((once << 1) & at) | same | (same << 1) | (same_now << 1)) & full
            if same_now or once_now:
                stack.append((below, same_now, once_now))
    return None


def nearest_term(token: str, trie: dict) -> str | None:
    """The first term of the trie within its ``allowed`` edits of ``token``, swaps being one edit.

    As ``within_one_edit`` with a set for none, one and two edits; a swap leads on from the
    sets two letters before.
    """
    places: dict[str, int] = {}
    for i, c in enumerate(token):
        places[c] = places.get(c, 0) | (2 << i)
    end = 1 << len(token)
    full = (end << 1) - 1
    nothing = (0, 0, 0)
    stack = [(trie, (1, 3, 7), nothing, "")]
    while stack:
        node, now, before, last = stack.pop()
        for c, below in node.items():
            if c == "":
                if any(now[k] & end for k in range(allowed(below) + 1)):
                    return below
                continue
            at = places.get(c, 0)
            swapped = (at << 1) & places.get(last, 0)
            after = [(now[0] << 1) & at]
            for k in (1, 2):
                after.append((
                    ((now[k] << 1) & at) | now[k - 1] | (now[k - 1] << 1) | (after[k - 1] << 1)
                    | ((before[k - 1] << 2) & swapped)
                ) & full)
            if any(after):
                stack.append((below, tuple(after), now, c))
    return None


def _reach(trie: dict) -> tuple[dict[int, tuple[int, int, int]], set[str]]:
    """By the identity of a node: the most edits and the shortest and longest words of its terms; all letters."""
    nodes = [(trie, 0)]
    for node, depth in nodes:
        nodes.extend((child, depth + 1) for c, child in node.items() if c != "")
    found: dict[int, tuple[int, int, int]] = {}
    for node, depth in reversed(nodes):
        below = [found[id(child)] for c, child in node.items() if c != ""]
        if "" in node:
            below.append((allowed(node[""]), depth, depth))
        edits, short, long = zip(*below)
        found[id(node)] = max(edits), min(short), max(long)
    return found, {c for node, _ in nodes for c in node if c != ""}


def nearest_terms(tokens: list[str], trie: dict) -> list[str | None]:
    """``nearest_term`` of each token, all of PLACES letters at most walking through the trie together."""
    if not trie:
        return [None] * len(tokens)
    reach, alphabet = _reach(trie)
    together = max(1, min(TOGETHER, SETS // len(alphabet)))
    found = [None if len(t) <= PLACES else nearest_term(t, trie) for t in tokens]
    at = [k for k, t in enumerate(tokens) if len(t) <= PLACES]
    for k in range(0, len(at), together):
        _walk(at[k:k + together], tokens, trie, reach, alphabet, found)
    return found


def _walk(
    which: list[int], tokens: list[str], trie: dict, reach: dict, alphabet: set[str], found: list[str | None]
) -> None:
    """Put the terms of the tokens numbered in ``which`` into ``found``.

    The sets of ``nearest_term``, an array for each, over the tokens that still have places;
    nodes are seen in its order, and a token's first term is kept.
    """
    words = [tokens[k] for k in which]
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    codes = code_points(words)
    number = {c: r for r, c in enumerate(sorted(alphabet))}
    known = code_points(list(number))
    rank = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    held = known[rank] == codes
    owner = np.repeat(np.arange(n), lengths)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    # The last row, before a first letter, stays empty.
    places = np.zeros((len(known) + 1, n), dtype=np.uint64)
    np.bitwise_or.at(places, (rank[held], owner[held]), np.uint64(2) << place[held].astype(np.uint64))
    one, two = np.uint64(1), np.uint64(2)
    end = one << lengths.astype(np.uint64)
    full = (end << one) - one
    open_ = np.ones(n, dtype=bool)
    none = np.zeros(n, dtype=np.uint64)
    stack = [(trie, np.arange(n), [none + one, none + np.uint64(3), none + np.uint64(7)], [none, none], len(known))]
    while stack:
        node, ids, now, before, last = stack.pop()
        most, short, long = reach[id(node)]
        stay = open_[ids] & (lengths[ids] >= short - most) & (lengths[ids] <= long + most)
        if not stay.all():
            ids = ids[stay]
            now, before = [x[stay] for x in now], [x[stay] for x in before]
        if not len(ids):
            continue
        if "" in node:
            ended = now[0] & end[ids]
            for k in range(1, allowed(node[""]) + 1):
                ended |= now[k] & end[ids]
            for k in ids[ended != 0].tolist():
                found[which[k]] = node[""]
            open_[ids[ended != 0]] = False
        for c, below in node.items():
            if c == "":
                continue
            letter = number[c]
            at = places[letter, ids]
            swapped = (at << one) & places[last, ids]
            after = [(now[0] << one) & at]
            # No term below may have more edits than ``reach`` says.
            for k in range(1, reach[id(below)][0] + 1):
                after.append((
                    ((now[k] << one) & at) | now[k - 1] | (now[k - 1] << one) | (after[k - 1] << one)
                    | ((before[k - 1] << two) & swapped)
                ) & full[ids])
            alive = after[0]
            for x in after[1:]:
                alive = alive | x
            alive = alive != 0
            if alive.any():
                stack.append((below, ids[alive], [x[alive] for x in after], [x[alive] for x in now[:2]], letter))


EXACT, FUZZY = 1, 2
TERM_ROWS = "doc_id long, toxic int, term string"


def misspelt(words: list[str], lexicon: Lexicon) -> dict[str, str]:
    """The words that are misspellings, with a term that each stands for."""
    by_length: dict[int, list[str]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    # An edit brings one letter at most and takes one at most; only words within are walked through the trie.
    near: list[str] = []
    for length, same in by_length.items():
        if length and length in lexicon.near:
            masks = letters(same)
            fits = np.zeros(len(same), dtype=bool)
            for mask, edits in lexicon.near[length]:
                fits |= (np.bitwise_count(masks & ~mask) <= edits) & (np.bitwise_count(mask & ~masks) <= edits)
            near.extend(same[k] for k in np.flatnonzero(fits).tolist())
    return {word: term for word, term in zip(near, nearest_terms(near, lexicon.trie)) if term}


def quoted_places(tokens: list[str]) -> set[int]:
    """Tokens that stand in quotations, which end within QUOTED tokens."""
    found: set[int] = set()
    begin, mark = 0, ""
    for k, token in enumerate(tokens):
        if mark and k - begin > QUOTED:
            mark = ""
        bare = token.lstrip("([")
        if not mark and bare[:1] and bare[0] in QUOTES:
            begin, mark = k, CLOSING[bare[0]]
            token = bare[1:]
        # A quotation ends with its mark, behind or before the sentence's.
        if mark and (token.rstrip(".,;:!?)]")[-1:] or " ") in mark:
            found.update(range(begin, k + 1))
            mark = ""
    return found


def matches(words: list[str], lexicon: Lexicon) -> dict[str, int]:
    """EXACT or FUZZY for those tokens that are hits; tokens as ``core_of`` leaves them."""
    whole, stems = lexicon.words, lexicon.stems
    found = {w: EXACT for w in words if w in whole}
    for k in STEMS if stems else ():
        found.update((w, EXACT) for w in words if w[:k] in stems)
    rest = [w for w in words if w not in found]
    if lexicon.swaps:
        found.update(dict.fromkeys(misspelt(rest, lexicon), FUZZY))
        return found
    for token in rest:
        if len(token) >= FUZZY_LENGTH - 1 and (
            any(token[:k] in lexicon.halves for k in range(2, 1 + len(token) // 2 + 1))
            or any("$" + token[-k:] in lexicon.halves for k in range(2, 2 + (len(token) + 1) // 2 + 1))
        ) and within_one_edit(token, lexicon.trie):
            found[token] = FUZZY
    return found


def match(token: str, lexicon: Lexicon) -> int:
    """0, EXACT or FUZZY for a token without its outer punctuation, in lower case."""
    return matches([token], lexicon).get(token, 0)


def tokens_held(texts: Iterable[str | None]) -> Iterator[list[list[str]]]:
    """The tokens of each text, for as many texts at a time as reach HELD characters."""
    held: list[list[str]] = []
    size = 0
    for text in texts:
        held.append(TOKEN.findall(text or ""))
        size += len(text or "")
        if size >= HELD:
            yield held
            held, size = [], 0
    yield held


class Matcher:
    """Hits of a lexicon in texts, with the tokens seen before remembered."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.seen: set[str] = set()
        self.kinds: dict[str, int] = {}

    def _judge(self, tokens: set[str]) -> None:
        """Have the kinds of all hits among ``tokens``."""
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
            self.kinds.clear()
        new = tokens - self.seen
        self.seen |= new
        cores = {t: core_of(t) for t in new}
        found = matches([w for w in set(cores.values()) if w], self.lexicon)
        self.kinds.update((t, found[w]) for t, w in cores.items() if w in found)

    def hits(self, text: str | None) -> list[float]:
        """Direct exact, direct fuzzy, quoted hits, tokens."""
        return next(self.all_hits([text]))

    def all_hits(self, texts: Iterable[str | None]) -> Iterator[list[float]]:
        """``hits`` of each text."""
        for held in tokens_held(texts):
            self._judge(set().union(*held))
            yield from map(self._counts, held)

    def _counts(self, tokens: list[str]) -> list[float]:
        exact = fuzzy = quoted = 0
        if not self.kinds.keys().isdisjoint(tokens):
            inside = quoted_places(tokens)
            for k, token in enumerate(tokens):
                kind = self.kinds.get(token)
                if not kind:
                    continue
                near = tokens[max(0, k - CONTEXT):k + CONTEXT + 1]
                if k in inside or any(core_of(t) in REPORTING for t in near):
                    quoted += 1
                elif kind == EXACT:
                    exact += 1
                else:
                    fuzzy += 1
        return [float(exact), float(fuzzy), float(quoted), float(len(tokens))]


@dataclass(frozen=True)
class Model:
    """A lexicon and the weights of its hits."""

    lexicon: Lexicon
    fuzzy_worth: float
    weights: np.ndarray

    def features(self, hits: np.ndarray) -> np.ndarray:
        direct = hits[:, 0] + self.fuzzy_worth * hits[:, 1]
        return np.stack(
            [np.ones(len(hits)), np.log1p(direct), np.minimum(direct, 1), np.log1p(hits[:, 2])], axis=1
        )

    def score(self, hits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(hits) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 50) -> np.ndarray:
    """Weights of a ridge-regularised logistic model by Newton's method; column 0 is free."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-4
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _terms_of(text: str | None) -> set[str]:
    cores = map(core_of, set(TOKEN.findall(text or "")))
    words = {w for w in cores if len(w) > 2}
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) >= k}


def _term_rows(wanted: frozenset[str] | None):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                terms = _terms_of(batch.column("text")[k].as_py())
                terms = sorted(terms if wanted is None else terms & wanted)
                n = len(terms)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([batch.column("doc_id")[k].as_py()] * n, pa.int64()),
                    "toxic": pa.array([batch.column("toxic")[k].as_py()] * n, pa.int32()),
                    "term": pa.array(terms, pa.string()),
                })

    return run


def _near_rows(lexicon: Lexicon):
    """The terms that documents' words are taken for misspellings of."""

    def run(batches):
        for batch in batches:
            found: set[str] = set()
            for held in tokens_held(text.as_py() for text in batch.column("text")):
                words = [w for w in set(map(core_of, set().union(*held))) if w]
                exact = {w for w, kind in matches(words, lexicon).items() if kind == EXACT}
                found.update(misspelt([w for w in words if w not in exact], lexicon).values())
            yield pa.RecordBatch.from_pydict({"term": pa.array(sorted(found), pa.string())})

    return run


def _hit_rows(lexicon: Lexicon):
    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            hits = list(matcher.all_hits(text.as_py() for text in batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(hits, pa.list_(pa.float64()))], names=["toxic", "hits"]
            )

    return run


def _copy_groups(holds: dict[int, set[str]]) -> dict[int, int]:
    """The group of each document: documents sharing COPIES telling words, and so on."""
    group = {d: d for d in holds}

    def root(d: int) -> int:
        while group[d] != d:
            group[d] = group[group[d]]
            d = group[d]
        return d

    words = {d: {t for t in terms if not t.endswith("*")} for d, terms in holds.items()}
    last: dict[str, int] = {}
    for d in sorted(holds):
        for t in words[d]:
            if t in last and root(d) != root(last[t]) and len(words[d] & words[last[t]]) >= COPIES:
                group[root(d)] = root(last[t])
            last[t] = d
    return {d: root(d) for d in holds}


def _tail(hits: int, tries: int, share: float) -> float:
    """Chance of ``hits`` or more in ``tries``."""
    return sum(
        comb(tries, k) * share ** k * (1 - share) ** (tries - k) for k in range(hits, tries + 1)
    )


def telling(
    counts: dict[str, tuple[int, int]], alike: dict[int, int], holds: dict[int, set[str]], share: float
) -> list[str]:
    """Terms that toxic documents hold too often for chance.

    ``counts``: documents of either kind; ``alike``: how many terms are held by so many
    documents; ``holds``: the toxic documents' terms; ``share``: of the toxic in the sample.
    Beginnings that repeat one word or start with a shorter one are left out.
    """
    group = _copy_groups(holds)
    groups: dict[str, set[int]] = {}
    for d, terms in holds.items():
        for t in terms:
            groups.setdefault(t, set()).add(group[d])
    kept = []
    for t, (toxic, clean) in counts.items():
        support = len(groups.get(t, ()))
        if support < 2:
            continue
        rivals = max(alike.get(support + clean, 1), alike.get(toxic + clean, 1))
        if rivals * _tail(support, support + clean, share) < CHANCE:
            kept.append(t)
    # A beginning must stand for several words, not repeat one.
    most: dict[str, int] = {}
    for t in groups:
        if not t.endswith("*"):
            for k in STEMS:
                most[t[:k]] = max(most.get(t[:k], 0), len(groups[t]))
    stems = {
        t[:-1] for t in kept
        if t.endswith("*") and len(groups[t]) >= 1.5 * most.get(t[:-1], 0)
    }
    stems = {s for s in stems if not any(s[:k] in stems for k in STEMS if k < len(s))}
    return sorted(t for t in kept if not t.endswith("*")) + sorted(f"{s}*" for s in stems)


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of at most TOXIC_SAMPLE + CLEAN_SAMPLE labelled documents."""
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    picked = [
        known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for label, most in ((1, TOXIC_SAMPLE), (0, CLEAN_SAMPLE))
    ]
    ids = F.broadcast(picked[0].union(picked[1]))
    return docs.select("doc_id", "text").join(ids, "doc_id")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    kept = scratch_path(spark, "toxicity")
    sample_of(docs, labels).write.parquet(kept)
    sample = spark.read.schema("doc_id long, text string, toxic int").parquet(kept)
    kept_counts = scratch_path(spark, "toxicity-terms")
    (
        sample.mapInArrow(_term_rows(None), TERM_ROWS).groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .write.parquet(kept_counts)
    )
    counted = spark.read.schema("term string, toxic long, clean long").parquet(kept_counts)
    # The sample bounds how many these are.
    candidates = counted.where("toxic >= 2 and clean * 20 <= toxic").collect()
    counts = {r["term"]: (r["toxic"], r["clean"]) for r in candidates}
    alike = {
        r["held"]: r["count"]
        for r in counted.groupBy((F.col("toxic") + F.col("clean")).alias("held")).count().collect()
    }
    holds = {
        r["doc_id"]: set(r["terms"])
        for r in sample.where("toxic = 1").mapInArrow(_term_rows(frozenset(counts)), TERM_ROWS)
        .groupBy("doc_id").agg(F.collect_set("term").alias("terms")).collect()
    }
    sizes = sample.groupBy("toxic").count().collect()
    total = sum(r["count"] for r in sizes)
    share = sum(r["count"] for r in sizes if r["toxic"]) / max(1, total)
    terms = telling(counts, alike, holds, share)
    # Terms that clean texts come near to by chance are matched exactly only.
    near = sample.where("toxic = 0").mapInArrow(_near_rows(Lexicon.of(terms, terms, swaps=True)), "term string")
    loose = {r["term"] for r in near.groupBy("term").count().collect()}
    lexicon = Lexicon.of(terms, [t for t in terms if t not in loose], swaps=True)
    rows = sample.mapInArrow(_hit_rows(lexicon), "toxic int, hits array<double>").collect()
    hits = np.array([r["hits"] for r in rows], dtype=float).reshape(len(rows), 4)
    y = np.array([r["toxic"] for r in rows], dtype=float)
    # What a misspelt hit is worth beside an exact one: how often it told the truth alone.
    alone = (hits[:, 0] == 0) & (hits[:, 1] > 0)
    worth = float((y[alone].sum() + 1) / (alone.sum() + 2))
    model = Model(lexicon, worth, np.zeros(4))
    weights = logistic(model.features(hits), y) if len(y) else np.zeros(4)
    return Model(lexicon, worth, weights)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.lexicon)
        for batch in batches:
            hits = list(matcher.all_hits(text.as_py() for text in batch.column("text")))
            found = np.array(hits, dtype=float).reshape(batch.num_rows, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(found)),
                 *(pa.array(found[:, k].astype(np.int64)) for k in range(3))],
                names=["doc_id", "score", "n_exact", "n_misspelt", "n_quoted"],
            )

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, hit counts) for every row of ``docs``."""
    scored = docs.select("doc_id", "text").mapInArrow(
        _scored(learn(docs, labels)),
        "doc_id long, score double, n_exact long, n_misspelt long, n_quoted long",
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_exact", "n_misspelt", "n_quoted",
    )
