"""SentencePiece encoding and decoding with a given model, words encoded in a relational lattice.

A model's pieces never reach across the start of a word, so texts are cut into words, and
each distinct word is encoded once: its substrings up to the longest piece are exploded and
equi-joined to the piece table, the matches are grouped by word as the edges of a lattice,
and a higher-order aggregate folds the lattice to one path.  ``viterbi`` folds to the path of
the greatest total score, as models of kind unigram ask.  The supplied model is of kind BPE,
for which that path is wrong (README has figures); ``merged`` folds in the order of its
merges instead: of the inner boundaries whose two neighbours make an edge, the one with the
best score goes, the leftmost of equals, until none is left.

Texts are dealt into blocks of bounded size, compressed, and shuffled once; a block's distinct
words leave it, are encoded with those of all other blocks, and the pieces come back to the
block, so no task needs the vocabulary of the whole corpus.

Characters without a piece become their UTF-8 bytes' pieces.  Nulls count as empty texts,
which have no pieces.  U+2581 is the model's own sign for a space and decodes as one, as in the
model's library.  Repeated rows and ids are encoded alike, very long texts whole; empty tables
give empty results.  Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapespark.llm.common import release, tidy

#: The model's file; only the driver reads it.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SIGN = "▁"
#: Words longer than this are folded with a heap: the fold's time grows with their square.
LONG = 120
NO_EDGE = 1 << 60
UNKNOWN = 1 << 40
BYTE = re.compile("<0x[0-9A-F]{2}>")
#: Partitions of words per shuffle partition: a word has many substrings, which are sorted in memory.
SPREAD = 2
#: Bytes of text in a block, whose words and ids a task holds, and in a task's unsent packs.
BLOCK = 16 << 20
PACK = 24 << 20
#: How hard packs are compressed.
LEVEL = 5
#: Repeats of a row that go to one block.
REPEATS = 64
#: An edge in one number: from these bits on its id, its end, its start (7 bits each) and its rank.
END_AT, START_AT, RANK_AT = 20, 27, 34
MOST_RANK = 1 << 24

#: A word begins at a run of signs; a line feed is a word of its own, as no piece holds one.
WORD = re.compile(f"{SIGN}+[^{SIGN}\n]*|[^{SIGN}\n]+|\n")
#: Words cut further where letters meet other characters, for models without pieces of both.
#: Raised digits count as letters in patterns, but stand beside full stops in pieces.
LETTER, OTHER = r"[^\W\d_¹²³]", rf"(?:[^\w{SIGN}\n]|[\d_¹²³])"
LETTERS = re.compile(f"{SIGN}*{LETTER}+|{SIGN}*{OTHER}+|{SIGN}+|\n")
MIXED = re.compile(f"{LETTER}{OTHER}|{OTHER}{LETTER}")


def read_pieces(path: str = MODEL) -> dict[str, tuple[int, float]]:
    """(id, score) of every ordinary piece, and of ``<0x..>`` for bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(k): (k, model.get_score(k))
        for k in range(model.get_piece_size())
        if not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k))
    }


def is_bpe(pieces: dict[str, tuple[int, float]]) -> bool:
    """Whether scores are ranks of merges: whole numbers, other than the likelihoods of unigram models."""
    return all(score == int(score) for _, score in pieces.values())


def piece_table(spark: SparkSession, pieces: dict[str, tuple[int, float]]) -> DataFrame:
    """(piece, id, rank): rank 0 is the best score.  Bytes are left out.

    Ranks are whole: scores that are not are told in millionths.  Ranks beyond MOST_RANK, such as
    those of pieces that no text should be cut into, keep their order only.
    """
    best = max((score for _, score in pieces.values()), default=0.0)
    scale = 1 if is_bpe(pieces) else 1_000_000
    ranks = {piece: round((best - score) * scale) for piece, (_, score) in pieces.items() if not BYTE.fullmatch(piece)}
    beyond = {rank: MOST_RANK + k for k, rank in enumerate(sorted({r for r in ranks.values() if r > MOST_RANK}), 1)}
    rows = [(piece, pieces[piece][0], beyond.get(rank, rank)) for piece, rank in ranks.items()]
    return spark.createDataFrame(rows, "piece string, id int, rank long")


def word_pattern(pieces: dict[str, tuple[int, float]]) -> re.Pattern:
    """How a model's texts are cut into words that no piece reaches across."""
    ordinary = (p for p in pieces if not BYTE.fullmatch(p))
    return WORD if any(MIXED.search(p) or "\n" in p[:-1] or "\n" in p[1:] for p in ordinary) else LETTERS


def words_of(text: str | None, pattern: re.Pattern) -> list[str]:
    return pattern.findall(SIGN + text.replace(" ", SIGN)) if text else []


def chunked(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Texts' stretches between spaces in order, and how many each text has; words never reach across one.

    Runs of spaces belong to words, as do signs that stand in a text: such texts are one chunk, with
    signs in place of its spaces.
    """
    odd = pc.or_(
        pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.match_substring(texts, SIGN)
    )
    whole = pc.if_else(odd, pc.replace_substring(texts, " ", SIGN), texts)
    cut = pc.split_pattern(pc.if_else(pc.equal(texts, ""), None, whole), " ")
    counts = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return pc.dictionary_encode(pc.list_flatten(cut)), counts


def _texts(packs: Iterable[pa.Scalar], place: int) -> pa.Array:
    """The texts of packs, nulls being empty."""
    columns = [pc.fill_null(_unpacked(pack.as_py()).column(place).cast(pa.large_string()), "") for pack in packs]
    chunks = [chunk for column in columns for chunk in column.chunks]
    return pa.concat_arrays(chunks) if chunks else pa.array([], pa.large_string())


def chunk_words(chunk: str, pattern: re.Pattern) -> Sequence[str]:
    """The words of a chunk, before which a sign stands as before every text."""
    if chunk.isalpha():
        return (SIGN + chunk,)
    if not chunk:
        return (SIGN,)
    if pattern == LETTERS and chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
        return SIGN + chunk[:-1], chunk[-1]
    return words_of(chunk, pattern)


def _edge(edges: Column, start: Column, end: Column) -> Column:
    """The edge from ``start`` to ``end``; null if there is none."""
    return F.element_at(edges, start * (LONG + 1) + end)


def merged(edges: Column, length: Column) -> Column:
    """Boundaries 0, ..., length of the pieces that merging in order of rank leaves.

    Beside the boundaries the fold keeps what merging across each would make, so a merge looks
    up the two boundaries beside it only.
    """

    def across(at: Column, left: Column, right: Column) -> Column:
        found = _edge(edges, F.get(at, left), F.coalesce(F.get(at, right), F.lit(0)))
        return F.coalesce(found, F.lit(NO_EDGE))

    first = F.concat(
        F.array(F.lit(NO_EDGE)),
        F.transform(F.sequence(F.lit(1), length), lambda k: F.coalesce(_edge(edges, k - 1, k + 1), F.lit(NO_EDGE))),
    )
    start = F.struct(F.sequence(F.lit(0), length).alias("at"), first.alias("made"))

    def step(state: Column, _):
        at, made = state["at"], state["made"]

        # ``k`` counts places from 1: the leftmost of the boundaries whose merge has the best rank.
        def without(k: Column) -> Column:
            return F.struct(
                F.concat(F.slice(at, 1, k - 1), F.slice(at, k + 1, F.size(at))).alias("at"),
                F.concat(
                    F.slice(made, 1, F.greatest(k - 2, F.lit(0))),
                    F.array(
                        F.when(k > 2, across(at, k - 3, k)).otherwise(F.lit(NO_EDGE)),
                        F.when(k < F.size(at) - 1, across(at, k - 2, k + 1)).otherwise(F.lit(NO_EDGE)),
                    ),
                    F.slice(made, k + 2, F.size(at)),
                ).alias("made"),
            )

        # A one-element array gives the place a name, so it is sought once.
        place = F.array(F.array_position(made, F.array_min(made)).cast("int"))
        return F.get(F.transform(
            place, lambda k: F.when(F.get(made, k - 1) >= NO_EDGE, state).otherwise(without(k))
        ), F.lit(0))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(length - 1, F.lit(1))), start, step, lambda state: state["at"])


#: Words of up to so many characters have their boundaries in the bits of one number.
NARROW = 60


def merged_in_order(edges: Column, order: Column, length: Column) -> Column:
    """As ``merged``, by one fold over the edges in order of rank, or null.

    ``order``: the edges, which as numbers are sorted by rank and place.  The boundaries are the bits of a number, and an edge merges where its ends are
    boundaries with one boundary between them.  A merge may make way for an edge that has been
    passed, which only merging edge by edge gets right: the result is null then.
    """
    one = F.lit(1).cast("long")
    late = one * (-1 << 63)

    def bit(place: Column, of: Column = one) -> Column:
        return F.call_function("shiftleft", of, place)

    def passed(rank: Column, start: Column, end: Column) -> Column:
        found = F.shiftright(_edge(edges, start, end), RANK_AT)
        return F.coalesce(found < rank, F.lit(False))

    def step(mask: Column, code: Column) -> Column:
        start, end = (F.shiftright(code, at).bitwiseAND(127).cast("int") for at in (START_AT, END_AT))
        inner = mask.bitwiseAND(bit(end) - bit(start, F.lit(2).cast("long")))
        ends = bit(end) + bit(start)
        # The boundaries behind and before: the lowest bit above the end, the highest below the start.
        above = mask.bitwiseAND(F.lit((1 << 63) - 1)).bitwiseAND(-bit(end, F.lit(2).cast("long")))
        below = mask.bitwiseAND(bit(start) - 1)
        behind = F.bit_count(above.bitwiseAND(-above) - 1)
        # With the second bit cleared no rounding reaches the next power of two.
        before = F.floor(F.log2(below.bitwiseAND(F.bitwise_not(F.shiftright(below, 1))).cast("double"))).cast("int")
        rank = F.shiftright(code, RANK_AT)
        lost = ((above != 0) & passed(rank, start, behind)) | ((below != 0) & passed(rank, before, end))
        return F.when(
            (mask >= 0) & (F.bit_count(inner) == 1) & (mask.bitwiseAND(ends) == ends),
            F.when(lost, late).otherwise(mask.bitwiseXOR(inner)),
        ).otherwise(mask)

    mask = F.aggregate(order, bit(length + 1) - 1, step)
    named = F.array(mask)
    return F.get(F.transform(named, lambda m: F.when(
        m >= 0, F.filter(F.sequence(F.lit(0), length), lambda k: m.bitwiseAND(bit(k)) != 0)
    )), F.lit(0))


def viterbi(edges: Column, length: Column) -> Column:
    """Boundaries of the path with the least sum of ranks; a character without edge costs UNKNOWN.

    Of equal paths the one whose last piece is longest is kept, at every place.
    """
    start = F.array(F.struct(F.lit(0).cast("long").alias("cost"), F.lit(-1).alias("back")))

    def step(best: Column, end: Column):
        options = F.transform(
            F.sequence(F.lit(0), end - 1),
            lambda s: F.struct(
                (F.get(best, s)["cost"] + F.coalesce(
                    F.shiftright(_edge(edges, s, end), RANK_AT), F.when(s == end - 1, F.lit(UNKNOWN))
                )).alias("cost"),
                s.alias("back"),
            ),
        )
        return F.concat(best, F.array(F.array_min(F.filter(options, lambda o: o["cost"].isNotNull()))))

    table = F.aggregate(F.sequence(F.lit(1), length), start, step)
    back = F.aggregate(
        F.sequence(F.lit(1), length), F.array(length),
        lambda path, _: F.when(F.get(path, F.lit(0)) > 0, F.concat(
            F.array(F.get(table, F.get(path, F.lit(0)))["back"]), path)).otherwise(path),
    )
    return back


def _byte_ids(text: Column, first: int) -> Column:
    """Ids of a character's bytes, the piece of byte 0 being ``first``."""
    return F.transform(
        F.split(F.hex(F.encode(text, "UTF-8")), "(?<=\\G..)(?!$)"),
        lambda h: F.conv(h, 16, 10).cast("int") + first,
    )


def encode_words(words: DataFrame, pieces: DataFrame, longest: int, first_byte: int, fold=merged) -> DataFrame:
    """(word, ids) of distinct ``words`` of up to LONG characters."""
    n = F.length("word")
    # Places of substrings are numbers, so nothing but matching ones leave compiled code.
    # A number of the word comes first among the keys, as numbers are sorted faster than texts.
    asked = words.select(F.xxhash64("word").alias("h"), "word", F.explode(F.sequence(F.lit(0), n * longest - 1)).alias("k")).select(
        "h", "word", F.expr(f"k div {longest}").cast("int").alias("start"), (F.col("k") % longest + 1).alias("width")
    ).where(F.col("start") + F.col("width") <= n).select(
        "h", "word", "start", "width", F.substring(F.col("word"), F.col("start") + 1, F.col("width")).alias("piece")
    )
    # Joined by a hash, which is a number, and confirmed on the text.
    told = pieces.select(F.xxhash64("piece").alias("key"), F.col("piece").alias("known"), "id", "rank")
    same = (F.xxhash64("piece") == F.col("key")) & F.startswith("piece", "known") & (F.length("known") >= F.col("width"))
    met = asked.join(F.broadcast(told), same, "left").where("id is not null or (start = 0 and width = 1)")
    edge = F.shiftleft("rank", RANK_AT) + F.shiftleft(F.col("start").cast("long"), START_AT)
    edge = edge + F.shiftleft((F.col("start") + F.col("width")).cast("long"), END_AT) + F.col("id")
    # Edges alone are sorted and gathered; a word without any has none in its list.
    order = met.select("h", "word", edge.alias("edge")).groupBy("h", "word").agg(
        F.sort_array(F.collect_list("edge")).alias("order")
    )
    place = F.transform("order", lambda e: (
        F.shiftright(e, START_AT).bitwiseAND(127) * (LONG + 1) + F.shiftright(e, END_AT).bitwiseAND(127)
    ).cast("int"))
    edges = order.withColumn("edges", F.map_from_arrays(place, "order"))
    path = fold(F.col("edges"), n)
    if fold is merged:
        short = F.when(n <= NARROW, merged_in_order(F.col("edges"), F.col("order"), n))
        path = F.coalesce(short, path)
    path = edges.withColumn("path", path)
    ids = F.transform(
        F.sequence(F.lit(1), F.size("path") - 1),
        lambda k: _edge(F.col("edges"), F.get("path", k - 1), F.get("path", k)).bitwiseAND((1 << END_AT) - 1).cast("int"),
    )
    known = path.withColumn("ids", ids)
    full = F.flatten(F.transform(
        "ids",
        lambda i, k: F.when(i.isNotNull(), F.array(i)).otherwise(
            _byte_ids(F.substring(F.col("word"), F.get("path", k) + 1, F.lit(1)), first_byte)
        ),
    ))
    return known.select(
        "word", F.when(F.exists("ids", lambda i: i.isNull()), full).otherwise(F.col("ids")).alias("ids")
    )


def merge_long(word: str, pieces: dict[str, tuple[int, float]]) -> list[str]:
    """The pieces of a long word by the rule of ``merged``, with a heap of candidates."""
    parts: list[str | None] = list(word)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(k: int) -> None:
        if k >= 0 and after[k] < len(parts):
            whole = parts[k] + parts[after[k]]
            if whole in pieces:
                heapq.heappush(heap, (-pieces[whole][1], k, whole))

    for k in range(len(parts) - 1):
        offer(k)
    while heap:
        _, k, whole = heapq.heappop(heap)
        if parts[k] is None or after[k] >= len(parts) or parts[k] + parts[after[k]] != whole:
            continue
        gone = after[k]
        parts[k], parts[gone] = whole, None
        after[k] = after[gone]
        if after[gone] < len(parts):
            before[after[gone]] = k
        offer(before[k])
        offer(k)
    return [p for p in parts if p is not None]


def ids_of(parts: list[str], pieces: dict[str, tuple[int, float]]) -> list[int]:
    found: list[int] = []
    for part in parts:
        if part in pieces:
            found.append(pieces[part][0])
        else:
            found.extend(pieces[f"<0x{b:02X}>"][0] for b in part.encode("utf-8", "surrogatepass"))
    return found


PACKS = "block int, pack binary"


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(pack: bytes) -> pa.Table:
    return pa.ipc.open_stream(pack).read_all()


def _packs(batches: Iterator[pa.RecordBatch], block_of, most: int) -> Iterator[pa.RecordBatch]:
    """Compressed packs of the batches' rows by block; ``block_of`` numbers a batch's rows.

    The block numbers' column is the first one and is not packed.
    """

    def told(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        blocks = table.column(0).combine_chunks().to_numpy(zero_copy_only=False)
        table = table.select(range(1, table.num_columns))
        order = np.argsort(blocks, kind="stable")
        known, cuts = np.unique(blocks[order], return_index=True)
        cuts = np.append(cuts, len(order))
        table = table.take(pa.array(order))
        packs = [_packed(table.slice(a, b - a)) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        return pa.RecordBatch.from_arrays([pa.array(known, pa.int32()), pa.array(packs, pa.binary())], names=["block", "pack"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        blocks = pa.array(block_of(batch), pa.int32())
        held.append(pa.RecordBatch.from_arrays([blocks, *batch.columns[1:]], names=["", *batch.schema.names[1:]]))
        size += batch.nbytes
        if size >= most:
            yield told(held)
            held, size = [], 0
    if held:
        yield told(held)


def _text_packs(blocks: int):
    """Rows (their hash first) in packs by block: by content, so that a lost task is dealt the same way again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, int] = {}

        def block_of(batch: pa.RecordBatch) -> list[int]:
            dealt = []
            for number in batch.column(0).to_pylist():
                # Repeats of a row are dealt on, so that no block takes all of them.
                repeat = met.get(number, 0)
                met[number] = repeat + 1
                dealt.append((number + repeat // REPEATS) % blocks)
            return dealt

        return _packs(batches, block_of, PACK)

    return run


PAIRS = "block int, word string, own array<int>"


def _block_words(place: int, pattern: re.Pattern, pieces: dict[str, tuple[int, float]]):
    """The distinct words of every block; blocks come in order, texts are column ``place`` of their packs.

    Words beyond LONG come with their ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(block: int | None, packs: list[pa.Scalar]) -> Iterator[pa.RecordBatch]:
            texts = _texts(packs, place)
            packs.clear()
            chunks, _ = chunked(texts)
            words: set[str] = set()
            for chunk in chunks.dictionary.to_pylist():
                words.update(chunk_words(chunk, pattern))
            del chunks, texts
            ordered = sorted(words)
            for k in range(0, len(ordered), 50_000):
                part = ordered[k:k + 50_000]
                own = [ids_of(merge_long(w, pieces), pieces) if len(w) > LONG else None for w in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(part), pa.int32()), pa.array(part, pa.string()), pa.array(own, pa.list_(pa.int32()))],
                    names=["block", "word", "own"],
                )

        current, packs = None, []
        for batch in batches:
            for block, pack in zip(batch.column("block").to_pylist(), batch.column("pack")):
                if block != current:
                    yield from told(current, packs)
                    current = block
                packs.append(pack)
        yield from told(current, packs)

    return run


def _word_packs(kind: pa.DataType):
    """Words with their ids, as numbers of ``kind``, in packs by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = (
            pa.RecordBatch.from_arrays([*b.columns[:2], b.column(2).cast(pa.list_(kind))], names=b.schema.names) for b in batches
        )
        return _packs(narrow, lambda batch: batch.column(0), PACK)

    return run


class Ragged:
    """Lists of numbers one behind the other, gathered by their places."""

    def __init__(self, flat: np.ndarray, counts: np.ndarray):
        self.flat, self.counts = flat, counts.astype(np.int64)
        self.begins = np.cumsum(self.counts) - self.counts

    def gathered(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at ``places`` in one array, and where each ends in it."""
        many = self.counts[places]
        ends = np.cumsum(many)
        # Every number's place: its list's begin and its place in the list.
        return self.flat[np.repeat(self.begins[places] - (ends - many), many) + np.arange(many.sum())], ends

    def joined(self, places: np.ndarray, sizes: np.ndarray) -> Ragged:
        """Lists of lists: of the lists at ``places``, so many joined at a time."""
        flat, ends = self.gathered(places)
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return Ragged(flat, np.diff(cuts))


def _decoded(lists: Ragged, names: Ragged) -> pa.Array:
    """The texts of lists of ids, names holding spaces in place of signs."""
    texts = names.joined(lists.flat, lists.counts)
    # The space with which every text begins is the model's own.
    first = texts.begins[texts.counts > 0]
    first = first[texts.flat[first] == 32]
    kept = np.ones(len(texts.flat), dtype=bool)
    kept[first] = False
    cuts = np.append(texts.begins, len(texts.flat))
    cuts -= np.searchsorted(first, cuts, side="left")
    return pa.Array.from_buffers(
        pa.large_string(), len(texts.counts), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(texts.flat[kept].tobytes())]
    )


_KNOWN = {"word": pa.string(), "ids": pa.list_(pa.int32())}


def _encoded(place: int, schema: pa.Schema, pattern: re.Pattern, names: list[bytes] | None):
    """A block's rows with ids, looked up among the block's words; with ``names`` decoded again."""

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        tables = [_unpacked(pack.as_py()) for pack in told.column("pack")]
        if tables:
            known = pa.concat_tables(tables).combine_chunks()
            words, lists = (known.column(n).chunk(0) if known.num_rows else pa.array([], t) for n, t in _KNOWN.items())
        else:
            words, lists = (pa.array([], t) for t in _KNOWN.values())
        of_word = Ragged(lists.flatten().to_numpy().astype(np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
        packs = list(rows.column("pack"))
        chunks, counts = chunked(_texts(packs, place))
        parts, sizes = [], []
        for chunk in chunks.dictionary.to_pylist():
            found = chunk_words(chunk, pattern)
            parts.extend(found)
            sizes.append(len(found))
        places = pc.index_in(pa.array(parts, pa.string()), value_set=words).to_numpy(zero_copy_only=False)
        of_chunk = of_word.joined(places, np.array(sizes, dtype=np.int64))
        codes = chunks.indices.to_numpy(zero_copy_only=False)
        del parts, tables, words, lists
        spelled = None
        if names is not None:
            spaced = [name.replace(SIGN.encode(), b" ") for name in names]
            spelled = Ragged(np.frombuffer(b"".join(spaced), dtype=np.uint8), np.array([len(name) for name in spaced]))
        out, at, code_at = [], 0, 0
        for pack in packs:
            table = _unpacked(pack.as_py())
            here = counts[at:at + table.num_rows]
            of_text = of_chunk.joined(codes[code_at:code_at + here.sum()], here)
            at, code_at = at + table.num_rows, code_at + int(here.sum())
            offsets = pa.array(np.concatenate([[0], np.cumsum(of_text.counts)]).astype(np.int32))
            more = [pa.ListArray.from_arrays(offsets, pa.array(of_text.flat, pa.int32()))]
            if spelled is not None:
                more.append(_decoded(of_text, spelled).cast(pa.string()))
            columns = [*table.columns, *(pa.chunked_array([column]) for column in more)]
            out.append(pa.Table.from_arrays(columns, schema=schema))
        del of_word, of_chunk, chunks, codes
        release()
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def _numbered(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)]


def encode(
    docs: DataFrame, model: str = MODEL, blocks: int | None = None, fold=None, decoded: str | None = None
) -> DataFrame:
    """``docs`` with ``ids``: the pieces of every whole ``text``.  A column ``ids`` is replaced.

    ``blocks``: groups in which words are gathered; if unset as many as shuffle partitions, and
    more where BLOCK bytes of text a block ask for it.  ``fold``: ``merged`` or ``viterbi``, as
    the model's scores ask for if unset.  ``decoded``: a further column for what the ids decode to.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not blocks:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = max(parts, -(-size // BLOCK))
    pieces = read_pieces(model)
    table, pattern = piece_table(spark, pieces), word_pattern(pieces)
    fold = fold or (merged if is_bpe(pieces) else viterbi)
    longest = max(map(len, pieces), default=1)
    first_byte = pieces.get("<0x00>", (3, 0.0))[0]
    names = [c for c in docs.columns if c not in ("ids", decoded)]
    place = names.index("text")
    # Columns go by number into tasks, which take no name with a dot.
    hashed = docs.select(F.xxhash64("doc_id", "text").alias("dealt"), *_numbered(names))
    # Both branches read the same exchange of packs, and both readers of the pairs that of pairs:
    # what either asks of them is asked before the exchange, or of what it has aggregated.
    dealt = hashed.mapInArrow(tidy(_text_packs(blocks)), PACKS).repartition(max(parts, blocks), "block")
    pairs = (
        dealt.sortWithinPartitions("block").mapInArrow(tidy(_block_words(place, pattern, pieces)), PAIRS)
        .where("word is not null").repartition(SPREAD * max(parts, blocks), "word")
    )
    words = pairs.groupBy("word").agg(
        F.min("block").alias("least"), F.max(F.length("word")).alias("size"), F.count("own").alias("owned")
    ).where(f"least >= 0 and owned = 0 and size <= {LONG}").select("word")
    known = encode_words(words, table, longest, first_byte, fold)
    returned = pairs.join(known.hint("shuffle_hash"), "word", "left").select(
        "block", "word", F.coalesce("own", "ids").alias("ids")
    ).mapInArrow(tidy(_word_packs(pa.uint16() if max(k for k, _ in pieces.values()) < 1 << 16 else pa.int32())), PACKS)
    out = docs.select(*(F.col(f"`{n}`") for n in names)).schema.add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        out = out.add(decoded, "string")
    return (
        dealt.groupBy("block").cogroup(returned.groupBy("block"))
        .applyInArrow(_encoded(place, to_arrow_schema(out), pattern, piece_bytes(pieces) if decoded else None), out)
    )


def piece_bytes(pieces: dict[str, tuple[int, float]]) -> list[bytes]:
    """What each id stands for in a text, before signs become spaces."""
    names = [b""] * (max((k for k, _ in pieces.values()), default=0) + 1)
    for piece, (k, _) in pieces.items():
        names[k] = bytes([int(piece[3:5], 16)]) if BYTE.fullmatch(piece) else piece.encode("utf-8")
    return names


def decode_ids(ids: Iterable[int] | None, names: list[bytes]) -> str:
    """The text of a list of ids: signs become spaces, byte pieces join to characters."""
    text = b"".join(map(names.__getitem__, ids or ())).decode("utf-8", "replace").replace(SIGN, " ")
    return text[1:] if text.startswith(" ") else text


def decode(encoded: DataFrame, model: str = MODEL, out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``, the text of ``ids``."""
    names = piece_bytes(read_pieces(model))
    kept = [c for c in encoded.columns if c != out]
    schema = encoded.select(*(F.col(f"`{n}`") for n in kept)).schema.add(out, "string")
    place = kept.index("ids")

    def run(batches):
        for batch in batches:
            texts = [decode_ids(row.as_py(), names) for row in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out])

    return encoded.select(*_numbered(kept)).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, same): whether decoding the ids gives the text."""
    told = encode(docs.select("doc_id", "text"), model, decoded="decoded")
    return told.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same"),
    )
