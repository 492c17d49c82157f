"""Packing of documents into sequences of a fixed capacity, by Karmarkar-Karp differencing.

A document's ids are cut into chunks of the capacity, each a sequence of its own, and a
remainder.  Remainders are gathered until they fill WINDOWS windows but for SLACK ids each,
then divided: every piece is a partial partition with one loaded window, and the two partial
partitions of the greatest differences are merged again and again, the fullest windows of the
one with the emptiest of the other, until one is left.  If its fullest window exceeds the
capacity, the pieces are divided anew into one window more.  Three of four remainders stay
whole; every fourth is halved down to pieces of FINE ids, which even out the rest.

Each task packs the rows of its input partition, in their order, so nothing is shuffled and no
more than one group of windows is held; the last group of a partition is as large as what
is left.  Sequences carry the partition's number, so a task that is run again gives the same ones.

Null and empty texts are a document of the end id alone; very long texts are tokenized in
stretches cut before white space, where no word of the tokenizer can reach across.  Rows with
a null or repeated doc_id are documents of their own.  Empty tables give no pieces; columns
other than doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids of a sequence.
CAPACITY = 1024
#: Windows that are filled together, and the ids that each is spared on the average.
WINDOWS, SLACK = 64, 2
#: Every FOURTH remainder is halved down to pieces of FINE ids.
FOURTH, FINE = 4, 4
#: Ids that end a document and fill a sequence.
END, PAD = 0, 0
#: Characters tokenized at a time.
STRETCH = 1 << 20
#: No word of the tokenizer reaches from another character to white space behind it.
BREAK = re.compile(r"(?<=\S)(?=\s)")
#: White space here but not to the tokenizer; texts with these are not cut.
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Fixed value: how byte-level tokenizers of this kind cut texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of white space in a row that are too many for the fast way.
RUN = 1000

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """Pieces of at least ``size`` characters, cut between a character and white space."""
    at = 0
    while len(text) - at > size:
        cut = BREAK.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def byte_ranks(given: str) -> dict[bytes, int] | None:
    """The ids of a tokenizer's byte strings, if merging by id is all that it does; else None.

    Such a file is a byte-level BPE whose k-th merge makes id 256 + k; others give None.
    """
    told = json.loads(given)
    model, before = told["model"], told["pre_tokenizer"] or {}
    if told["normalizer"] or model["type"] != "BPE" or before.get("type") != "ByteLevel":
        return None
    if before["add_prefix_space"] or not before["use_regex"] or model["dropout"] or model["ignore_merges"]:
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocabulary = model["vocab"]
    if any(vocabulary.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    # Bytes that are no visible characters stand for themselves 256 and more places further on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    added = {token["content"] for token in told["added_tokens"]}
    return {bytes(byte[c] for c in token): k for token, k in vocabulary.items() if token not in added}


class Ids:
    """The tokenizer's ids of texts.

    Where the file is a plain byte-level BPE, texts are merged by ``tiktoken`` with the file's own
    ids as ranks, which gives the same ids in a quarter of the time.  Texts that hold a
    special token or a very long run of white space go through the tokenizer itself.
    """

    def __init__(self, given: str, ranks: dict[bytes, int] | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(given)
        self.merge = None
        if ranks is not None:
            import tiktoken

            made = tiktoken.Encoding("given", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            self.merge = made.encode_ordinary
            special = [re.escape(t["content"]) for t in json.loads(given)["added_tokens"]]
            self.odd = re.compile("|".join([*special, r"\s{%d,}" % RUN]))

    def of(self, text: str | None) -> np.ndarray:
        parts = [] if SEPARATORS.search(text or "") else stretches(text or "")
        parts = list(parts) or [text or ""]
        ids = array("I")
        for part in parts:
            if self.merge and not self.odd.search(part):
                ids.extend(self.merge(part))
            else:
                ids.extend(self.tokenizer.encode(part, add_special_tokens=False).ids)
        ids.append(END)
        return np.frombuffer(ids, dtype=np.uint32).astype("<u4", copy=False)


def differenced(sizes: list[int], windows: int) -> tuple[list[int], int]:
    """The window of each piece and the fullest window's load, by multiway differencing."""
    n = len(sizes)
    # Slots 0 .. n-1 hold one piece, slot n none; merged slots point to the two they joined.
    empty = n
    lefts, rights, made = [], [], n + 1
    heap = []
    for k, size in enumerate(sizes):
        loads = np.zeros(windows, dtype=np.int64)
        slots = np.full(windows, empty, dtype=np.int64)
        loads[0], slots[0] = size, k
        heap.append((-size if windows > 1 else 0, k, loads, slots))
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, loads, slots = heapq.heappop(heap)
        _, _, others, beside = heapq.heappop(heap)
        loads, beside = loads + others[::-1], beside[::-1]
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        lefts.append(slots[order])
        rights.append(beside[order])
        slots = np.arange(made, made + windows)
        made += windows
        heapq.heappush(heap, (int(loads[-1] - loads[0]), turn, loads, slots))
        turn += 1
    _, _, loads, slots = heap[0]
    place = np.full(made, -1, dtype=np.int64)
    place[slots] = np.arange(windows)
    for k in range(len(lefts) - 1, -1, -1):
        here = place[n + 1 + k * windows:n + 1 + (k + 1) * windows]
        place[lefts[k]] = here
        place[rights[k]] = here
    return place[:n].tolist(), int(loads[0])


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Pieces (their places in ``sizes``) of near-equal windows, none beyond the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place, fullest = differenced(sizes, windows)
        if fullest <= capacity:
            break
        windows += 1
    members: list[list[int]] = [[] for _ in range(windows)]
    for piece, window in enumerate(place):
        members[window].append(piece)
    return [window for window in members if window]


def halves(size: int) -> Iterator[int]:
    """Sizes of the pieces of a remainder that is cut finely."""
    while size > 2 * FINE:
        yield size // 2
        size -= size // 2
    while size > 0:
        yield min(FINE, size)
        size -= FINE


def _packed(given: str, ranks: dict[bytes, int] | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Ids(given, ranks)
        sequence = TaskContext.get().partitionId() << 40
        room = WINDOWS * (capacity - SLACK) if capacity > SLACK else WINDOWS * capacity
        group: list[tuple] = []
        held = remainders = 0
        rows: list[tuple] = []

        def close() -> None:
            nonlocal sequence, held
            for window in windows_of([len(ids) for _, _, ids, _ in group], capacity) if group else ():
                offset = 0
                for doc_id, start, ids, tokens in (group[k] for k in window):
                    rows.append((doc_id, start, ids.tobytes(), tokens, sequence, offset))
                    offset += len(ids)
                sequence += 1
            group.clear()
            held = 0

        def told() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset")
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = tokenizer.of(text.as_py())
                whole = len(ids) - len(ids) % capacity
                for start in range(0, whole, capacity):
                    rows.append((doc_id, start, ids[start:start + capacity].tobytes(), len(ids), sequence, 0))
                    sequence += 1
                    if len(rows) >= 1 << 14:
                        yield told()
                left = len(ids) - whole
                if not left:
                    continue
                remainders += 1
                at = whole
                for size in halves(left) if remainders % FOURTH == 0 else (left,):
                    while size:
                        taken = min(size, room - held)
                        group.append((doc_id, at, ids[at:at + taken], len(ids)))
                        at, size, held = at + taken, size - taken, held + taken
                        if held == room:
                            close()
            if rows:
                yield told()
        close()
        if rows:
            yield told()

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents: PIECES, ``ids`` as little-endian unsigned 32-bit numbers.

    ``path``: the tokenizer's file, read by the driver and sent to the tasks.
    """
    with open(path or tokenizer_file(), encoding="utf-8") as file:
        given = file.read()
    return docs.select("doc_id", "text").mapInArrow(_packed(given, byte_ranks(given), capacity), PIECES)


def padded(length: int, capacity: int = CAPACITY) -> int:
    """What a sequence of ``length`` ids is padded to: a power of two stays as it is."""
    return length if length & (length - 1) == 0 else capacity


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, length, ids): every sequence's ids in order and what they are padded with.

    A sequence holds at most ``capacity`` ids, so its pieces meet in one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, lengths = [], []
            for parts in batch.column("parts").to_pylist():
                ids = np.frombuffer(b"".join(part["ids"] for part in parts), dtype="<u4")
                lengths.append(len(ids))
                lists.append(np.pad(ids, (0, padded(len(ids), capacity) - len(ids)), constant_values=PAD).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(lengths, pa.int64()), pa.array(lists, pa.list_(pa.int32()))],
                names=["sequence_id", "length", "ids"],
            )

    gathered = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.mapInArrow(run, "sequence_id long, length long, ids array<int>")


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece: its place in document and sequence, and the check sum of its ids."""
    return pack(docs, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )
