"""Benchmark decontamination by spaced seeds.

A mask looks at some words of a window and ignores the others, so a window still has its
seed's hash when an ignored word was substituted.  Seeds of documents meet seeds of benchmark
items in an equi-join; around every place where they meet, document and item are laid side
by side.  An overlap is reported if some window of them has MATCHED equal words, or most of a
shorter item, and no more than one word in five substituted.  Its place is the best stretch,
in which a match counts 1 and a substitution -3, or where that has too few equal words, the
window that has most.

A fixed-size filter of the benchmark's seeds thins a document's seeds before the join; it
only ever lets too much through.  Masks are chosen by the item's length such that every set of
substitutions that still makes a leak leaves one of its windows untouched: tests go through
all of them for items of 8 to 16 words.

Words are lower-cased and split at white space.  Nulls count as empty texts, items without
words match nothing, items of less than 8 words are found whole and unchanged only.  Rows without
doc_id or item_id cannot be named and are not reported.  Repeated rows are reported once, of
equally good places the first.  Very long texts and items are taken whole, in batches of ROWS seeds.
Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.llm.common import tidy, window_hashes, word_hashes
from tapespark.session import scratch_path

#: Fixed masks: offsets of the words that count, for items of 15 words and more.
MASKS = (
    (0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 6, 8), (0, 1, 3, 4, 5, 6), (0, 1, 4, 6, 7, 8),
)
#: Fixed masks for shorter items, by their number of words.
SHORT_MASKS = {
    8: ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5)),
    9: ((0, 1, 2, 4, 5),),
    10: (
        (0, 1, 2, 3, 5, 6), (0, 1, 2, 3, 5, 7), (0, 1, 3, 4, 7, 8), (0, 1, 4, 5, 6, 7), (0, 2, 4, 5, 6, 7),
    ),
    11: ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 5, 6), (0, 1, 2, 5, 7, 8), (0, 2, 3, 4, 5, 6)),
    12: ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 2, 3, 6, 7, 8)),
    13: ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7)),
    14: ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 7, 8)),
}
#: Words of the widest mask, and of items from which on MASKS are used.
SPAN = 9
LONG = 15
#: Equal words that make an overlap a leak, and the share of a shorter item that does.  The
#: same share of a window's words must be equal.
MATCHED = 12
SHARE = 0.8
SUBSTITUTION = -3
#: Words kept on either side of a run of seeds for the comparison.  Of a window of 30 words that
#: is a leak one half is a leak too, so those beside a seed lie within.
MARGIN = 32
#: Bits of the seed filter, as a power of two: 2 MB, whatever the benchmark's size.
FILTER_BITS = 24
#: Most benchmark seeds, of 20 bytes each, and most bytes of items' words or of ids that are sent
#: to every executor; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000
BROADCAST_BYTES = 32 << 20
#: About as many seeds or words go into one batch of rows.
ROWS = 1 << 16


def masks_for(words: int) -> tuple[tuple[int, ...], ...]:
    """The masks of an item by its number of words; a very short one is a single window."""
    if words >= LONG:
        return MASKS
    return SHORT_MASKS.get(words) or ((tuple(range(words)),) if words else ())


def seeds(words: np.ndarray, masks: tuple[tuple[int, ...], ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) per mask."""
    found = []
    for mask in masks:
        hashes = window_hashes(words, mask)
        # Masks and lengths must not meet each other's hashes.
        found.append((hashes ^ np.uint64(sum(1 << k for k in mask)), np.arange(len(hashes))))
    return found


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            words = word_hashes(batch.column("text")[k].as_py(), any_case=True)
            item_id = batch.column("item_id")[k].as_py()
            for hashes, places in seeds(words, masks_for(len(words))):
                for at in range(0, len(hashes), ROWS):
                    part = hashes[at:at + ROWS].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), item_id, dtype=np.int64)), pa.array(part),
                            pa.array(places[at:at + ROWS].astype(np.int32)),
                        ],
                        names=["item_id", "seed", "item_at"],
                    )


ITEM_SEEDS = "item_id long, seed long, item_at int"


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            words = word_hashes(batch.column("text")[k].as_py(), any_case=True)
            if len(words):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").slice(k, 1), pa.array([words.tobytes()], pa.binary())],
                    names=["item_id", "item"],
                )


def _filter_of(seeds_of_items: DataFrame) -> np.ndarray:
    """Bits set at the top bits of every seed; at most 2**FILTER_BITS / 64 rows are collected."""
    place = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    bit = f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - FILTER_BITS}) & 63 as int))"
    rows = (
        seeds_of_items.select(F.shiftright(place, 6).alias("word"), F.expr(bit).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    )
    words = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return words.view(np.uint64)


HITS = "doc_id long, start int, size int, seed long, place int"
REGIONS = "doc_id long, start int, size int, words binary"


def _regions(bits: np.ndarray, masks: tuple[tuple[int, ...], ...], with_words: bool):
    """Runs of a document's seeds that pass the filter: a row per seed, or per run its words."""

    def passing(words):
        for hashes, places in seeds(words, masks):
            top = hashes >> np.uint64(64 - FILTER_BITS)
            hit = (bits[top >> np.uint64(6)] >> (top & np.uint64(63))) & np.uint64(1)
            at = np.flatnonzero(hit)
            if len(at):
                yield hashes[at].view(np.int64), places[at]

    def runs(doc_id, words):
        """(doc_id, start, size, seeds, places) of each run, and the words around it."""
        found = list(passing(words))
        if not found:
            return
        hashes = np.concatenate([h for h, _ in found])
        places = np.concatenate([p for _, p in found])
        order = np.argsort(places, kind="stable")
        hashes, places = hashes[order], places[order]
        cuts = np.flatnonzero(np.diff(places) > SPAN) + 1
        for one_hashes, one_places in zip(np.split(hashes, cuts), np.split(places, cuts)):
            start = max(0, int(one_places[0]) - MARGIN)
            end = min(len(words), int(one_places[-1]) + SPAN + MARGIN)
            yield doc_id, start, end - start, one_hashes, one_places - start

    def run(batches):
        for batch in batches:
            rows, told = [], 0
            for k in range(batch.num_rows):
                doc_id = batch.column("doc_id")[k].as_py()
                if doc_id is None:
                    continue
                words = word_hashes(batch.column("text")[k].as_py(), any_case=True)
                for row in runs(doc_id, words):
                    if with_words:
                        rows.append((*row[:3], words[row[1]:row[1] + row[2]].tobytes()))
                        told += row[2]
                    else:
                        rows.append(row)
                        told += len(row[3])
                    if told >= ROWS:
                        yield batch_of(rows)
                        rows, told = [], 0
            if rows:
                yield batch_of(rows)

    def batch_of(rows):
        columns = list(zip(*rows))
        if with_words:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "start", "size", "words"]
            )
        times = [len(hashes) for hashes in columns[3]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(columns[0], dtype=np.int64), times)),
                pa.array(np.repeat(np.array(columns[1], dtype=np.int32), times)),
                pa.array(np.repeat(np.array(columns[2], dtype=np.int32), times)),
                pa.array(np.concatenate(columns[3])),
                pa.array(np.concatenate(columns[4]).astype(np.int32)),
            ],
            names=["doc_id", "start", "size", "seed", "place"],
        )

    return run


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal words) of the stretch with the greatest sum of scores."""
    score = np.where(same, 1, SUBSTITUTION)
    total = np.concatenate([[0], np.cumsum(score)])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[:end + 1]))
    return start, end, int(same[start:end].sum())


def widest_window(same: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal words) of the window with most equal words, at least SHARE of its own."""
    equal = np.concatenate([[0], np.cumsum(same)])
    # In fifths: a window has the share if the total at its end is no less than at its start.
    kept = round(SHARE * 5)
    total = np.concatenate([[0], np.cumsum(np.where(same, 5 - kept, -kept))])
    highest = np.maximum.accumulate(total[::-1])[::-1]
    # The last end for each start: from there on every total is less.
    ends = len(total) - 1 - np.searchsorted(highest[::-1], total, side="left")
    matched = equal[ends] - equal
    places = np.flatnonzero(same)
    if not len(places):
        return 0, 0, 0
    # Without the substitutions at the edges, of windows with as many equal words the shortest.
    first = places[np.minimum(equal[:-1], len(places) - 1)]
    last = places[np.maximum(equal[ends] - 1, 0)][:-1] + 1
    at = np.lexsort((last - first, -matched[:-1]))[0]
    return int(first[at]), int(last[at]), int(matched[at])


def overlap(same: np.ndarray, item_words: int) -> tuple[int, int, int] | None:
    """(start, end, equal words) of a leak in a diagonal of equal and other words, if any."""
    needed = min(MATCHED, int(np.ceil(SHARE * item_words)))
    for found in (best_stretch(same), widest_window(same)):
        if found[2] >= needed:
            return found
    return None


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            doc_id, start, item_id, shifts, words, item_from, item, item_words = (
                batch.column(n)[k].as_py()
                for n in ("doc_id", "start", "item_id", "shifts", "words", "item_from", "item", "item_words")
            )
            doc, test = np.frombuffer(words, np.uint64), np.frombuffer(item, np.uint64)
            best = None
            for shift in shifts:
                # Item word i lies beside document word i + shift; of the item a part is here.
                low, high = max(0, -shift), min(item_words, len(doc) - shift)
                if high <= low:
                    continue
                leak = overlap(doc[low + shift:high + shift] == test[low - item_from:high - item_from], item_words)
                if leak:
                    a, b, matched = leak
                    first = start + shift + low
                    # As below: most equal words, then the shortest, then the first.
                    best = max(best or (-1,), (matched, a - b, -first - a, first + b))
            if best:
                matched, size, first, end = best
                rows.append((doc_id, item_id, -first, end, matched, -size, item_words))
        columns = list(zip(*rows)) if rows else [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["doc_id", "item_id", "first_word", "end_word", "matched", "compared", "item_words"],
        )


LEAKS = (
    "doc_id long, item_id long, first_word long, end_word long, matched long, compared long,"
    " item_words long"
)


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item that overlap, with the longest overlap's place.

    doc_id, item_id, first_word, end_word (exclusive), matched, compared, item_words.
    """
    spark = docs.sparkSession
    named = items.where("item_id is not null").select("item_id", "text")
    tested = named.mapInArrow(_item_seeds, ITEM_SEEDS).distinct()
    item_words = named.mapInArrow(_item_words, "item_id long, item binary").distinct()
    bits = _filter_of(tested)
    count = tested.count()
    told = item_words.agg(
        F.sum(F.length("item") + 16).alias("bytes"),
        F.collect_set(F.least(F.length("item") / 8, F.lit(LONG))).alias("lengths"),
    ).first()
    masks = tuple(sorted({mask for n in told["lengths"] for mask in masks_for(int(n))}))
    if count <= BROADCAST_SEEDS:
        tested = F.broadcast(tested)
    if (told["bytes"] or 0) <= BROADCAST_BYTES:
        item_words = F.broadcast(item_words)
    texts = docs.select("doc_id", "text")
    # Where seeds meet is found by places alone; words are laid beside each other only there.
    kept = scratch_path(spark, "met")
    texts.mapInArrow(tidy(_regions(bits, masks, False)), HITS).join(tested, "seed").select(
        "doc_id", "start", "size", "item_id", (F.col("place") - F.col("item_at")).alias("shift")
    ).distinct().groupBy("doc_id", "start", "size", "item_id").agg(
        F.collect_list("shift").alias("shifts")
    ).write.parquet(kept)
    met = spark.read.schema("doc_id long, start int, size int, item_id long, shifts array<int>").parquet(kept)
    ids = met.select("doc_id").distinct()
    if 8 * ids.count() <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    regions = texts.join(ids, "doc_id", "left_semi").mapInArrow(tidy(_regions(bits, masks, True)), REGIONS)
    # Only the part of an item that one of the shifts lays beside the region.
    beside = met.withColumns({
        "item_from": F.greatest(F.lit(0), -F.array_max("shifts")),
        "item_to": F.col("size") - F.array_min("shifts"),
    }).join(item_words, "item_id").select(
        "doc_id", "start", "size", "item_id", "shifts", "item_from",
        (F.length("item") / 8).cast("int").alias("item_words"),
        F.substring("item", 8 * F.col("item_from") + 1, 8 * (F.col("item_to") - F.col("item_from"))).alias("item"),
    )
    found = beside.join(regions, ["doc_id", "start", "size"]).mapInArrow(_verified, LEAKS)
    return found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("matched", -F.col("compared"), -F.col("first_word"), "first_word", "end_word", "compared", "item_words")).alias("best")
    ).select(
        "doc_id", "item_id", "best.first_word", "best.end_word", "best.matched",
        "best.compared", "best.item_words",
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap with an item; rows without doc_id stay."""
    spark = docs.sparkSession
    kept = scratch_path(spark, "leaks")
    find_leaks(docs, items).select("doc_id").distinct().write.parquet(kept)
    leaking = spark.read.schema("doc_id long").parquet(kept)
    return docs.join(leaking, "doc_id", "left_anti")
