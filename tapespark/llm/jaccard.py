"""Exact Jaccard join of documents on word shingles, by T-occurrence search.

A document's set holds the hashes of its 5-word shingles; documents with equal sets form one
class, which is searched once.  The steps:

1. Inverted lists.  Sets are dealt out by hash in packed arrays, and every list's length is
   counted over all documents.  A class that does not share T = ceil(0.75 n) of its n entries
   with any other can have no partner and is left out, as are lists of one class.
2. Divide.  Two linked sets share at least T entries, so of the lists of a class sorted by
   length the T - 1 longest alone cannot hold a partner: the others, the short ones, are
   merged, and classes that meet in one are candidates.
3. Merge and skip.  Each short list goes to its least class, so classes that meet in a list
   meet again in that class's group, into which each brings its set once.  In a group the
   short lists of a class are merged by counting; candidates that can still reach the
   required overlap are probed for the long entries by binary search, or the long lists are
   merged too where that touches fewer entries.  A group that is too large for one task is
   cut into blocks, of which all pairs are worked through.
4. Only links that join what a group has not joined yet are kept, so a group of copies yields
   as many links as it has members, and these are joined to components.

Lists that would make a bucket too large for one task are cut: entries are counted by bin of
their hash in the first pass over the texts, the entries of an overfull bucket are dealt by
class as well, and only the lengths of its lists are put together.

Sets are kept as sorted 64-bit hashes, lists as 48 bits besides their bucket, classes as 64
bits.  A second number of 64 bits tells when different sets meet in a class; such classes
get other numbers, so only sets that agree in 128 bits are taken for equal.
Nulls count as empty texts.  Texts without words have an empty set and no links; rows without
doc_id take part and give their class no name.  Repeated rows are one class.  Very long texts
are taken whole.  Empty tables give no rows; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.llm.common import BASE, mixed, release, tidy, window_hashes, word_hashes
from tapespark.llm.components import components, join_unique
from tapespark.session import scratch_path

SHINGLE = 5
#: Two sets link when PER_CENT * union <= 100 * intersection.
PER_CENT = 75
#: Entries gathered in a task before they are dealt out.
CHUNK = 1 << 19
#: Entries per bucket of lists, which a task holds in memory (16 bytes each).
PER_BUCKET = 1 << 19
#: Bins of hashes in which the first pass counts entries.
BINS = 512
#: Entries of a block of a group.
BLOCK = 1 << 20
#: What a probe of a long entry costs beside one step of a merge.
PROBE = 8
LOW = np.uint64((1 << 48) - 1)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles; fewer words make one shingle."""
    words = word_hashes(text)
    width = min(SHINGLE, len(words))
    if not width:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(window_hashes(words, tuple(range(width))))


def class_of(entries: np.ndarray) -> tuple[int, int]:
    """Two numbers for a set, as signed 64-bit integers: its class and what tells classes apart."""
    with np.errstate(over="ignore"):
        total, parity = entries.sum(dtype=np.uint64), np.bitwise_xor.reduce(entries)
        whole = mixed(np.array([total * np.uint64(BASE) ^ parity, len(entries), total, parity], dtype=np.uint64))
        number = mixed(np.array([whole[0] + whole[1], whole[2] ^ (whole[3] * np.uint64(BASE)) ^ whole[1]]))
        return int(number[0].view(np.int64)), int(number[1].view(np.int64))


def number_of(entries: np.ndarray, met: frozenset[int]) -> int:
    """The class of a set; classes in which different sets ``met`` are told apart by the second number."""
    number, check = class_of(entries)
    if number not in met:
        return number
    apart = (number ^ (check << 1)) & 0xFFFFFFFFFFFFFFFF
    return apart - (1 << 64) if apart >> 63 else apart


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each entry; ``buckets`` is a power of two."""
    high = (hashes >> np.uint64(48)) | ((hashes >> np.uint64(32)) & np.uint64(0xFFFF)) << np.uint64(16)
    return (high & np.uint64(buckets - 1)).astype(np.int64)


def least_shared(n: np.ndarray | int):
    """Entries that a set of n must share with any partner."""
    return (PER_CENT * n + 99) // 100


def required(n, m):
    """Entries that sets of n and m must share: 100 i >= PER_CENT (n + m - i)."""
    return -((-PER_CENT * (n + m)) // (100 + PER_CENT))


#: Rows of the first pass: documents, and with ``bin`` the entries that a task counted in it.
SIZED = "doc_id long, n_shingles long, class long, also long, bin int"


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SIZED.split(", ")]
    bins = np.zeros(BINS, dtype=np.int64)
    for batch in batches:
        sizes, classes, also = [], [], []
        for text in batch.column("text"):
            entries = shingle_set(text.as_py())
            number, check = class_of(entries) if len(entries) else (None, None)
            sizes.append(len(entries))
            classes.append(number)
            also.append(check)
            bins += np.bincount(bucket_of(entries, BINS), minlength=BINS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
             pa.array(also, pa.int64()), pa.nulls(batch.num_rows, pa.int32())],
            names=names,
        )
    held = np.flatnonzero(bins)
    nothing = pa.nulls(len(held), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [nothing, pa.array(bins[held]), nothing, nothing, pa.array(held.astype(np.int32))], names=names
    )


def plan_buckets(counts: dict[int, int]) -> tuple[int, np.ndarray]:
    """(buckets, by bin or bucket the parts that one is cut into) for entries counted by bin."""
    bins = np.zeros(BINS, dtype=np.int64)
    bins[list(counts)] = list(counts.values())
    buckets = 1
    while buckets * PER_BUCKET < bins.sum():
        buckets *= 2
    if buckets < BINS:
        bins = bins.reshape(-1, buckets).sum(axis=0)
        over = bins - PER_BUCKET
    else:
        # Any of a bin's buckets may hold what it has beyond the others.
        over = bins - bins.mean().astype(np.int64)
    return buckets, np.where(over > PER_BUCKET, 1 + -(-over // PER_BUCKET), 1)


def _bytes48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from48(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


#: Packed entries: 48-bit hashes, the place of each one's class in ``classes``, sizes of classes.
DEALT = "bucket long, part int, hashes binary, places binary, classes binary, sizes binary"


def _dealt(buckets: int, parts: np.ndarray, met: frozenset[int], cut: bool):
    """The sets of a task's distinct classes, packed per bucket of hashes.

    ``cut``: the buckets that are cut into several parts, dealt by class; else the others.
    """
    many = bool((parts > 1).any())

    def packed(sets, classes):
        sizes = np.array([len(s) for s in sets], dtype=np.uint32)
        hashes = np.concatenate(sets)
        places = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        known = np.array(classes, dtype=np.int64)
        bucket = bucket_of(hashes, buckets)
        part = np.zeros(len(hashes), dtype=np.int64)
        if many:
            cuts = parts[bucket & (len(parts) - 1)]
            chosen = np.flatnonzero((cuts > 1) == cut)
            hashes, places, bucket, cuts = hashes[chosen], places[chosen], bucket[chosen], cuts[chosen]
            part = (mixed(known.view(np.uint64).copy())[places] >> np.uint64(8)).astype(np.int64) % cuts
        order = np.lexsort((part, bucket)) if many else np.argsort(bucket, kind="stable")
        bucket, part = bucket[order], part[order]
        first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])[:len(order)])
        for begin, end in zip(first, np.append(first[1:], len(order))):
            at = order[begin:end]
            used, places_here = np.unique(places[at], return_inverse=True)
            yield (
                int(bucket[begin]), int(part[begin]), _bytes48(hashes[at] & LOW),
                places_here.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32).tobytes(),
                known[used].tobytes(), sizes[used].tobytes(),
            )

    def run(batches):
        sets, classes, held, seen = [], [], 0, set()
        for batch in batches:
            for text in batch.column("text"):
                entries = shingle_set(text.as_py())
                if not len(entries):
                    continue
                number = number_of(entries, met)
                if number in seen:
                    continue
                seen.add(number)
                sets.append(entries)
                classes.append(number)
                held += len(entries)
                if held >= CHUNK:
                    yield _rows(packed(sets, classes), DEALT)
                    sets, classes, held, seen = [], [], 0, set()
        if sets:
            yield _rows(packed(sets, classes), DEALT)

    return run


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _rows(rows, schema: str) -> pa.RecordBatch:
    columns = [c.split() for c in schema.split(", ")]
    values = list(zip(*rows)) or [[]] * len(columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, _KINDS[kind]) for v, (_, kind) in zip(values, columns)], names=[n for n, _ in columns]
    )


def _table(rows, schema: str) -> pa.Table:
    return pa.Table.from_batches([_rows(rows, schema)])


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(48-bit hash, class, size of the class) of every entry of packed rows."""
    parts = []
    for hashes, places, classes, sizes in zip(
        *(table.column(n).to_pylist() for n in ("hashes", "places", "classes", "sizes"))
    ):
        entries = _from48(hashes)
        kind = np.uint16 if len(places) == 2 * len(entries) else np.uint32
        at = np.frombuffer(places, dtype=kind)
        parts.append((
            entries, np.frombuffer(classes, dtype=np.int64)[at],
            np.frombuffer(sizes, dtype=np.uint32)[at],
        ))
    return tuple(np.concatenate(column) for column in zip(*parts))


#: Entries of lists of two classes or more: 64-bit hashes with the bucket on top, list lengths.
SHARED = "home long, hashes binary, lengths binary, classes binary, sizes binary"


def _by_list(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (hash, class, size of the class) by hash and class, each once."""
    hashes, classes, sizes = _unpacked(table)
    # A class reaches a bucket from several tasks: count it once per list.
    order = np.lexsort((classes, hashes))
    hashes, classes, sizes = hashes[order], classes[order], sizes[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (classes[1:] != classes[:-1])])[:len(hashes)]
    return hashes[new], classes[new], sizes[new]


def _runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, length) of every run of equal hashes."""
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)])
    return first, np.diff(np.append(first, len(hashes)))


def _homed(bucket: int, hashes, lengths, classes, sizes, homes: int) -> pa.Table:
    """Entries of lists of several classes, packed by the home of the class."""
    kept = lengths > 1
    hashes, classes, sizes, lengths = hashes[kept], classes[kept], sizes[kept], lengths[kept]
    hashes = hashes | (np.uint64(bucket & 0xFFFF) << np.uint64(48))
    home = (mixed(classes.view(np.uint64).copy()) % np.uint64(homes)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    first, runs = _runs(home[order])
    return _table(
        (
            (
                int(home[at[0]]), hashes[at].tobytes(), lengths[at].astype(np.uint32).tobytes(),
                classes[at].tobytes(), sizes[at].tobytes(),
            )
            for at in (order[begin:begin + run] for begin, run in zip(first, runs))
        ),
        SHARED,
    )


def _shared(homes: int):
    """Of a bucket: the entries of lists that hold several classes, packed by class."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        hashes, classes, sizes = _by_list(table)
        _, runs = _runs(hashes)
        homed = _homed(key[0].as_py(), hashes, np.repeat(runs, runs), classes, sizes, homes)
        release()
        return homed

    return run


#: Lengths of lists within a part of a bucket, and over all its parts.
LENGTHS = "bucket long, part int, hashes binary, lengths binary"


def _part_lengths(key: tuple, table: pa.Table) -> pa.Table:
    hashes, _, _ = _by_list(table)
    first, runs = _runs(hashes)
    return _table([(key[0].as_py(), key[1].as_py(), hashes[first].tobytes(), runs.tobytes())], LENGTHS)


def _whole_lengths(key: tuple, table: pa.Table) -> pa.Table:
    """Every part's lists with their lengths over all parts of the bucket."""
    parts = table.column("part").to_pylist()
    hashes = [np.frombuffer(h, dtype=np.uint64) for h in table.column("hashes").to_pylist()]
    lengths = [np.frombuffer(n, dtype=np.int64) for n in table.column("lengths").to_pylist()]
    known, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.zeros(len(known), dtype=np.int64)
    np.add.at(total, place, np.concatenate(lengths))
    return _table(
        ((key[0].as_py(), p, h.tobytes(), total[np.searchsorted(known, h)].tobytes()) for p, h in zip(parts, hashes)),
        LENGTHS,
    )


def _shared_part(homes: int):
    """As ``_shared``, of a part of a bucket beside the whole lengths of its lists."""

    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        hashes, classes, sizes = _by_list(table)
        known = np.frombuffer(told.column("hashes")[0].as_py(), dtype=np.uint64)
        lengths = np.frombuffer(told.column("lengths")[0].as_py(), dtype=np.int64)
        return _homed(key[0].as_py(), hashes, lengths[np.searchsorted(known, hashes)], classes, sizes, homes)

    return run


#: A class that can have partners: its size, and its shared entries from short to long lists.
SEARCHED = "class long, n long, short int, entries binary"


def _searched(key: tuple, table: pa.Table) -> pa.Table:
    """Classes of a home that share enough entries, each with its number of short lists."""
    kinds = {"hashes": np.uint64, "lengths": np.uint32, "classes": np.int64, "sizes": np.uint32}
    hashes, lengths, classes, sizes = (
        np.concatenate([np.frombuffer(x, dtype=kind) for x in table.column(n).to_pylist()])
        for n, kind in kinds.items()
    )
    order = np.lexsort((hashes, lengths, classes))
    hashes, classes, sizes = hashes[order], classes[order], sizes[order]
    first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    rows = []
    for start, end in zip(first, np.append(first[1:], len(classes))):
        n = int(sizes[start])
        short = (end - start) - least_shared(n) + 1
        if short >= 1:
            rows.append((int(classes[start]), n, int(short), hashes[start:end].tobytes()))
    found = _table(rows, SEARCHED)
    release()
    return found


def _short_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shorts = batch.column("short").to_pylist()
        whole = batch.column("entries").to_pylist()
        entries = [np.frombuffer(e, dtype=np.int64)[:s] for e, s in zip(whole, shorts)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(entries) if entries else np.zeros(0, np.int64)),
                pa.array(np.repeat(np.array(batch.column("class").to_pylist(), dtype=np.int64), shorts)),
                pa.array(np.repeat(np.array([len(e) // 8 for e in whole], dtype=np.int64), shorts)),
            ],
            names=["entry", "class", "held"],
        )


class _Joined:
    """Union-find over the members of a group."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return int(k)

    def roots(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if (above == self.up).all():
                return above
            self.up = above


def links_among(sizes: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between sets of a group, as many as join what can be joined.

    ``sizes``: of the whole sets; ``sets``: their entries that others share.
    """
    lengths = np.array([len(s) for s in sets])
    _, number, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(number, kind="stable")
    members = owner[order]
    begins = np.concatenate([[0], np.cumsum(held)])
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    own = [np.sort(number[cuts[k]:cuts[k + 1]]) for k in range(len(sets))]
    joined, links = _Joined(len(sets)), []

    def merge(lists: np.ndarray) -> np.ndarray:
        met = [members[begins[x]:begins[x + 1]] for x in lists]
        return np.bincount(np.concatenate(met), minlength=len(sets)) if met else np.zeros(len(sets), int)

    for k in range(len(sets)):
        n = int(sizes[k])
        lists = own[k][held[own[k]] > 1]
        skipped = int(least_shared(n)) - 1
        if len(lists) <= skipped:
            continue
        lists = lists[np.argsort(held[lists], kind="stable")]
        short, long = lists[:len(lists) - skipped], lists[len(lists) - skipped:]
        counts = merge(short)
        need = required(n, sizes)
        roots = joined.roots()
        asked = np.flatnonzero(
            (counts > 0) & (counts + len(long) >= need) & (roots != roots[k])
        )
        if not len(asked):
            continue
        if PROBE * len(asked) * len(long) > held[long].sum():
            counts = counts + merge(long)
        else:
            for other in asked:
                at = np.minimum(np.searchsorted(own[other], long), len(own[other]) - 1)
                counts[other] += int((own[other][at] == long).sum())
        for other in asked[counts[asked] >= need[asked]]:
            ours, theirs = joined.root(k), joined.root(int(other))
            if ours != theirs:
                joined.up[max(ours, theirs)] = min(ours, theirs)
                links.append((k, int(other)))
    return links


def _linked(table: pa.Table) -> pa.Table:
    classes = np.array(table.column("class").to_pylist(), dtype=np.int64)
    sizes = np.array(table.column("n").to_pylist(), dtype=np.int64)
    sets = [np.frombuffer(e, dtype=np.uint64) for e in table.column("entries").to_pylist()]
    # The same links come out of every attempt, whatever order rows arrive in.
    order = np.lexsort((classes, sizes))
    links = links_among(sizes[order], [sets[k] for k in order])
    pairs = np.array([(classes[order[a]], classes[order[b]]) for a, b in links], dtype=np.int64)
    pairs = pairs.reshape(len(links), 2)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _links(searched: DataFrame) -> DataFrame:
    """(a, b): links that join all classes which links join."""
    lists = searched.mapInArrow(_short_entries, "entry long, class long, held long")
    ends = lists.groupBy("entry").agg(F.min("class").alias("head"), F.max("class").alias("last"))
    heads = ends.where("head < last").select("entry", "head")
    grouped = lists.join(heads, "entry").select("head", "class", "held").distinct()
    weights = grouped.groupBy("head").agg(
        F.ceil(F.sum("held") / BLOCK).cast("int").alias("blocks")
    )
    place = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    dealt = (
        grouped.join(weights, "head")
        .select("head", "class", place.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("head", "class", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    return (
        dealt.join(searched.select("class", "n", "entries"), "class")
        .groupBy("head", "i", "j").applyInArrow(_linked, "a long, b long")
    )


def _searched_classes(texts: DataFrame, sized: DataFrame, met: frozenset[int]) -> DataFrame:
    """SEARCHED of all classes of ``texts``."""
    spark = texts.sparkSession
    root = scratch_path(spark, "jaccard-lists")
    counts = {r["bin"]: r["n"] for r in sized.where("bin is not null").groupBy("bin").agg(F.sum("n_shingles").alias("n")).collect()}
    # Buckets follow the entries, so packed rows stay few and large whatever the partitions.
    buckets, parts = plan_buckets(counts)
    homes = 1 + buckets // 2
    shared = texts.mapInArrow(tidy(_dealt(buckets, parts, met, False)), DEALT).groupBy("bucket").applyInArrow(_shared(homes), SHARED)
    if (parts > 1).any():
        texts.mapInArrow(tidy(_dealt(buckets, parts, met, True)), DEALT).write.parquet(f"{root}/cut")
        cut = spark.read.schema(DEALT).parquet(f"{root}/cut").groupBy("bucket", "part")
        lengths = cut.applyInArrow(_part_lengths, LENGTHS).groupBy("bucket").applyInArrow(_whole_lengths, LENGTHS)
        shared = shared.union(cut.cogroup(lengths.groupBy("bucket", "part")).applyInArrow(_shared_part(homes), SHARED))
    shared.groupBy("home").applyInArrow(_searched, SEARCHED).write.parquet(f"{root}/searched")
    return spark.read.schema(SEARCHED).parquet(f"{root}/searched")


def _labelled(docs: DataFrame) -> tuple[DataFrame, frozenset[int]]:
    """(doc_id, n_shingles, class, least, chosen) per row, and the classes that different sets met in.

    ``least``: the smallest doc_id of the row's component; ``chosen``: the class of that row.
    """
    spark = docs.sparkSession
    root = scratch_path(spark, "jaccard")
    texts = docs.select("doc_id", "text")
    texts.mapInArrow(tidy(_sized), SIZED).write.parquet(f"{root}/sized")
    told = spark.read.schema(SIZED).parquet(f"{root}/sized")
    rows = told.where("bin is null")
    # Among 10**11 sets some hundred classes are met in by different ones.
    both = rows.where("class is not null").groupBy("class").agg(F.min("also").alias("low"), F.max("also").alias("high"))
    met = frozenset(r["class"] for r in both.where("low <> high").select("class").collect())
    if met:
        apart = F.col("class").bitwiseXOR(F.shiftleft("also", 1))
        rows = rows.withColumn("class", F.when(F.col("class").isin(list(met)), apart).otherwise(F.col("class")))
    searched = _searched_classes(texts, told, met)
    _links(searched).write.parquet(f"{root}/links")
    links = spark.read.schema("a long, b long").parquet(f"{root}/links")

    parts = components(links).withColumnRenamed("node", "class")
    rows.join(parts, "class", "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("label", "class").alias("part")
    ).write.parquet(f"{root}/named")
    named = spark.read.schema("doc_id long, n_shingles long, class long, part long").parquet(f"{root}/named")
    least = named.where("part is not null").groupBy("part").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "class"))).alias("first")
    ).select("part", F.col("first.doc_id").alias("least"), F.col("first.class").alias("chosen"))
    return join_unique(named, least, "part").select("doc_id", "n_shingles", "class", "least", "chosen"), met


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Links are those of the module's definition; component_id is the smallest doc_id among
    the documents that links lead to, the row's own included.
    """
    rows, _ = _labelled(docs)
    return rows.select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _with_class(met: frozenset[int]):
    """Rows (texts first) with the class of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py()) for text in batch.column(0)]
            classes = [number_of(entries, met) if len(entries) else None for entries in sets]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(classes, pa.int64())], names=[*batch.schema.names[1:], "set"]
            )

    return run


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another of their component stands for.

    The row with the component's smallest doc_id stays, of repeated rows one, and of different
    texts with that id one as well; rows without doc_id stay, and of rows without words one for each
    doc_id.  A row goes only if one of its own component stays.  All columns are kept, whatever their names.
    """
    spark = docs.sparkSession
    root = scratch_path(spark, "jaccard-placed")
    rows, met = _labelled(docs)
    stays = (F.col("n_shingles") == 0) | ((F.col("doc_id") == F.col("least")) & (F.col("class") == F.col("chosen")))
    rows.where("doc_id is not null").select("doc_id", "class", stays.alias("stays")).write.parquet(f"{root}/rows")
    rows = spark.read.schema("doc_id long, class long, stays boolean").parquet(f"{root}/rows")
    # Ids of several rows are told apart by text; all others by id.
    rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and("stays").alias("stays")).where(
        "n > 1 or not stays"
    ).select("doc_id", (F.col("n") > 1).alias("several")).write.parquet(f"{root}/ids")
    # Read back, so Spark knows the size and sends few ids to the texts, not texts to the ids.
    ids = spark.read.schema("doc_id long, several boolean").parquet(f"{root}/ids")
    single = docs.join(ids.select("doc_id"), "doc_id", "left_anti").select(*_own(docs.columns))
    several = ids.where("several")
    if not several.take(1):
        return single
    given = docs.join(several.select("doc_id"), "doc_id", "left_semi")
    numbered = given.select(F.col("text").alias("of"), *(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(docs.columns)))
    schema = numbered.drop("of").schema.add("set", "long")
    doc_id = f"c{docs.columns.index('doc_id')}"
    told = numbered.mapInArrow(_with_class(met), schema).dropDuplicates([doc_id, "set"])
    kept = rows.where("stays").select(F.col("doc_id").alias("kept_id"), F.col("class").alias("kept_class")).distinct()
    chosen = told.join(
        kept, (F.col(doc_id) == F.col("kept_id")) & F.col("set").eqNullSafe(F.col("kept_class")), "left_semi"
    )
    return single.unionByName(chosen.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(docs.columns))))


def _own(names: list[str]) -> list:
    return [F.col(f"`{n}`") for n in names]


#: DuckDB's way to the same rows: shingles, pairs that share one, and what pairs reach.
ORACLE = r"""
with recursive texts as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+'
        ) as words
    from documents
),
shingles as (
    select distinct r, unnest(
        case when len(words) >= 5
            then list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
            when len(words) > 0 then [array_to_string(words, ' ')]
            else [] end
    ) as shingle
    from texts
),
sizes as (select r, count(*) as n from shingles group by r),
shared as (
    select a.r as a, b.r as b, count(*) as n
    from shingles a join shingles b on a.shingle = b.shingle and a.r <> b.r
    group by a.r, b.r
),
links as (
    select shared.a, shared.b
    from shared join sizes x on x.r = shared.a join sizes y on y.r = shared.b
    where 100 * shared.n >= 75 * (x.n + y.n - shared.n)
),
reach(r, other) as (
    select r, r from texts
    union
    select reach.r, links.b from reach join links on links.a = reach.other
)
select t.doc_id, cast(coalesce(max(s.n), 0) as bigint) as n_shingles, min(o.doc_id) as component_id
from texts t join reach on reach.r = t.r join texts o on o.r = reach.other left join sizes s on s.r = t.r
group by t.r, t.doc_id
"""
