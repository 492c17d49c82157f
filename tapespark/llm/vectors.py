"""Compression of vectors to codes of four bytes, by codebooks that are fitted exactly.

Components become integers floor(1024 x), vectors are cut into PARTS equal parts, and every
position has a codebook that starts as that part of the ENTRIES smallest vec_ids and is moved
ROUNDS times to the floors of its parts' means.  All arithmetic is on integers, so codes
depend on nothing but the rows.

1. The parts of a position are sorted along a Hilbert curve and cut into flat blocks of BLOCK
   parts, each with its minimum and maximum box, its sum and its size.
2. In every round a block's box gives each entry a least and a greatest distance.  An entry
   whose least distance exceeds another's greatest is nearest to no part of the block: the
   rest is the block's shortlist.  A shortlist of one entry takes the block's sum whole, the
   others are evaluated part by part.
3. Sums and counts by entry are added up by Spark; the driver gets one row per entry.

Rows whose vector is null or holds null or non-finite components are left out, and so are
vectors of another length than the smallest vec_id's.  A length that is no multiple of PARTS
is filled up with zeros.  Components are held within a bound so large that only distances
beyond 64 bits are affected.  Null vec_ids come last; equal vec_ids are rows of their own, in
order of their vectors.  Fewer than ENTRIES rows make fewer entries, an
empty table gives no rows.  Columns other than vec_id, embedding and label are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.session import scratch_path

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
#: Parts of a block.
BLOCK = 64
#: Bits of a place on the Hilbert curve.
CURVE = 62
#: Blocks whose boxes are measured at a time.
STEP = 64


def bound_of(width: int) -> int:
    """The largest component with which a sum of ``width`` squared differences fits 62 bits."""
    return min(int((2 ** 62 / max(1, width)) ** 0.5) // 2, 1 << 40)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of every row of ``points``, coordinates of ``bits`` bits.

    The turns of the curve are undone from the highest bit down, coordinate by coordinate, and
    the bits that are left are interleaved.
    """
    x = [points[:, d].astype(np.uint64) for d in range(points.shape[1])]
    for bit in range(bits - 1, 0, -1):
        mask, low = np.uint64(1 << bit), np.uint64((1 << bit) - 1)
        for d in range(len(x)):
            swap = (x[0] ^ x[d]) & low
            on = (x[d] & mask) != 0
            first = np.where(on, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = np.where(on, x[d], x[d] ^ swap)
            x[0] = first
    for d in range(1, len(x)):
        x[d] = x[d] ^ x[d - 1]
    turn = np.zeros(len(points), dtype=np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> np.uint64(bit)) & np.uint64(1), turn ^ np.uint64((1 << bit) - 1), turn)
    key = np.zeros(len(points), dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for d in range(len(x)):
            key = (key << np.uint64(1)) | (((x[d] ^ turn) >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def curve_places(parts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places of parts on the curve through the box from ``low`` to ``high``, clipped to it."""
    used = min(parts.shape[1], CURVE)
    if not used:
        return np.zeros(len(parts), dtype=np.int64)
    bits = max(1, min(16, CURVE // used))
    low, high = low[:used].astype(np.float64), high[:used].astype(np.float64)
    share = (parts[:, :used] - low) / np.maximum(high - low, 1.0)
    cells = np.clip((share * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1)
    return hilbert(cells, bits)


def nearest(members: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of every member; the first of equals."""
    # Where no product can leave 53 bits, floating numbers hold the integers exactly.
    most = max(np.abs(members).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * int(most) ** 2 * max(1, members.shape[1]) < 1 << 52 else np.int64
    a, b = members.astype(kind), entries.astype(kind)
    if kind is np.float64:
        distances = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        found = distances.argmin(axis=1)
        return found, distances[np.arange(len(a)), found].astype(np.int64)
    found = np.zeros(len(a), dtype=np.int64)
    best = np.full(len(a), np.iinfo(np.int64).max)
    for k, entry in enumerate(b):
        d = ((a - entry) ** 2).sum(axis=1)
        nearer = d < best
        found[nearer], best[nearer] = k, d[nearer]
    return found, best


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """By block and entry: whether the entry can be the nearest of a part within the box."""
    below, above = entries - low[:, None, :], high[:, None, :] - entries
    least = np.maximum(np.maximum(-below, -above), 0)
    greatest = np.maximum(np.abs(below), np.abs(above))
    least, greatest = (least * least).sum(axis=2), (greatest * greatest).sum(axis=2)
    return least <= greatest.min(axis=1)[:, None]


BLOCKS = "part int, size int, rows binary, members binary, low binary, high binary, total binary"
PLACED = "part int, place long, row long, member binary"


def _placed(width: int, low: np.ndarray, high: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            whole = batch.column("vector")
            vectors = whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, PARTS, width)
            for part in range(PARTS):
                parts = np.ascontiguousarray(vectors[:, part])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, dtype=np.int32)),
                        pa.array(curve_places(parts, low[part], high[part])),
                        batch.column("row"),
                        pa.array([p.tobytes() for p in _narrow(parts)], pa.binary()),
                    ],
                    names=["part", "place", "row", "member"],
                )

    return run


def _narrow(members: np.ndarray) -> np.ndarray:
    """Integers of 16 bits where all of a batch fit, else of 64."""
    fits = len(members) == 0 or (np.abs(members).max(initial=0) < 1 << 15)
    return members.astype(np.int16) if fits else members


def _wide(data: bytes, n: int, width: int) -> np.ndarray:
    kind = np.int16 if len(data) == 2 * n * width else np.int64
    return np.frombuffer(data, dtype=kind).reshape(n, width).astype(np.int64)


def _blocks(width: int):
    """Flat blocks of parts that come in the curve's order."""

    def packed(part: int, rows: list[int], members: list[bytes]) -> tuple:
        values = np.concatenate([_wide(m, 1, width) for m in members])
        return (
            part, len(rows), np.array(rows, dtype=np.int64).tobytes(), _narrow(values).tobytes(),
            values.min(axis=0).tobytes(), values.max(axis=0).tobytes(), values.sum(axis=0).tobytes(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, members = None, [], []
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        for batch in batches:
            out = []
            for part, row, member in zip(*(batch.column(n).to_pylist() for n in ("part", "row", "member"))):
                if rows and (part != current or len(rows) == BLOCK):
                    out.append(packed(current, rows, members))
                    rows, members = [], []
                current = part
                rows.append(row)
                members.append(member)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        if rows:
            last = [packed(current, rows, members)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*last), kinds)], names=names)

    return run


def _assigned(batch: pa.RecordBatch, books: np.ndarray, width: int) -> Iterator[tuple]:
    """(block's place in the batch, part, entries, members or None): None where one entry takes all."""
    parts = np.array(batch.column("part").to_pylist())
    lows, highs = (
        np.frombuffer(b"".join(batch.column(n).to_pylist()), dtype=np.int64).reshape(len(parts), width)
        for n in ("low", "high")
    )
    sizes, data = batch.column("size").to_pylist(), batch.column("members")
    for part in range(PARTS):
        of_part = np.flatnonzero(parts == part)
        for begin in range(0, len(of_part), STEP):
            some = of_part[begin:begin + STEP]
            lists = shortlists(lows[some], highs[some], books[part])
            for k, listed in zip(some, lists):
                entries = np.flatnonzero(listed)
                members = None if len(entries) == 1 else _wide(data[int(k)].as_py(), sizes[k], width)
                yield int(k), part, entries, members


def _summed(books: np.ndarray, width: int):
    """A task's sums and counts by part and entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, books.shape[1], width), dtype=np.int64)
        counts = np.zeros((PARTS, books.shape[1]), dtype=np.int64)
        for batch in batches:
            sizes, totals = batch.column("size"), batch.column("total")
            for k, part, entries, members in _assigned(batch, books, width):
                if members is None:
                    sums[part, entries[0]] += np.frombuffer(totals[k].as_py(), dtype=np.int64)
                    counts[part, entries[0]] += sizes[k].as_py()
                    continue
                found, _ = nearest(members, books[part][entries])
                np.add.at(sums[part], entries[found], members)
                counts[part] += np.bincount(entries[found], minlength=books.shape[1])
        at = np.argwhere(counts > 0)
        held = sums[at[:, 0], at[:, 1]]
        columns = [at[:, 0].astype(np.int32), at[:, 1].astype(np.int32), counts[at[:, 0], at[:, 1]], *held.T]
        names = ["part", "entry", "n", *(f"s{d}" for d in range(width))]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    return run


CODED = "row long, part int, entry int, distance long"


def _coded(books: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, entries, distances = [], [], [], []
            for k, part, listed, members in _assigned(batch, books, width):
                known = np.frombuffer(batch.column("rows")[k].as_py(), dtype=np.int64)
                if members is None:
                    members = _wide(batch.column("members")[k].as_py(), len(known), width)
                found, distance = nearest(members, books[part][listed])
                rows.append(known)
                parts.append(np.full(len(known), part, dtype=np.int32))
                entries.append(listed[found].astype(np.int32))
                distances.append(distance)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (rows, parts, entries, distances)],
                    names=["row", "part", "entry", "distance"],
                )

    return run


class Compressed:
    """Codes (row, vec_id, label, code, error) and the codebooks that decode them."""

    def __init__(self, codes: DataFrame, books: np.ndarray):
        self.codes, self.books = codes, books

    def books_digest(self) -> str:
        told = ",".join(str(int(x)) for x in self.books.ravel())
        return hashlib.sha256(told.encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The integers that a code stands for (filled up to a multiple of PARTS)."""
        return [int(x) for p in range(PARTS) for x in self.books[p, int(code[2 * p:2 * p + 2], 16)]]


def compress(embeddings: DataFrame) -> Compressed:
    """The codes of all vectors, and the codebooks after ROUNDS rounds."""
    spark = embeddings.sparkSession
    root = scratch_path(spark, "vectors")
    given = embeddings.select("vec_id", "embedding", "label").where(F.col("embedding").isNotNull()).where(
        F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    )
    # NaN is greater than every number in Spark's order, so it fails the test as infinity does.
    first = given.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size("embedding").alias("n")).first()
    size = first["n"] if first else 0
    width = -(-size // PARTS)
    most = bound_of(PARTS * width)
    whole = F.transform("embedding", lambda x: F.least(
        F.greatest(F.floor(F.greatest(F.least(x.cast("double"), F.lit(1e12)), F.lit(-1e12)) * SCALE), F.lit(-most)), F.lit(most)
    ).cast("long"))
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), PARTS * width - size))
    kept = given.where(F.size("embedding") == size).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", filled.alias("vector")
    )
    schema = kept.schema
    kept.write.parquet(f"{root}/kept")
    kept = spark.read.schema(schema).parquet(f"{root}/kept")
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    if not start:
        none = kept.where("false").select("row", "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Compressed(none, np.zeros((PARTS, 0, width), dtype=np.int64))
    books = np.array([r["vector"] for r in start], dtype=np.int64).reshape(len(start), PARTS, width).transpose(1, 0, 2).copy()

    # The first entries' box is only the curve's frame: what lies outside is sorted at its edge.
    low, high = books.min(axis=1), books.max(axis=1)
    placed = kept.select("row", "vector").mapInArrow(_placed(width, low, high), PLACED)
    keys = ("part", "place", "row")
    placed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_blocks(width), BLOCKS).write.parquet(f"{root}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{root}/blocks")
    for _ in range(ROUNDS):
        columns = [f"s{d}" for d in range(width)]
        partial = blocks.mapInArrow(
            _summed(books, width), ", ".join(["part int", "entry int", "n long", *(f"{c} long" for c in columns)])
        )
        moved = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in columns)).collect()
        books = books.copy()
        for r in moved:
            books[r["part"], r["entry"]] = [r[c] // r["n"] for c in columns]
    coded = blocks.mapInArrow(_coded(books, width), CODED)
    codes = coded.groupBy("row").agg(
        F.concat(*(
            F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0") for p in range(PARTS)
        )).alias("code"),
        F.sum("distance").alias("error"),
    )
    return Compressed(kept.select("row", "vec_id", "label").join(codes, "row"), books)


def report(embeddings: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that is kept.

    label_error is null where a label's errors add up to more than a long holds.
    """
    spark = embeddings.sparkSession
    made = compress(embeddings)
    path = scratch_path(spark, "codes")
    made.codes.select("vec_id", "label", "code", "error").write.parquet(path)
    schema = made.codes.select("vec_id", "label", "code", "error").schema
    codes = spark.read.schema(schema).parquet(path)
    by_label = codes.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(made.books_digest()).alias("codebooks_sha256")
    )
