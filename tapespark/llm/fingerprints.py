"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every length, the value of a polynomial over its code
points modulo 2**64, the modulus of machine words.  A difference of two entries, shifted to
position 0, is the hash of the span between them: any two spans are compared in constant
time, and the longest common extension of two places is found by binary search, whose answer
is confirmed on the code points themselves.

A fingerprint is a sketch of the hashes of all spans of ``SPAN`` code points: they are dealt
into ``SLOTS`` slots by value, and each slot keeps 16 bits of its smallest.  The share of
equal slots estimates how many spans two texts have in common.  A text shorter than ``SPAN``
is one span; null counts as empty, and the empty text's fingerprint has only empty slots.
Very long texts are taken whole.  Repeated rows each have the next one, equal to them, as their
successor; equal ids are ordered by text.  Empty tables give no rows, and columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapespark.llm.common import BASE, INVERSE, digest, powers

SPAN = 8
SLOTS = 64
EMPTY = "----"
#: Ranges of ids per shuffle partition, which evens out how ranges fall on partitions.
RANGES = 8


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Prefix:
    """The prefix arrays of a text."""

    def __init__(self, codes: np.ndarray, base: Prefix | None = None, kept: int = 0):
        """Of ``codes``, whose first ``kept`` code points are those of ``base``."""
        self.codes = codes
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        if base is not None:
            self.sums[:kept + 1] = base.sums[:kept + 1]
        with np.errstate(over="ignore"):
            terms = codes[kept:].astype(np.uint64)
            terms += np.uint64(1)
            terms *= powers(BASE, len(codes))[kept:]
            np.cumsum(terms, out=terms)
            np.add(terms, self.sums[kept], out=self.sums[kept + 1:])

    def __len__(self) -> int:
        return len(self.codes)

    def span(self, start: int, end: int) -> int:
        """The hash of the span [start, end)."""
        whole = (1 << 64) - 1
        shift = int(powers(INVERSE, len(self) + 1)[start])
        return (int(self.sums[end]) - int(self.sums[start])) * shift & whole

    def spans(self, start: int, end: int) -> np.ndarray:
        """Hashes of the spans of SPAN code points (or what there is) from start to end - 1."""
        width = min(SPAN, len(self))
        with np.errstate(over="ignore"):
            found = self.sums[start + width:end + width] - self.sums[start:end]
            found *= powers(INVERSE, len(self) + 1)[start:end]
            # A bijection that carries the low bits up: slots go by the highest.
            found ^= found >> np.uint64(32)
            found *= np.uint64(0xD6E8FEB86659FD93)
            found ^= found >> np.uint64(32)
            found *= np.uint64(0xD6E8FEB86659FD93)
        return found


def spans_equal(a: Prefix, i: int, b: Prefix, j: int, length: int) -> bool:
    return a.span(i, i + length) == b.span(j, j + length)


def common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """Length of the longest common run of ``a`` from ``i`` and ``b`` from ``j``."""
    low, high = 0, min(len(a) - i, len(b) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    differ = np.flatnonzero(a.codes[i:i + low] != b.codes[j:j + low])
    return int(differ[0]) if len(differ) else low


_LOWER = np.arange(SLOTS, dtype=np.uint64) << np.uint64(58)
NOTHING = np.uint64((1 << 64) - 1)
#: Hashes per slot that are expected to pass before the smallest are sought among them.
PASSING = 32


def _least(hashes: np.ndarray) -> np.ndarray:
    least = np.full(SLOTS, NOTHING)
    hashes = np.sort(hashes)
    first = np.searchsorted(hashes, _LOWER)
    inside = first < len(hashes)
    if inside.any():
        value = hashes[np.minimum(first, len(hashes) - 1)]
        inside &= (value >> np.uint64(58)) == np.arange(SLOTS, dtype=np.uint64)
        least[inside] = value[inside]
    return least


def _minima(prefix: Prefix, start: int, end: int) -> np.ndarray:
    """The smallest hash per slot of the spans beginning in [start, end)."""
    if end <= start:
        return np.full(SLOTS, NOTHING)
    hashes = prefix.spans(start, end)
    if len(hashes) > 4 * PASSING * SLOTS:
        # Among many, the smallest of every slot are nearly always below this bound.
        bound = np.uint64(((1 << 64) - 1) * PASSING * SLOTS // len(hashes))
        few = _least(hashes[(hashes << np.uint64(6)) < bound])
        if (few != NOTHING).all():
            return few
    return _least(hashes)


def _told(least: np.ndarray) -> str:
    return "".join(
        EMPTY if x == NOTHING else f"{int(x) & 0xFFFF:04x}" for x in least
    )


def _span_count(n: int) -> int:
    return 0 if n == 0 else max(1, n - SPAN + 1)


def fingerprint(text: str | None) -> str:
    prefix = Prefix(code_points(text))
    return _told(_minima(prefix, 0, _span_count(len(prefix))))


def likeness(a: str, b: str) -> float:
    """Share of equal slots among those that either fingerprint fills; 1 for two empty ones."""
    slots = [(a[k:k + 4], b[k:k + 4]) for k in range(0, 4 * SLOTS, 4)]
    filled = [(x, y) for x, y in slots if x != EMPTY or y != EMPTY]
    return sum(x == y for x, y in filled) / len(filled) if filled else 1.0


def edited(codes: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, int]:
    """The text with its last third replaced by the next one's start; code points kept."""
    cut = len(codes) // 3
    kept = len(codes) - cut
    return np.concatenate([codes[:kept], following[:cut]]), kept


def _text_of(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


class _Row:
    """A document while its neighbour is awaited: prefix array, minima and fingerprint."""

    def __init__(self, doc_id, text):
        self.doc_id, self.prefix = doc_id, Prefix(code_points(text))
        n = len(self.prefix)
        # Spans wholly inside the part that an edit keeps are hashed once for both texts.
        self.shared = max(0, n - n // 3 - SPAN + 1)
        self.head = _minima(self.prefix, 0, self.shared)
        tail = _minima(self.prefix, self.shared, _span_count(n))
        self.print = _told(np.minimum(self.head, tail))

    def beside(self, other: _Row) -> dict:
        codes, kept = edited(self.prefix.codes, other.prefix.codes)
        changed = Prefix(codes, self.prefix, kept)
        least = _minima(changed, self.shared, _span_count(len(changed)))
        told = _told(np.minimum(self.head, least))
        return {
            "doc_id": self.doc_id,
            "n_chars": len(self.prefix),
            "edited_sha256": digest(_text_of(codes)),
            "fingerprint": self.print,
            "edited_fingerprint": told,
            "near_edited": likeness(self.print, told),
            "near_next": likeness(self.print, other.print),
            "common_start": common_extension(self.prefix, 0, changed, 0),
        }


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double, common_start long"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_start", pa.int64()),
])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(name) for name in ("bucket", "borrowed", "doc_id", "text")]
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in columns)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, each range ended by the borrowed first row of the next."""
    waiting, at, done = None, None, []
    for bucket, borrowed, doc_id, text in _rows(batches):
        if borrowed and waiting is None:
            continue  # a further row with the same id
        row = _Row(doc_id, text)
        if waiting is not None and at == bucket:
            done.append(waiting.beside(row))
        waiting, at = (None if borrowed else row), bucket
        if len(done) >= 256:
            yield pa.RecordBatch.from_pylist(done, schema=_ARROW)
            done = []
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_ARROW)


def _ranges_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """The range of each id: 0 for the largest ids, the last for nulls."""
    values = ids.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    found = len(bounds) - np.searchsorted(bounds, values, side="left")
    return np.where(np.isnan(values), len(bounds) + 1, found).astype(np.int32)


def _first_ids(bounds: np.ndarray):
    """The largest id of each range in each batch."""

    def run(batches):
        for batch in batches:
            ranges = pa.array(_ranges_of(batch.column(0), bounds))
            found = pa.table({"bucket": ranges, "doc_id": batch.column(0)})
            found = found.group_by("bucket").aggregate([("doc_id", "max")])
            yield from found.rename_columns(["bucket", "doc_id"]).to_batches()

    return run


def _copies(bounds: np.ndarray, lends: dict[int, tuple]):
    """Every row with its range, and a copy of a range's first row for the range before."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            ranges = _ranges_of(ids, bounds)
            told = ids.to_pylist()
            lent = [k for k, r in enumerate(ranges) if lends[r][0] == told[k]]
            for rows, places, borrowed in (
                (batch, ranges, False),
                (batch.take(pa.array(lent, pa.int64())), [lends[ranges[k]][1] for k in lent], True),
            ):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("text"), pa.array(places, pa.int32()),
                     pa.array([borrowed] * rows.num_rows, pa.bool_())],
                    names=["doc_id", "text", "bucket", "borrowed"],
                )

    return run


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside its edited text's and its successor's.

    The successor is the next row by descending doc_id (nulls last, equal ids by text), after
    the last the first.  Ids are cut into ranges at their quantiles; every range is one
    sorted run, and the first row of the following range is copied to its end, so texts are
    shuffled once and no range needs another.  Only range bounds and first ids reach the driver.
    """
    docs = docs.select("doc_id", "text")
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (quantiles,) = docs.approxQuantile(
        ["doc_id"], [k / ranges for k in range(1, ranges)], 0.5 / ranges
    )
    bounds = np.unique(quantiles)
    firsts = docs.select("doc_id").mapInArrow(_first_ids(bounds), "bucket int, doc_id long")
    firsts = firsts.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).orderBy("bucket").collect()
    lends = {
        row["bucket"]: (row["doc_id"], firsts[k - 1]["bucket"]) for k, row in enumerate(firsts)
    }
    copies = docs.mapInArrow(
        _copies(bounds, lends), "doc_id long, text string, bucket int, borrowed boolean"
    )
    runs = copies.repartition("bucket").sortWithinPartitions(
        "bucket", "borrowed", F.desc_nulls_last("doc_id"), F.asc_nulls_last("text")
    )
    return runs.mapInArrow(_compare, SCHEMA)
