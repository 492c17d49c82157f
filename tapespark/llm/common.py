"""Helpers shared by the text operators: tables, word hashing, hold-out split."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multiplier of the polynomial over bytes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed at a time, which bounds the arrays held besides the text.
SEGMENT = 1 << 20

_powers: dict[int, np.ndarray] = {}

SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept per worker and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.full(size, base, dtype=np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        if size <= 4 * SEGMENT:
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (in place)."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _segments(data: bytes) -> Iterator[bytes]:
    """Pieces of about SEGMENT bytes, cut before white space so that no word is split."""
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data) and not SPACES[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(text: str | None, any_case: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, in order.

    Words are runs of characters other than space and U+0009 to U+000D, with A-Z
    lower-cased (``any_case``: every letter).  A word's hash is a difference of prefix sums of a polynomial over its
    bytes, shifted to position 0, so all words of a segment are hashed at once.
    """
    if not text:
        return np.zeros(0, dtype=np.uint64)
    found = []
    text = text.lower() if any_case else text
    for piece in _segments(text.encode("utf-8", "surrogatepass").lower()):
        codes = np.frombuffer(piece, dtype=np.uint8)
        space = np.concatenate([[True], SPACES[codes], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        if not len(edges):
            continue
        start, end = edges[0::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(codes) + 1, dtype=np.uint64)
            np.cumsum((codes + np.uint64(1)) * powers(BASE, len(codes)), out=sums[1:])
            found.append(mixed((sums[end] - sums[start]) * powers(INVERSE, len(codes))[start]))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def window_hashes(words: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """A hash per window of ``offsets[-1] + 1`` words over the words at the given offsets."""
    n = len(words) - offsets[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in offsets:
            total *= np.uint64(BASE)
            total += words[k:k + n]
    return mixed(total)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def release() -> None:
    """Hand memory that a worker does not use back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps what it likes


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over batches, and ``release`` after them."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return wrapped
