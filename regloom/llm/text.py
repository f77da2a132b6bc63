"""Texts of Arrow batches as byte arrays: words, hashes and digests without a loop per byte."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

#: White space by the pattern ``[\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: What parts words by the pattern ``[\x00-\x2F\x3A-\x60\x7B-\x7F]``, once A-Z are in lower case.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32

U64 = np.uint64

#: What workers remember between tasks, by operator: how to forget it. Spark keeps workers for
#: later stages, which need the room.
MEMORIES: dict[str, Callable[[], None]] = {}


def entering(operator: str) -> None:
    """To be called where an operator's work begins: the others' memories are dropped."""
    for name, forget in MEMORIES.items():
        if name != operator:
            forget()



#: Powers kept between tasks: those for so many values at most.
KEPT_POWERS = 1 << 22


def give_back() -> None:
    """Give memory that is no longer used back to the system: idle workers stay for later stages."""
    if Rolling._powers is not None and len(Rolling._powers[0]) > KEPT_POWERS:
        Rolling._powers = None
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work, after which a worker gives its memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most so many bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in bytes, and where the words of each text begin.

    ``apart`` says of each byte value whether it parts words; words end with their text.
    """
    word = ~apart[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty_like(word)
    if len(word):
        before[0] = False
        before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = word
    ends = np.flatnonzero(word & (~after[1:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class Rolling:
    """Polynomial hashes, modulo 2**64, of any run of a sequence of 64-bit values.

    Two runs have equal hashes if they are equal. Seeds other than 1 scramble the values first,
    so that hashes of one run by several seeds have nothing to do with each other.
    """

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, values: np.ndarray, seed: int = 1):
        if seed != 1:
            values = (values ^ (values >> U64(17 + 6 * seed))) * U64(0x9E3779B97F4A7C15 + 2 * seed)
        self.powers, self.inverse = self._tables(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.powers[: len(values)], out=self.sums[1:])

    @classmethod
    def _tables(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The powers of the base and of its inverse, kept for the longest sequence so far."""
        if cls._powers is None or len(cls._powers[0]) < n:
            base, size, both = 0xA24BAED4963EE407, -(-n // 65536) * 65536, []
            for b in (base, pow(base, -1, 2**64)):
                p = np.full(size, b, U64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            Rolling._powers = (both[0], both[1])
        return Rolling._powers

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def every(self, n: int) -> np.ndarray:
        """The hashes of all runs of n values."""
        count = max(0, len(self.sums) - n)
        return mix((self.sums[n:] - self.sums[:count]) * self.inverse[:count])


#: Bytes from which on a word is hashed by XXH64: a polynomial modulo a power of two tells
#: long words of few letters apart less surely (Thue-Morse words of 512 bytes may be equal).
LONG_WORD = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    hashes = Rolling(BYTE_VALUES[data]).of(starts, ends)
    for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], 7)
    return hashes


def random_values(n: int, seed: int) -> np.ndarray:
    """A fixed table of 64-bit values."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, U64)


#: A 64-bit value for each byte value, so that hashes do not follow byte arithmetic.
BYTE_VALUES = random_values(256, 7)


def packed(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays end to end, and the offsets of each."""
    lengths = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    return (np.concatenate(lists) if lists else np.zeros(0, np.int64)), np.concatenate([[0], np.cumsum(lengths)])


def values(column: pa.Array) -> Iterator:
    """The values of a column one by one, so that only one is copied at a time."""
    return (x.as_py() for x in column)
