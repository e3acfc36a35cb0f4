"""Vectorised word and shingle hashing over Arrow text columns, and what workers remember of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Texts are handled in slices of about so many bytes (one text at least), which bounds a task's memory.
SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
POW: list[np.ndarray] = []
#: Ranges of more bytes are hashed one by one; the first 0 to 8 bytes of a block.
LONG_RANGE = 64
FIRST_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)

#: Byte classes: the white space of [^\x20\x09-\x0D]+, and all ASCII that is neither letter nor digit.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:128] = [not chr(i).isalnum() for i in range(128)]
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i up to n."""
    if not POW or len(POW[0]) <= n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        size = max(n + 1, 2 * SLICE_BYTES)
        POW[:] = [np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, b, np.uint64))]) for b in (BASE, inverse)]
    return POW[0], POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and multiplications that spread each bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each range of bytes; those of two seeds are independent.

    Ranges of up to LONG_RANGE bytes go block by block of 8 bytes, each mixed with what the blocks before it gave, so
    that no sum over places can cancel out; longer ones go through xxhash one by one.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    blocks = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    size = end - begin
    out = mix(size.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF))
    left = np.flatnonzero((size > 0) & (size <= LONG_RANGE))
    for i in range(0, LONG_RANGE, 8):
        rest = size[left] - i
        out[left] = mix((out[left] ^ (blocks[begin[left] + i] & FIRST_BYTES[np.minimum(rest, 8)])) + np.uint64(0xD6E8FEB86659FD93))
        left = left[rest > 8]
        if not len(left):
            break
    view = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero(size > LONG_RANGE).tolist():
        out[i] = xxhash.xxh3_64_intdigest(view[begin[i] : end[i]], seed)
    return out


@dataclass
class Words:
    """The words of some texts: their hashes, and where each text's begin (one more entry than texts)."""

    hashes: np.ndarray
    starts: np.ndarray
    #: Where each word begins and ends in the bytes of the slice.
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def prefix_hashes(self, n: int) -> np.ndarray:
        """Hashes of the first n bytes of each word (of the whole word where it is shorter)."""
        return byte_hashes(self.data, self.begin, np.minimum(self.begin + n, self.end))


class Remembered:
    """Words or pieces met before, numbered as they came: two hashes of each, and where its token ids are in `ids`."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # first hashes in order, and whose they are
        self.checks, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def look(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of pieces, and which of them are known."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        number = self.numbers[at]
        return number, (self.keys[at] == keys) & (self.checks[number] == checks)

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The numbers of new pieces, whose ids are ids[starts[i] : starts[i + 1]]."""
        numbers = len(self.checks) + np.arange(len(keys))
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.numbers = np.insert(self.keys, at, keys[order]), np.insert(self.numbers, at, numbers[order])
        self.checks, self.count = np.concatenate([self.checks, checks]), np.concatenate([self.count, np.diff(starts)])
        self.first, self.ids = np.concatenate([self.first, len(self.ids) + starts[:-1]]), np.concatenate([self.ids, ids.astype(np.uint32)])
        return numbers

    def ids_at(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of these numbers, one after the other, and where each one's begin (one more entry)."""
        n = self.count[number]
        at = np.append(0, np.cumsum(n))
        return self.ids[np.repeat(self.first[number] - at[:-1], n) + np.arange(at[-1])], at


def buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings or binaries without nulls, and where each begins (one more entry)."""
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2], np.uint8) if strings.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def two_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each of some large strings or binaries."""
    data, offsets = buffers(strings)
    return byte_hashes(data, offsets[:-1], offsets[1:], 1), byte_hashes(data, offsets[:-1], offsets[1:], 2)


def slices(texts: pa.Array, size: int = SLICE_BYTES, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets into them) for runs of texts of about `size` bytes; null is empty. lower: in lower case.

    Only one run at a time is copied, converted or lower-cased, never the whole column.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, "right")))
        run = pc.fill_null(texts.slice(at, to - at).cast(pa.large_string()), "")
        yield at, to, *buffers(pc.utf8_lower(run) if lower else run)
        at = to


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words are runs of bytes other than separators, A-Z lower-cased; none spans two texts."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none, data)
    low = TO_LOWER[data]
    inside = ~separators[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    starts[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cut - 1] = inside[cut - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(byte_hashes(low, begin, end), np.searchsorted(begin, offsets), begin, end, low)


def shingles(words: Words, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of n words of each text, and where each text's begin.

    A text with fewer words (but some) has its whole sequence as one shingle, or none with short=False.
    """
    w, starts = words.hashes, words.starts
    counts = np.diff(starts)
    per = np.maximum(counts - n + 1, 0)
    few = (counts > 0) & (counts < n) if short else np.zeros(len(counts), bool)
    out = np.concatenate([[0], np.cumsum(per + few)])
    total = len(w) - n + 1
    whole = np.zeros(max(total, 0), np.uint64)
    for i in range(n):
        if total > 0:
            whole += w[i : i + total] * np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3) | 1) & 0xFFFFFFFFFFFFFFFF)
    first = np.repeat(starts[:-1] - out[:-1], per + few) + np.arange(out[-1])
    result = np.zeros(out[-1], np.uint64)
    is_few = np.repeat(few, per + few)
    result[~is_few] = mix(whole[first[~is_few]])
    for i in np.flatnonzero(few):
        x = np.uint64(counts[i])
        for h in w[starts[i] : starts[i + 1]]:
            x = mix(np.array([x * np.uint64(0xD6E8FEB86659FD93) + h]))[0]
        result[out[i]] = x
    return result, out
