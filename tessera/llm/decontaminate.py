"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact weighted shingles."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_WORD, Words, mix, slices, words_of

WORDS, SIMILARITY = 5, 0.8
#: Fingerprints have so many words of 64 bits.
PRINT_WORDS = 4
#: Hamming radius. Sets of similarity 0.8 differ in 39 of 256 bits on average, deviation 5.8; random ones in 128, deviation 8.
RADIUS = 63
#: The index has so many blocks of 32 bits each.
BLOCKS = 2 * PRINT_WORDS
#: So many pairs of a window and an item are looked up in the index at once.
CELLS = 1 << 22
#: Items are taken in parts of about so many bytes of text; every document meets every part.
PART_BYTES = 8 << 20


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words at all places of a slice, across its texts."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(total, np.uint64)
    for i in range(n):
        out += hashes[i : i + total] * np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3) | 1) & 0xFFFFFFFFFFFFFFFF)
    return mix(out)


def bit_sums(shingles: np.ndarray, word: int) -> np.ndarray:
    """Running sums (one more row than shingles) of +1 or -1 for each of the 64 bits of a word of fingerprints."""
    own = mix(shingles ^ np.uint64((0x9E3779B97F4A7C15 * word) & 0xFFFFFFFFFFFFFFFF))
    bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    return np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, 0, dtype=np.int32)])


def fingerprints(shingles: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash, a row of PRINT_WORDS words, of the shingles from begin to end, each with the weight of its number of occurrences."""
    out = np.empty((len(begin), PRINT_WORDS), np.uint64)
    for word in range(PRINT_WORDS):
        sums = bit_sums(shingles, word)
        out[:, word] = np.packbits(sums[end] - sums[begin] > 0, axis=1).view(np.uint64).ravel()
    return out


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater number of occurrences of each shingle."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    na, nb = np.bincount(at[: len(a)], minlength=len(values)), np.bincount(at[len(a) :], minlength=len(values))
    return float(np.minimum(na, nb).sum() / np.maximum(na, nb).sum())


class HammingIndex:
    """All of some fingerprints within a radius of a query.

    Two fingerprints within RADIUS differ in RADIUS // BLOCKS bits at most in one of their BLOCKS blocks: the pairs with
    a block so near, under one in a hundred of random ones, are compared in whole.
    """

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.blocks = self.blocks_of(prints)

    @staticmethod
    def blocks_of(prints: np.ndarray) -> np.ndarray:
        """A row of 32-bit blocks for each place: all fingerprints' first blocks, then their second ones, and so on."""
        return np.ascontiguousarray(np.ascontiguousarray(prints).view(np.uint32).reshape(-1, BLOCKS).T)

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, fingerprint) indices of all pairs within the radius, for CELLS pairs at a time."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        step = max(1, CELLS // len(self.prints))
        for at in range(0, len(queries), step):
            some = queries[at : at + step]
            found = np.zeros((len(some), len(self.prints)), bool)
            for own, theirs in zip(self.blocks_of(some), self.blocks, strict=True):
                found |= np.bitwise_count(own[:, None] ^ theirs[None, :]) <= self.radius // BLOCKS
            q, f = np.nonzero(found)
            good = np.bitwise_count(some[q] ^ self.prints[f]).sum(1, dtype=np.int64) <= self.radius
            out.append((at + q[good], f[good]))
        return np.concatenate([q for q, _ in out]), np.concatenate([f for _, f in out])


@dataclass
class Items:
    """Benchmark items: their number of words and their shingles, of min(WORDS, words) words."""

    ids: list
    sizes: np.ndarray
    shingles: list[np.ndarray]

    @cached_property
    def by_size(self) -> dict[int, tuple[np.ndarray, HammingIndex]]:
        """For each number of words, the items that have it and the index of their fingerprints."""
        out = {}
        for n in np.unique(self.sizes).tolist():
            which = np.flatnonzero(self.sizes == n)
            prints = np.concatenate([fingerprints(s, np.array([0]), np.array([len(s)])) for s in (self.shingles[i] for i in which)])
            out[n] = (which, HammingIndex(prints))
        return out

    @cached_property
    def holders(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each shingle length: the shingles of items in order, their (shingle, item size) pairs, and a bit table."""
        out = {}
        for g in np.unique(np.minimum(self.sizes, WORDS)).tolist():
            pairs = {(int(s), int(n)) for n, ss in zip(self.sizes, self.shingles, strict=True) if min(n, WORDS) == g for s in ss.tolist()}
            keys, sizes = (np.array(x, kind) for x, kind in zip(zip(*sorted(pairs), strict=True), (np.uint64, np.int64), strict=True))
            table = np.zeros(1 << 20, bool)
            table[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            out[g] = (keys, sizes, np.unique(keys), table)
        return out


def items_of(ids: list, texts: list) -> Items:
    with np.errstate(over="ignore"):
        found_ids, sizes, shingles = [], [], []
        at = 0
        for a, b, data, offsets in slices(pa.array(texts, pa.large_string()), lower=True):
            words = words_of(data, offsets, NOT_WORD)
            for i in range(b - a):
                own = words.hashes[words.starts[i] : words.starts[i + 1]]
                if len(own):
                    found_ids.append(ids[at])
                    sizes.append(len(own))
                    shingles.append(grams(own, min(WORDS, len(own))))
                at += 1
    return Items(found_ids, np.array(sizes, np.int64), shingles)


def windows(words: Words, items: Items):
    """(n, g, begin, end, text) of the windows to fingerprint: runs of as many words as an item has, or a whole text
    that has fewer, where at least one shingle is one of an item of that size. Others have nothing in common with it.
    """
    starts = words.starts
    total = len(words.hashes)
    for g, (keys, sizes, distinct, table) in items.holders.items():
        shingles = grams(words.hashes, g)
        hits = np.flatnonzero(table[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(hits):
            continue
        at = np.minimum(np.searchsorted(distinct, shingles[hits]), len(distinct) - 1)
        hits = hits[distinct[at] == shingles[hits]]
        text = np.searchsorted(starts, hits, "right") - 1
        inside = hits + g <= starts[text + 1]
        hits, text = hits[inside], text[inside]
        if not len(hits):
            continue
        first, last = np.searchsorted(keys, shingles[hits], "left"), np.searchsorted(keys, shingles[hits], "right")
        which = np.repeat(np.arange(len(hits)), last - first)
        size = sizes[np.repeat(first - np.append(0, np.cumsum(last - first))[:-1], last - first) + np.arange(len(which))]
        for n in np.unique(size).tolist():
            hit = which[size == n]
            p, t = hits[hit], text[hit]
            low, high = starts[t], starts[t + 1]
            a = np.maximum(p - (n - g), low)
            b = np.maximum(np.minimum(p, high - n), low)
            # A difference array marks the union of the intervals a to b of window starts.
            mark = np.zeros(total + 2, np.int32)
            np.add.at(mark, np.minimum(a, b), 1)
            np.add.at(mark, b + 1, -1)
            begin = np.flatnonzero(np.cumsum(mark) > 0)
            owner = np.searchsorted(starts, begin, "right") - 1
            yield n, g, begin, np.minimum(begin + n, starts[owner + 1]), owner, shingles


def matches(words: Words, items: Items, similarity: float):
    """(text, item, similarity, first word, words) of the best window for each text and item that has one."""
    best: dict[tuple[int, int], tuple] = {}
    for n, g, begin, end, owner, shingles in windows(words, items):
        enough = end - begin >= g
        begin, end, owner = begin[enough], end[enough], owner[enough]
        if not len(begin):
            continue
        which, index = items.by_size[n]
        # Sums over the stretches of words that windows cover, not over the whole slice.
        groups = np.split(np.arange(len(begin)), np.flatnonzero(begin[1:] - begin[:-1] > n) + 1)
        for group in groups:
            low, high = begin[group[0]], end[group].max() - g + 1
            b, e = begin[group] - low, end[group] - g + 1 - low
            q, f = index.within(fingerprints(shingles[low:high], b, e))
            for i, k in zip(q.tolist(), f.tolist(), strict=True):
                w, item = group[i], int(which[k])
                score = weighted_similarity(shingles[begin[w] : end[w] - g + 1], items.shingles[item])
                key = (int(owner[w]), item)
                if score >= similarity and (key not in best or score > best[key][0]):
                    best[key] = (score, int(begin[w] - words.starts[owner[w]]), int(end[w] - begin[w]))
    return [(t, i, *v) for (t, i), v in sorted(best.items())]


def parts_of(benchmark: DataFrame, id_col: str, text_col: str):
    """Items in parts of about PART_BYTES each; one part is in the driver's memory at a time."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // PART_BYTES
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).orderBy("id", "text").collect()
        yield items_of([r["id"] for r in rows], [r["text"] for r in rows])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", similarity: float = SIMILARITY) -> DataFrame:
    """(id, item, similarity, first_word, n_words) for each row of docs and benchmark item that is in its text.

    Words are runs of letters and digits (and of all that isn't ASCII), in lower case; shingles have WORDS words,
    or an item's whole sequence where it has fewer. An item is in a text where a window of as many words as it has
    (or the whole of a shorter text) has a weighted Jaccard similarity of shingles, by their number of occurrences,
    of `similarity` or more; the best window is given, of several the first. Windows whose SimHash is within RADIUS
    of an item's are compared; at similarity 0.8, about one in 60,000 is not. Null and empty texts and items
    without words match nothing; items and rows that repeat are told apart as rows. An empty benchmark finds nothing.
    """
    out = None
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    for items in parts_of(benchmark, item_col, "text" if text_col not in benchmark.columns else text_col):
        schema = f"id {kinds[0]}, item {kinds[1]}, similarity double, first_word int, n_words int"
        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan(docs, items, similarity, keep=None), schema)
        out = found if out is None else out.unionByName(found)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def scan(docs: DataFrame, items: Items, similarity: float, keep: int | None):
    """A function for mapInArrow: rows of matches, or (keep: the text's column) the batch's rows without any."""
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1 if keep is None else keep)
            rows = []
            with np.errstate(over="ignore"):
                for at, _, data, offsets in slices(texts, lower=True):
                    if len(sent.value.ids):
                        rows += [(at + t, *rest) for t, *rest in matches(words_of(data, offsets, NOT_WORD), sent.value, similarity)]
            if keep is not None:
                good = np.ones(batch.num_rows, bool)
                good[[r[0] for r in rows]] = False
                yield batch.filter(pa.array(good))
                continue
            if not rows:
                continue
            at, item, score, first, n = zip(*rows, strict=True)
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array([sent.value.ids[i] for i in item]), pa.array(score, pa.float64()), pa.array(first, pa.int32()), pa.array(n, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "item", "similarity", "first_word", "n_words"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, all columns as they are, whose text holds no benchmark item (see `contaminated`)."""
    for items in parts_of(benchmark, item_col, "text" if text_col not in benchmark.columns else text_col):
        docs = docs.mapInArrow(scan(docs, items, similarity, keep=docs.columns.index(text_col)), docs.schema)
    return docs
