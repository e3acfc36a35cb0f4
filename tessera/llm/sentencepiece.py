"""SentencePiece encoding and decoding in batches of equally long words."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .words import Remembered, buffers, mix, two_hashes

UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"
#: Words of more characters are handled singly where no place cuts them.
LONG = 256
#: A worker process remembers the ids of so many words from one batch and task to the next.
REMEMBERED = 500_000
#: Bits of the hashes by which most substrings are known to be no piece without a search.
SIEVE_BITS = 20
#: Texts are handled in batches of about so many characters, words in batches of CELLS characters.
BATCH_CHARS, CELLS = 1 << 19, 1 << 16
CODES = 0x110000


@dataclass
class Pieces:
    """A model file's pieces, in arrays."""

    kind: int
    scores: np.ndarray
    #: Sorted hashes of the pieces of two characters and more, their ids, and the ids of single characters (-1: none).
    keys: np.ndarray
    ids: np.ndarray
    single: np.ndarray
    longest: int
    #: Characters that are part of pieces of two characters and more; a word ends before and after all others.
    joins: np.ndarray
    byte_ids: np.ndarray
    unknown_id: int
    unknown_score: float
    prefix: bool
    #: What each piece decodes to: its bytes and where they begin.
    data: np.ndarray
    offsets: np.ndarray
    #: The characters of the pieces of two and more, in the order of keys, and where they begin (one more entry).
    chars: np.ndarray
    starts: np.ndarray
    known: Remembered = field(default_factory=Remembered)

    @cached_property
    def sieve(self) -> np.ndarray:
        out = np.zeros(1 << SIEVE_BITS, bool)
        out[(self.keys & np.uint64((1 << SIEVE_BITS) - 1)).astype(np.int64)] = True
        return out

    def find(self, h: np.ndarray, text: np.ndarray, begin: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """The ids (-1: none) of the pieces with the given hashes that are the characters of text from begin, size of them."""
        out = np.full(len(h), -1, np.int32)
        may = np.flatnonzero(self.sieve[(h & np.uint64((1 << SIEVE_BITS) - 1)).astype(np.int64)])
        if not len(self.keys) or not len(may):
            return out
        at = np.minimum(np.searchsorted(self.keys, h[may]), len(self.keys) - 1)
        hit = self.keys[at] == h[may]
        may, at = may[hit], at[hit]
        own = self.starts[at + 1] - self.starts[at]
        same = own == (size if isinstance(size, int) else size[may])
        for i in range(self.longest if len(at) else 0):
            deep = np.flatnonzero(same & (own > i))
            if not len(deep):
                break
            same[deep] = text[begin[may[deep]] + i] == self.chars[self.starts[at[deep]] + i]
        out[may[same]] = self.ids[at[same]]
        return out


def hashes(codes: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Running sums along the last axis from which any substring's hash follows."""
    n = codes.shape[-1]
    power = np.append(np.uint64(1), np.multiply.accumulate(np.full(max(n, 1), base, np.uint64)))[:n]
    sums = np.zeros((*codes.shape[:-1], n + 1), np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, axis=-1, out=sums[..., 1:])
    return sums


@lru_cache(16)
def inverse_powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    return np.append(np.uint64(1), np.multiply.accumulate(np.full(n, pow(base, -1, 1 << 64), np.uint64)))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def load(model: bytes, kind: int | None = None) -> Pieces:
    """Pieces of a serialised model of the kinds UNIGRAM and BPE, with byte fallback or not.

    kind: take its pieces and scores as a model of that kind. Models that normalise characters or drop white space are refused: their rules are a table of their own.
    """
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    rules = proto.normalizer_spec
    if proto.trainer_spec.model_type not in (UNIGRAM, BPE) or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models without character normalisation are supported")
    with np.errstate(over="ignore"):
        by_size, single, joins = {}, np.full(CODES, -1, np.int32), np.zeros(CODES, bool)
        scores = np.array([p.score for p in proto.pieces], np.float64)
        byte_ids, unknown, out = np.full(256, -1, np.int32), 0, []
        for i, p in enumerate(proto.pieces):
            out.append(b"" if p.type == CONTROL else p.piece.replace(SPACE, " ").encode())
            if p.type == BYTE:
                byte_ids[int(p.piece[3:5], 16)] = i
                out[-1] = bytes([int(p.piece[3:5], 16)])
            elif p.type == UNKNOWN:
                unknown, out[-1] = i, " ⁇ ".encode()
            elif p.type in (NORMAL, USER):
                if len(p.piece) == 1:
                    single[ord(p.piece)] = i
                else:
                    by_size.setdefault(len(p.piece), []).append((i, p.piece))
        keys, ids, longest = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], max(by_size, default=1)
        words: list[str] = []
        for size, some in by_size.items():
            codes = codes_of("".join(x for _, x in some)).reshape(-1, size)
            keys.append(mix(hashes(codes)[:, -1]))
            ids.append(np.array([i for i, _ in some], np.int32))
            words += [x for _, x in some]
            joins[codes.ravel()] = True
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(keys)
    least = min((p.score for p in proto.pieces if p.type == NORMAL), default=0.0)
    return Pieces(
        kind or proto.trainer_spec.model_type, scores, keys[order], ids[order], single, longest, joins, byte_ids if (byte_ids >= 0).all() else np.full(256, -1, np.int32),
        unknown, least - 10, rules.add_dummy_prefix, np.frombuffer(b"".join(out), np.uint8), np.append(0, np.cumsum([len(x) for x in out])),
        codes_of("".join(words[i] for i in order)), np.append(0, np.cumsum([len(words[i]) for i in order], dtype=np.int64)),
    )


@lru_cache(4)
def load_file(path: str, kind: int | None = None) -> Pieces:
    with open(path, "rb") as f:
        return load(f.read(), kind)


def probe(words: np.ndarray, p: Pieces) -> np.ndarray:
    """Ids (-1: none) of the pieces at [word, first character, length]; all words are equally long."""
    n, length = words.shape
    most = min(p.longest, length)
    found = np.full((n, length, most + 1), -1, np.int32)
    found[:, :, 1] = p.single[words]
    sums, inverse, flat = hashes(words), inverse_powers(1 << length.bit_length()), words.ravel()
    for size in range(2, most + 1):
        h = mix((sums[:, size:] - sums[:, :-size]) * inverse[: length - size + 1])
        places = (np.arange(n) * length)[:, None] + np.arange(length - size + 1)
        found[:, : length - size + 1, size] = p.find(h.ravel(), flat, places.ravel(), size).reshape(h.shape)
    return found


def viterbi(found: np.ndarray, p: Pieces) -> np.ndarray:
    """For each word and character, the end of the piece that begins there on the path of the greatest sum, else 0."""
    n, length, most = found.shape[0], found.shape[1], found.shape[2] - 1
    score = np.where(found >= 0, p.scores[found], -np.inf)
    score[:, :, 1] = np.where(found[:, :, 1] >= 0, score[:, :, 1], p.unknown_score)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, length + 1), np.int64)
    for end in range(1, length + 1):
        sizes = np.arange(min(most, end), 0, -1)  # the first of equal maxima is the longest piece
        sums = best[:, end - sizes] + score[:, end - sizes, sizes]
        at = sums.argmax(1)
        best[:, end] = sums[np.arange(n), at]
        back[:, end] = sizes[at]
    ends = np.zeros((n, length), np.int64)
    at, rows = np.full(n, length), np.arange(n)
    while len(rows):
        start = at - back[rows, at]
        ends[rows, start] = at
        rows, at = rows[start > 0], start[start > 0]
    return ends


def merges(found: np.ndarray, p: Pieces) -> np.ndarray:
    """The same for a BPE model: in each round, every word joins its pair of the greatest score, the leftmost of ties."""
    n, length, most = found.shape[0], found.shape[1], found.shape[2] - 1
    score = np.where(found >= 0, p.scores[found], -np.inf).reshape(n, -1)
    score = np.hstack([score, np.full((n, 1), -np.inf)])
    ends = np.tile(np.arange(1, length + 1), (n, 1))
    place = np.arange(length)
    rows, own = np.arange(n), ends.copy()
    while len(rows):
        after = np.take_along_axis(np.hstack([own, np.zeros((len(rows), 1), np.int64)]), own, 1)
        size = after - place
        can = (own > 0) & (after > 0) & (size <= most)
        sums = np.take_along_axis(score, np.where(can, place * (most + 1) + size, score.shape[1] - 1), 1)
        at = sums.argmax(1)
        k = np.arange(len(rows))
        go = sums[k, at] > -np.inf
        ends[rows[~go]] = own[~go]
        middle = own[k[go], at[go]]
        own[k[go], at[go]] = after[k[go], at[go]]
        own[k[go], middle] = 0
        rows, own, score = rows[go], own[go], score[go]
    return ends


def long_merges(word: np.ndarray, p: Pieces) -> np.ndarray:
    """`merges` for one long word: a heap of pairs instead of rounds over all of it."""
    sums, inverse = hashes(word), inverse_powers(1 << (len(word)).bit_length())
    n = len(word)
    end, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    heap: list[tuple] = []

    def push(i: int) -> None:
        j = int(end[i])
        if i >= 0 and j < n and end[j] - i <= p.longest:
            piece = int(p.find(mix((sums[end[j]] - sums[i : i + 1]) * inverse[i]), word, np.array([i]), int(end[j]) - i)[0])
            if piece >= 0:
                heapq.heappush(heap, (-p.scores[piece], i, j, int(end[j])))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] == j and end[j] == k:
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
                push(i)
            if before[i] >= 0:
                push(int(before[i]))
    return end


def ids_of(words: np.ndarray, found: np.ndarray, ends: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and the number of each word's."""
    row, at = np.nonzero(ends)
    size = ends[row, at] - at
    ids = found[row, at, np.minimum(size, found.shape[2] - 1)]
    return with_bytes(ids, words[row, at], row, len(words), p)


def with_bytes(ids: np.ndarray, codes: np.ndarray, row: np.ndarray, n: int, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters (id -1) replaced by the pieces of their UTF-8 bytes, or by the unknown piece."""
    if p.byte_ids[0] < 0:
        return np.where(ids < 0, p.unknown_id, ids), np.bincount(row, minlength=n)
    many = np.ones(len(ids), np.int64)
    lost = np.flatnonzero(ids < 0)
    raw = [chr(c).encode() for c in codes[lost].tolist()]
    many[lost] = [len(x) for x in raw]
    out = np.repeat(ids, many)
    out[out < 0] = p.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(np.repeat(row, many), minlength=n)


def encode_words(words: list[np.ndarray] | np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    found = probe(words, p)
    return ids_of(words, found, (merges if p.kind == BPE else viterbi)(found, p), p)


def long_viterbi(word: np.ndarray, p: Pieces) -> np.ndarray:
    """`viterbi` for one long word, whose pieces are looked up a stretch at a time: only the best sums of the last `longest` places are needed."""
    n, most = len(word), min(p.longest, len(word))
    best, back = np.full(n + 1, -np.inf), np.ones(n + 1, np.int64)
    best[0] = 0
    sizes = np.arange(most, 0, -1)
    for low in range(0, n, LONG):
        # Scores by place of the piece's end and size, for ends in low + 1 to high.
        high, start = min(low + LONG, n), max(0, low - most)
        found = probe(word[None, start:high], p)[0]
        score = np.where(found >= 0, p.scores[found], -np.inf)
        score[:, 1] = np.where(found[:, 1] >= 0, score[:, 1], p.unknown_score)
        for end in range(low + 1, high + 1):
            own = sizes[sizes <= min(end, found.shape[1] - 1)]
            sums = best[end - own] + score[end - own - start, own]
            at = int(sums.argmax())
            best[end], back[end] = sums[at], own[at]
    ends, at = np.zeros(n, np.int64), n
    while at:
        ends[at - back[at]] = at
        at -= back[at]
    return ends


def encode_long(word: np.ndarray, p: Pieces) -> np.ndarray:
    ends = (long_merges if p.kind == BPE else long_viterbi)(word, p)
    at = np.flatnonzero(ends)
    sums, inverse = hashes(word), inverse_powers(1 << len(word).bit_length())
    ids = np.where(ends[at] - at == 1, p.single[word[at]], p.find(mix((sums[ends[at]] - sums[at]) * inverse[at]), word, at, ends[at] - at))
    return with_bytes(ids, word[at], np.zeros(len(at), np.int64), 1, p)[0]


def cuts_of(word: np.ndarray, p: Pieces) -> np.ndarray:
    """The places within a word that no piece goes across: its parts are encoded as words of their own."""
    crossed = np.zeros(len(word) + 1, np.int64)
    sums, inverse = hashes(word), inverse_powers(1 << len(word).bit_length())
    for size in range(2, min(p.longest, len(word)) + 1):
        at = np.flatnonzero(p.find(mix((sums[size:] - sums[:-size]) * inverse[: len(word) - size + 1]), word, np.arange(len(word) - size + 1), size) >= 0)
        crossed[at + 1] += 1
        np.subtract.at(crossed, at + size, 1)
    return 1 + np.flatnonzero(np.cumsum(crossed)[1 : len(word)] == 0)


def encode_batch(texts: list[str], p: Pieces) -> list[np.ndarray]:
    """Ids of whole texts. An empty text has none."""
    prefix = SPACE if p.prefix else ""
    whole = [prefix + t if t else "" for t in texts]
    codes = codes_of("".join(whole))
    codes = np.where(codes == 32, np.uint32(ord(SPACE)), codes)
    starts = np.append(0, np.cumsum([len(t) for t in whole]))
    if not len(codes):
        return [np.zeros(0, np.int32) for _ in texts]
    with np.errstate(over="ignore"):
        space, joins = codes == ord(SPACE), p.joins[codes]
        first = space.copy()
        first[1:] &= ~space[:-1]
        first |= ~joins
        first[1:] |= ~joins[:-1]
        first[starts[:-1][np.diff(starts) > 0]] = True
        begin = np.flatnonzero(first)
        length = np.diff(np.append(begin, len(codes)))
        for w in np.flatnonzero(length > LONG):
            first[begin[w] + cuts_of(codes[begin[w] : begin[w] + length[w]], p)] = True
        begin = np.flatnonzero(first)
        bounds = pa.py_buffer(4 * np.append(begin, len(codes)).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, bounds, pa.py_buffer(np.ascontiguousarray(codes))]).dictionary_encode()
        keys, checks = two_hashes(coded.dictionary)
        if len(p.known.keys) > REMEMBERED:
            p.known = Remembered()
        numbers, known = p.known.look(keys, checks)
        new = np.flatnonzero(~known)
        data, at = buffers(coded.dictionary)
        words, first, lengths = data.view(np.uint32), at[new] // 4, np.diff(at)[new] // 4
        # Ids of the distinct words that weren't met before, by length.
        parts, counts, order = [np.zeros(0, np.int32)], np.zeros(len(new), np.int64), [np.zeros(0, np.int64)]
        for size in np.unique(lengths).tolist():
            which = np.flatnonzero(lengths == size)
            if size > LONG:
                for w in which:
                    ids = encode_long(words[first[w] : first[w] + size], p)
                    parts.append(ids)
                    counts[w] = len(ids)
                order.append(which)
                continue
            step = max(1, CELLS // size)
            for k in range(0, len(which), step):
                some = which[k : k + step]
                ids, n = encode_words(words[first[some][:, None] + np.arange(size)], p)
                parts.append(ids)
                counts[some] = n
                order.append(some)
    order = np.concatenate(order)
    numbers[new[order]] = p.known.add(keys[new[order]], checks[new[order]], np.concatenate(parts), np.append(0, np.cumsum(counts[order])))
    ids, at = p.known.ids_at(numbers[coded.indices.to_numpy()])
    cuts = at[np.searchsorted(begin, starts)]
    return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def decode_batch(rows: list[np.ndarray], p: Pieces) -> list[str]:
    """Texts of ids: pieces one after the other, runs of bytes as UTF-8 (what isn't is replaced), without the prefix."""
    ids = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)
    size = np.diff(p.offsets)[ids]
    at = np.append(0, np.cumsum(size))
    data = p.data[np.repeat(p.offsets[ids] - at[:-1], size) + np.arange(at[-1])]
    cuts = at[np.append(0, np.cumsum([len(r) for r in rows]))]
    out = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [t[1:] if p.prefix and t[:1] == " " else t for t in out]


def batches_of(texts: pa.Array):
    """(first, texts) in batches of about BATCH_CHARS bytes; null is empty."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_CHARS, "right")))
        yield at, [t or "" for t in texts.slice(at, to - at).to_pylist()]
        at = to


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", kind: int | None = None) -> DataFrame:
    """(id, ids, n_tokens, round_trip) for each row of docs.

    ids are those of the model (no begin or end marks) for the whole text; null and empty texts have none. kind:
    take the model's pieces and scores as those of a UNIGRAM model (the path of the greatest sum of scores, by
    Viterbi) or of a BPE model (merges), whatever the file says. round_trip: decoding gives the text again, which it does but for U+2581, the model's own mark for a blank.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        p = load_file(model_path, kind)
        for batch in batches:
            for at, texts in batches_of(batch.column(1)):
                rows = encode_batch(texts, p)
                same = [a == b for a, b in zip(texts, decode_batch(rows, p), strict=True)]
                n = np.array([len(r) for r in rows], np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(np.concatenate(rows).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), ids, pa.array(n), pa.array(same)], names=["id", "ids", "n_tokens", "round_trip"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {id_type}, ids array<int>, n_tokens int, round_trip boolean").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for each row of ids; null ids give a null text."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        p = load_file(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column(1).to_pylist()
                texts = decode_batch([np.array(x or [], np.int32) for x in ids], p)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if x is None else t for x, t in zip(ids, texts, strict=True)], pa.string())], names=["id", "text"])

    return rows.select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
