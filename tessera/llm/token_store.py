"""Token ids in a content-addressed store: chunks, recipes and Merkle manifests."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordering import bounds_for, prefix_sums, range_of
from .runtime import Scratch, is_small, shared_path
from .words import Remembered, buffers, mix, powers, two_hashes

END_ID = 2
#: A chunk ends where a hash of the last WINDOW ids has its high CUT_BITS bits zero, and after MOST_IDS at the latest.
WINDOW, CUT_BITS, MOST_IDS = 16, 9, 8192
#: Texts with white space before a blank aren't cut at blanks; Rust's \\s is within this class.
RUNS, SPACE_AT_END = r"[\s\v\x{85}\p{Z}] ", r"[\s\v\x{85}\p{Z}]$"
#: Chunks that were used before are broadcast up to this count, else met by a shuffle.
BROADCAST_ROWS = 500_000
#: Distinct pieces are encoded in runs of about so many bytes, texts in batches of BATCH_BYTES.
RUN_BYTES, BATCH_BYTES = 1 << 14, 4 << 20
#: A worker process remembers the ids of so many pieces from one batch and task to the next.
REMEMBERED = 2_000_000
#: Between a letter or digit and one of these no token spans; nor between what can be seen and a line feed.
STOPS = np.zeros(256, bool)
STOPS[list(b".,;:!?)")] = True
ALNUM, SEEN = np.zeros(256, bool), np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
SEEN[33:127] = True


@lru_cache(2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return tokenizer(path).get_vocab_size()


def runs_of(lists: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """lists[starts[i] : starts[i + 1]] for each i of which, one after the other, and where each begins (one more entry)."""
    n = (starts[1:] - starts[:-1])[which]
    at = np.append(0, np.cumsum(n))
    return lists[np.repeat(starts[:-1][which] - at[:-1], n) + np.arange(at[-1])], at


class Encoder:
    """Ids of texts by a byte-level BPE of the tokenizers library.

    Its pre-tokenizer never joins what stands before a blank that follows a character other than white space with
    what comes after, nor a letter or digit with a stop after it, nor what can be seen with a single line feed. So texts
    are cut there, and each distinct piece is encoded once: those that begin with a blank or line feed one after the
    other, and their ids told apart by their bytes. Texts with white space before a blank are encoded as they are. The
    ids of pieces are remembered for later batches; at REMEMBERED of them, they are forgotten and learned anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads
        self.tokenizer = tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a byte-level token has a character for each byte
        self.known = Remembered()

    def plainly(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that begin with a blank or line feed, and where each one's begin (one more entry)."""
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        data, offsets = buffers(pieces)
        cuts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], RUN_BYTES)), len(pieces)))
        runs = [str(memoryview(data)[offsets[i] : offsets[j]], "utf-8") for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        ids = np.concatenate(self.plainly(runs))
        return ids, np.append(0, np.searchsorted(np.cumsum(self.bytes_of[ids]), offsets[1:], "left") + 1)

    def learn(self, pieces: pa.Array, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The numbers of new pieces."""
        data, offsets = buffers(pieces)
        spaced = pc.match_substring_regex(pieces, SPACE_AT_END).to_numpy(zero_copy_only=False)
        led = np.isin(data[offsets[:-1]], [10, 32]) & ~spaced  # white space never runs from one into the next
        numbers = np.zeros(len(pieces), np.int64)
        ids, starts = self.joined(pieces.filter(pa.array(led)))
        numbers[led] = self.known.add(keys[led], checks[led], ids, starts)
        singly = self.plainly(pieces.filter(pa.array(~led)).to_pylist())
        starts = np.append(0, np.cumsum([len(x) for x in singly], dtype=np.int64))
        numbers[~led] = self.known.add(keys[~led], checks[~led], np.concatenate([np.zeros(0, np.uint32), *singly]), starts)
        return numbers

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts (large strings, none with white space before a blank), and where each text's begin."""
        data, offsets = buffers(texts)
        cuts = data == 32
        cuts[1:] |= ALNUM[data[:-1]] & STOPS[data[1:]]
        if len(data) > 2:
            cuts[1:-1] |= (data[1:-1] == 10) & SEEN[data[:-2]] & SEEN[data[2:]]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        feeds = inner[data[inner - 1] == 10] - 1
        cuts[feeds] = False  # a line feed that ends a text is no cut
        cuts[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.flatnonzero(cuts)
        ends = np.append(begin, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
        return pieces, np.searchsorted(begin, offsets)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin (one more entry); null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pc.invert(pc.match_substring_regex(texts, RUNS)).to_numpy(zero_copy_only=False)
        odd, even = np.flatnonzero(~plain), np.flatnonzero(plain)
        others = self.plainly(texts.take(pa.array(odd)).to_pylist())
        with np.errstate(over="ignore"):
            pieces, offsets = self.cut(texts.take(pa.array(even)))
            coded = pieces.dictionary_encode()
            keys, checks = two_hashes(coded.dictionary)
            if len(self.known.keys) > REMEMBERED:
                self.known = Remembered()
            numbers, known = self.known.look(keys, checks)
            if not known.all():
                numbers[~known] = self.learn(coded.dictionary.filter(pa.array(~known)), keys[~known], checks[~known])
        whole, at = self.known.ids_at(numbers[coded.indices.to_numpy()])
        if not len(odd):
            return whole, at[offsets]
        # Texts that were cut come first here, in the order of `even`, then the others.
        starts = np.concatenate([at[offsets], at[-1] + np.cumsum([len(x) for x in others], dtype=np.int64)])
        order = np.empty(len(texts), np.int64)
        order[np.concatenate([even, odd])] = np.arange(len(texts))
        return runs_of(np.concatenate([whole, *others]).astype(np.uint32), starts, order)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_ends(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with END_ID after each text's ids."""
    return np.insert(ids, starts[1:], np.uint32(END_ID)), starts + np.arange(len(starts))


def chunk_ends(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the chunks of some texts' ids end: at the texts' ends, and where the rolling hash says so.

    The hash depends on the WINDOW ids before a place alone, as far as they are in the same text. It comes from
    running sums of each id times a power, which a shift makes independent of the place.
    """
    n = len(ids)
    with np.errstate(over="ignore"):
        power, inverse = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * inverse[:n], out=sums[1:])
        low = np.maximum(np.arange(1, n + 1) - WINDOW, np.repeat(starts[:-1], np.diff(starts)))
        rolled = mix((sums[1:] - sums[low]) * power[1 : n + 1])
    ends = np.unique(np.concatenate([np.flatnonzero((rolled >> np.uint64(64 - CUT_BITS)) == 0) + 1, starts[1:]]))
    ends = ends[ends > 0]
    size = np.diff(ends, prepend=0)
    more = (size - 1) // MOST_IDS
    if more.any():
        first, extra = ends - size, np.cumsum(more) - more
        inside = np.repeat(first, more) + MOST_IDS * (np.arange(more.sum()) - np.repeat(extra, more) + 1)
        ends = np.sort(np.concatenate([ends, inside]))
    return ends


def little(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of a binary SHA-256 tree; an odd last node goes up as it is, no leaves give the hash of nothing."""
    level = list(leaves) or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo the CRC-32 polynomial, lowest power in the highest bit."""
    out, b = np.zeros(len(a), np.uint32), b.copy()
    for i in range(31, -1, -1):
        out ^= b & -(a >> np.uint32(i) & np.uint32(1))
        b = b >> np.uint32(1) ^ (np.uint32(0xEDB88320) & -(b & np.uint32(1)))
    return out


def byte_shifts(n: np.ndarray) -> np.ndarray:
    """x ** (8 n) modulo the CRC-32 polynomial, for each n."""
    out, square = np.full(len(n), 1 << 31, np.uint32), np.full(1, 1 << 23, np.uint32)
    for bit in range(int(n.max(initial=0)).bit_length()):
        has = np.flatnonzero(n >> bit & 1)
        out[has] = multiply(out[has], np.repeat(square, len(has)))
        square = multiply(square, square)
    return out


def joined_crcs(crcs: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The CRC-32s of strings of bytes from those of their pieces: string i has pieces starts[i] to starts[i + 1], of `sizes` bytes.

    A piece's CRC counts times the power that the bytes after it in its string give.
    """
    upto = np.append(0, np.cumsum(sizes))
    after = np.repeat(upto[starts[1:]], np.diff(starts)) - upto[1:]
    parts = multiply(byte_shifts(after), crcs.astype(np.uint32))
    sums = np.append(np.uint32(0), np.bitwise_xor.accumulate(parts) if len(parts) else parts)
    return sums[starts[1:]] ^ sums[starts[:-1]]


def encoded(texts: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last + 1, ids, where each text's begin) with END_ID after each, a few MB of text at a time."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, "right")))
        yield at, to, *with_ends(*encoder(path).encode(texts.slice(at, to - at)))
        at = to


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of the bytes of data[ends[i - 1] : ends[i]]."""
    offsets = np.append(0, ends).astype(np.int32) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def write_store(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of docs' whole texts (null: empty), each with END_ID at its end, to a store in the folder `path`.

    `recipes`, a row for each row of docs in the order of id (nulls first; rows that share one by a hash of the
    text): id, start (ids before it), n_tokens, digests (SHA-256 of its chunks' ids as little-endian 32-bit
    integers), root (of their Merkle tree). `chunks`, each distinct chunk once, where the first document that has it
    stands: digest, n, ids (16 bits each, 32 where the vocabulary needs it). Both lie in a folder for each range of
    ids, range=0 and on, in ascending order within and between them. `manifest`, a row for each range: its recipes,
    chunk references and the root of its recipes' roots; with range -1 the root of all. `format`: the type of id
    and the bits of a token id.

    Texts are encoded once, to a table of each text's chunks in the shared folder. Digests alone are shuffled to
    find where a chunk is first used; then ids are shuffled once, by range.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    bounds = bounds_for(docs.select("id", F.octet_length("text").cast("long").alias("size")), "id", "size")
    width = "<u4" if vocabulary_size(tokenizer_path) > 1 << 16 else "<u2"
    scratch = Scratch(spark, "token-store")
    spark.createDataFrame([(kind, 8 * np.dtype(width).itemsize)], "id_type string, id_bits int").coalesce(1).write.parquet(f"{path}/format")

    def chunks(batches):
        import pyarrow as pa

        for batch in batches:
            for at, to, ids, starts in encoded(batch.column(1), tokenizer_path):
                ends = chunk_ends(ids, starts)
                data = memoryview(ids.astype("<u4")).cast("B")
                digests = [hashlib.sha256(data[4 * a : 4 * b]).digest() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                cuts = np.searchsorted(ends, starts, "right")  # chunks before each text: texts end with one
                roots = [merkle(digests[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                lists = lambda values: pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values)  # noqa: B023, E731
                columns = [pa.array(np.diff(starts)), lists(pa.array(digests, pa.binary())), pa.array(roots, pa.binary()), lists(binaries(ids.astype(width), ends))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), batch.column(2).slice(at, to - at), *columns], names=["id", "h", "n_tokens", "digests", "root", "ids"])

    cut = docs.withColumn("h", F.xxhash64("text")).mapInArrow(chunks, f"id {kind}, h long, n_tokens long, digests array<binary>, root binary, ids array<binary>")
    staged = scratch.table(cut.withColumn("row", F.monotonically_increasing_id()), "staged", compression="zstd")
    recipes = prefix_sums(staged.drop("ids"), "id", "n_tokens", bounds, ["h"]).withColumn("range", range_of(F.col("id"), bounds))
    recipes.repartition("range").sortWithinPartitions("range", "start").write.partitionBy("range").parquet(f"{path}/recipes")
    recipes = read_recipes(spark, path)
    uses = recipes.select("row", "start", F.posexplode("digests").alias("seq", "digest"))
    first = uses.groupBy("digest").agg(F.min(F.struct("start", "seq")).alias("first"))
    again = uses.join(first, "digest").where(F.struct("start", "seq") != F.col("first"))
    spare = scratch.table(again.select("row", "seq"), "spare")
    pieces = staged.select("row", "id", "h", F.posexplode(F.arrays_zip("digests", "ids")).alias("seq", "c")).select("row", "id", "h", "seq", F.col("c.digests").alias("digest"), "c.ids")
    if is_small(spare, BROADCAST_ROWS):
        kept = pieces.join(F.broadcast(spare), ["row", "seq"], "left_anti")
    else:  # a mark for each spare chunk is sorted in before it, in the same shuffle
        marks = spare.join(staged.select("row", "id", "h"), "row").select("row", "id", "h", "seq", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("binary").alias("ids"))
        ranged = pieces.unionByName(marks).withColumn("range", range_of(F.col("id"), bounds))
        mark = F.lag(F.col("digest").isNull() & F.col("ids").isNull(), 1, False).over(Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "h", "row", "seq", F.col("digest").asc_nulls_first()))
        kept = ranged.withColumn("spare", mark).where("digest is not null and not spare").drop("spare", "range")
    kept = kept.withColumn("range", range_of(F.col("id"), bounds)).repartition("range").sortWithinPartitions("range", F.col("id").asc_nulls_first(), "h", "row", "seq")
    size = np.dtype(width).itemsize
    kept.select("range", "digest", (F.octet_length("ids") / size).cast("int").alias("n"), "ids").write.option("compression", "zstd").partitionBy("range").parquet(f"{path}/chunks")
    scratch.drop("staged", "spare")
    ranges = range_roots(recipes)
    rows = ranges.orderBy("range").collect()  # at most as many as ranges
    top = merkle([bytes(r["root"]) for r in rows])
    total = (-1, sum(r["recipes"] for r in rows), sum(r["references"] for r in rows), bytearray(top))
    spark.createDataFrame([total, *[tuple(r) for r in rows]], ranges.schema).coalesce(1).write.parquet(f"{path}/manifest")


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    kind = spark.read.parquet(f"{path}/format").first()["id_type"]
    schema = f"id {kind}, h long, n_tokens long, digests array<binary>, root binary, row long, start long, range int"
    return spark.read.schema(schema).parquet(f"{path}/recipes")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("digest binary, n int, ids binary, range int").parquet(f"{path}/chunks")


def range_roots(recipes: DataFrame) -> DataFrame:
    """(range, recipes, references, root) from recipe rows, whose order is by start."""

    def one(pdf):
        import pandas as pd

        pdf = pdf.sort_values("start")
        return pd.DataFrame([{"range": pdf["range"].iloc[0], "recipes": len(pdf), "references": int(pdf["refs"].sum()), "root": merkle([bytes(x) for x in pdf["root"]])}])

    light = recipes.select("range", "start", F.size("digests").alias("refs"), "root")
    return light.groupBy("range").applyInPandas(one, "range int, recipes long, references long, root binary")


def chunk_facts(spark: SparkSession, path: str) -> DataFrame:
    """(digest, n, crc) of the stored chunks, all from their ids; crc is of 32-bit little-endian integers."""

    def facts(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = ids.as_py()
                data = little(np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4"))
                rows.append((hashlib.sha256(data).digest(), len(data) // 4, zlib.crc32(data)))
            digest, n, crc = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["digest", "n", "crc"])

    return read_chunks(spark, path).select("n", "ids").mapInArrow(facts, "digest binary, n long, crc long")


def read_facts(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32, verified) for each document of a store, from its files.

    Chunks are looked up by the digest of the ids that the files hold; a document's count and CRC are put together
    from those of its chunks. verified: its chunks give the recipe's Merkle root and its number of ids. A chunk
    that is missing or damaged, or a manifest that doesn't fit the recipes, raises an error.
    """
    recipes = read_recipes(spark, path)
    said = spark.read.parquet(f"{path}/manifest").where("range >= 0")
    check = range_roots(recipes).join(said.withColumnsRenamed({"root": "said", "recipes": "r", "references": "f"}), "range", "full")
    if not check.where(~(F.col("root").eqNullSafe(F.col("said")) & F.col("recipes").eqNullSafe(F.col("r")) & F.col("references").eqNullSafe(F.col("f")))).isEmpty():
        raise ValueError(f"the manifest in {path} doesn't fit its recipes")
    uses = recipes.select("start", F.posexplode("digests").alias("seq", "digest"))
    found = uses.join(chunk_facts(spark, path).withColumn("there", F.lit(True)), "digest", "left")
    found = found.withColumn("there", F.coalesce("there", F.raise_error(F.lit("a chunk is missing or damaged")).cast("boolean")))
    parts = found.where("there").groupBy("start").agg(F.sort_array(F.collect_list(F.struct("seq", "digest", "n", "crc"))).alias("parts"))
    kind = recipes.schema["id"].dataType.simpleString()

    def put_together(batches):
        import pyarrow as pa

        for batch in batches:
            starts = batch.column(4).offsets.to_numpy().astype(np.int64)
            parts = batch.column(4).flatten()
            digests, sizes, crcs = parts.field(1).to_pylist(), parts.field(2).to_numpy(), parts.field(3).to_numpy()
            starts -= starts[0]
            total = np.append(0, np.cumsum(sizes))
            n = total[starts[1:]] - total[starts[:-1]]
            roots = [merkle(digests[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            good = [a == b and x == y for a, b, x, y in zip(n.tolist(), batch.column(2).to_pylist(), roots, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(joined_crcs(crcs, 4 * sizes, starts).astype(np.int64)), pa.array(good, pa.bool_())], names=["id", "start", "n_tokens", "ids_crc32", "verified"])

    joined = recipes.select("id", "start", "n_tokens", "root").join(parts, "start").select("id", "start", "n_tokens", "root", "parts")
    return joined.mapInArrow(put_together, f"id {kind}, start long, n_tokens long, ids_crc32 long, verified boolean").withColumnRenamed("id", id_col)


def read_ids(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) for each document of a store: its chunks fetched and put together in order."""
    recipes = read_recipes(spark, path)
    uses = recipes.select("id", "start", F.posexplode("digests").alias("seq", "digest"))
    whole = uses.join(read_chunks(spark, path), "digest").groupBy("id", "start").agg(F.sort_array(F.collect_list(F.struct("seq", "n", "ids"))).alias("parts"))
    kind = recipes.schema["id"].dataType.simpleString()

    def put_together(batches):
        import pyarrow as pa

        for batch in batches:
            ids = [np.concatenate([np.frombuffer(p["ids"], "<u2" if len(p["ids"]) == 2 * p["n"] else "<u4") for p in parts]).astype(np.int64) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int64()))], names=["id", "start", "ids"])

    return whole.select("id", "start", "parts").mapInArrow(put_together, f"id {kind}, start long, ids array<long>").withColumnRenamed("id", id_col)


def new_store(spark: SparkSession) -> str:
    return shared_path(spark, "token-store")
