"""Phrase collocations from vertical lists: for each word and phrase, the positions at which it occurs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import Scratch, looked_up, small, written
from .words import TO_LOWER, mix, slices

#: A phrase is a candidate from so many occurrences on; the best of each language are returned.
LEAST, TOP, PERCENT = 10, 2000, 50
#: Texts of one language are indexed in chunks of about so many bytes.
CHUNK_BYTES = 8 << 20
#: Phrases are dealt by hash into one bucket for so many words of the corpus; a bucket is summed up by one task.
BUCKET_WORDS = 500_000
#: Where a piece ends, and where a word does.
BREAKS, BLANKS = np.zeros(256, bool), np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANKS[[0x20, 0x09]] = True
#: Ids of words and phrases have 32 bits, so that a phrase's id and a word's make one key.
ID_BITS, ID_MASK = np.uint64(32), np.uint64((1 << 32) - 1)


def vertical(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the length of each one's list of positions, and the lists one after the other.

    Positions grow by one from word to word within a piece, and by two from piece to piece: words at consecutive
    positions, and only those, stand next to each other.
    """
    low = TO_LOWER[data]
    inside = ~(BREAKS | BLANKS)[low]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(low))]
    starts[cut] = inside[cut]
    begin = np.flatnonzero(starts)
    at = np.append(np.cumsum(inside)[begin] - 1, inside.sum())
    pieces = np.cumsum(BREAKS[low])[begin] + np.searchsorted(offsets, begin, "right")
    position = np.arange(len(begin)) + np.append(0, np.cumsum(np.diff(pieces) > 0))[: len(begin)]
    coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(low[inside])).dictionary_encode()
    word = coded.indices.to_numpy()
    return coded.dictionary, np.bincount(word, minlength=len(coded.dictionary)), position[np.argsort(word, kind="stable")]


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same texts; one that is much longer than a chunk is cut at ends of pieces, where no phrase goes across."""
    if len(data) < 2 * CHUNK_BYTES:
        yield data, offsets
        return
    ends = np.flatnonzero(BREAKS[data]) + 1
    cuts = ends[np.searchsorted(ends, np.arange(CHUNK_BYTES, len(data) - CHUNK_BYTES, CHUNK_BYTES))[: len(ends)] % max(1, len(ends))] if len(ends) else ends
    cuts = np.unique(np.concatenate([[0], cuts, [len(data)]])).astype(np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        inner = offsets[(offsets > a) & (offsets < b)]
        yield data[a:b], np.concatenate([[a], inner, [b]]) - a


def deltas(positions: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each list's first position, then the distances to the next ones."""
    out = np.diff(positions, prepend=0).astype(np.int32)
    first = np.cumsum(sizes) - sizes
    out[first[sizes > 0]] = positions[first[sizes > 0]]
    return out


def undone(distances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.cumsum(distances, dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    return sums - np.repeat(sums[first] - distances[first], sizes)


def chunk_lists(docs: DataFrame) -> DataFrame:
    """(chunk, lang, n, words, counts, positions): vertical lists of chunks of docs (lang, text)."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            order = np.argsort(langs.indices.to_numpy(), kind="stable")
            cuts = np.searchsorted(langs.indices.to_numpy()[order], np.arange(len(langs.dictionary) + 1))
            for lang, a, b in zip(langs.dictionary.to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                texts = batch.column(1).take(pa.array(order[a:b]))
                for _, _, data, offsets in slices(texts, CHUNK_BYTES):
                    for some, own in stretches(data, offsets):
                        words, counts, positions = vertical(some, own)
                        if not len(words):
                            continue
                        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                        packed = pa.array([deltas(positions, counts).tobytes()], pa.binary())
                        columns = [pa.array([chunk]), pa.array([lang]), pa.array([int(counts.sum())]), one(words.cast(pa.string())), one(pa.array(counts.astype(np.int32))), packed]
                        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "lang", "n", "words", "counts", "positions"])
                        chunk += 1

    return docs.mapInArrow(run, "chunk long, lang string, n long, words array<string>, counts array<int>, positions binary")


def numbered(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """df as a written table with `id`: places from 0 without gaps, in no order that matters."""
    rows = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    parts = scratch.table(df.withColumns({"part": F.spark_partition_id(), "row": rows}), name)
    return with_base(parts, parts.groupBy("part").agg(F.count("*").alias("n")), "part").withColumn("id", F.col("base") + F.col("row")).drop("part", "row", "base")


def with_base(df: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """df with `base`, the sum of n over the rows of sizes (key, n) whose key is less; keys are integers, each once."""
    group = F.floor(F.col(key) / 4096)
    sizes = sizes.withColumn("group", group)
    totals = sizes.groupBy("group").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("before", F.sum("total").over(Window.orderBy("group")) - F.col("total"))
    inner = F.sum("n").over(Window.partitionBy("group").orderBy(key)) - F.col("n")
    bases = sizes.withColumn("inner", inner).join(totals, "group").select(key, (F.col("before") + F.col("inner")).alias("base"))
    return df.join(bases, key)


def postings(counts: np.ndarray, distances: bytes, places: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of a chunk's frequent words in order, and the word's id at each. places: these words' among the chunk's."""
    positions = undone(np.frombuffer(distances, np.int32), counts)
    id_of = np.full(len(counts), -1, np.int64)
    id_of[places] = ids
    word = np.repeat(id_of, counts)
    positions, word = positions[word >= 0], word[word >= 0]
    order = np.argsort(positions)
    return positions[order], word[order].astype(np.uint64)


def extended(ends: np.ndarray, phrases: np.ndarray, posts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases that end at `ends`, each with the word that follows: merges two lists in order of position.

    Returns where the longer phrases end and their keys, of a phrase's id and a word's.
    """
    if not len(posts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.minimum(np.searchsorted(posts, ends + 1), len(posts) - 1)
    hit = posts[at] == ends + 1
    return ends[hit] + 1, (phrases[hit] << ID_BITS) | words[at[hit]]


def bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of distinct keys by bucket, the buckets that have any, and where each begins in it (one more entry)."""
    with np.errstate(over="ignore"):
        bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    return order, used, np.append(first, len(keys))


def lengths(chunk: int, keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The lengths of a chunk's lists of phrases, a row for each bucket."""
    used, counts = np.unique(keys, return_counts=True)
    order, which, cuts = bucketed(used, buckets)
    used, counts = used[order], counts[order].astype(np.uint32)
    parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    columns = [pa.array(which, pa.int64()), pa.array([chunk] * len(which), pa.int64()), pa.array([used[a:b].tobytes() for a, b in parts], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "chunk", "keys", "counts"])


LENGTHS = "bucket long, chunk long, keys binary, counts binary"
SUMS = "bucket long, chunk long, keys array<long>, sums array<long>, mask binary, places binary"


def frequent(rows: DataFrame, least: int, tell_chunks: bool) -> DataFrame:
    """For each bucket of rows (LENGTHS) the phrases of `least` occurrences and more: keys and sums, with chunk -1.

    tell_chunks: also a row for each chunk: which of its phrases of the bucket are among them (a mask, in the order in
    which they came), and the places of these in the bucket's keys.
    """

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("keys")]
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")])
        used, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(at, counts, minlength=len(used)).astype(np.int64)  # exact below 2 ** 53
        good = sums >= least
        place = np.cumsum(good) - 1
        one = [used[good].view(np.int64), sums[good]]
        chunks, masks, places = [-1], [None], [None]
        if tell_chunks:
            for chunk, own in zip(table.column("chunk").to_pylist(), np.split(at, np.cumsum([len(k) for k in keys])[:-1]), strict=True):
                chunks.append(chunk)
                masks.append(np.packbits(good[own]).tobytes())
                places.append(place[own[good[own]]].astype(np.uint32).tobytes())
        lists = [pa.array([x, *[None] * (len(chunks) - 1)], pa.list_(pa.int64())) for x in one]
        bucket = pa.array([table.column("bucket")[0].as_py()] * len(chunks), pa.int64())
        return pa.Table.from_arrays([bucket, pa.array(chunks, pa.int64()), *lists, pa.array(masks, pa.binary()), pa.array(places, pa.binary())], names=["bucket", "chunk", "keys", "sums", "mask", "places"])

    return rows.groupBy("bucket").applyInArrow(run, SUMS)


def posting_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(chunk, positions, words, row) of the rows of a batch (chunk, counts, positions, found)."""
    for i in range(batch.num_rows):
        found = batch.column(3)[i].values
        counts = batch.column(1)[i].values.to_numpy()
        posts, words = postings(counts, batch.column(2)[i].as_py(), found.field(0).to_numpy(), found.field(1).to_numpy())
        yield batch.column(0)[i].as_py(), posts, words, i


def pair_lengths(indexed: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for chunk, posts, words, _ in posting_rows(batch):
                _, keys = extended(posts, words, posts, words)
                if len(keys):
                    yield lengths(chunk, keys, buckets)

    return indexed.mapInArrow(run, LENGTHS)


def triple_lengths(indexed: DataFrame, buckets: int) -> DataFrame:
    """From indexed with `told`, what the buckets of pairs say of each chunk: (bucket, base, mask, places)."""

    def run(batches):
        for batch in batches:
            for chunk, posts, words, i in posting_rows(batch):
                ends, keys = extended(posts, words, posts, words)
                used, at = np.unique(keys, return_inverse=True)
                order, which, cuts = bucketed(used, buckets)
                ids = np.full(len(used), -1, np.int64)
                told = {t["bucket"]: t for t in batch.column(4)[i].as_py() or []}
                for bucket, a, b in zip(which.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    own = told[bucket]
                    mask = np.unpackbits(np.frombuffer(own["mask"], np.uint8), count=b - a).astype(bool)
                    ids[order[a:b][mask]] = own["base"] + np.frombuffer(own["places"], np.uint32)
                pair = ids[at]
                ends, last, pair = ends[pair >= 0], (keys & ID_MASK)[pair >= 0], pair[pair >= 0].astype(np.uint64)
                # The word that follows must end a frequent pair too.
                _, keys = extended(ends, pair, ends, last)
                if len(keys):
                    yield lengths(chunk, keys, buckets)

    return indexed.mapInArrow(run, LENGTHS)


def phrases_of(sums: DataFrame) -> DataFrame:
    """(bucket, place, first, second, a) of the rows of frequent phrases: the two ids of a key, and its occurrences."""
    rows = sums.where("chunk = -1").select("bucket", F.posexplode(F.arrays_zip("keys", "sums")).alias("place", "x"))
    return rows.select("bucket", "place", F.shiftrightunsigned("x.keys", 32).alias("first"), F.col("x.keys").bitwiseAND((1 << 32) - 1).alias("second"), F.col("x.sums").alias("a"))


def few_enough(df: DataFrame) -> DataFrame:
    if (df.agg(F.max("id")).first()[0] or 0) > int(ID_MASK):
        raise ValueError("more than 2 ** 32 frequent words or pairs")
    return df


def score_of(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), exact for frequencies up to 4e15."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(l) * wide(r))


def best_of(rows: DataFrame, by: str, score: str, then: list[Column], top: int) -> DataFrame:
    """rows with `rank`, from 1, up to `top` for each value of `by`: by score, the greatest first, then by `then`.

    Rows are dealt into parts by hash, and each part keeps its best. If every part has its share of `top`, the least of
    the scores at which the parts reach their share is a bound below which no row can be among the best: few more than
    `top` rows are ordered in the end.
    """
    parts = int(max(1, (rows.count() / top) ** 0.5))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(parts))
    order = [F.col(score).desc(), *then]
    first = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy(by, "salt").orderBy(*order))).where(F.col("rank") <= top)
    reached = first.where(F.col("rank") == -(-top // parts)).groupBy(by).agg(F.min(score).alias("least"), F.count("*").alias("n")).where(F.col("n") == parts)
    cut = first.join(small(written(reached.select(by, "least"), "best-of"), 100_000), by, "left").where(F.col("least").isNull() | (F.col(score) >= F.col("least")))
    return cut.drop("salt", "least").withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, percent: int = PERCENT, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of two and three words of each language.

    A-Z is lower-cased; texts (null: empty) are cut into pieces at [.,;:!?\\x0A-\\x0D], these into words at blanks and
    tabs. A null language is `und`. a is a phrase's number of occurrences within pieces, overlaps included; from `least`
    on it is a candidate. Cut after its first words, l and r are the occurrences of the two parts, and score is
    floor(1000000 a a / (l r)), that of the worst cut (ties: the shortest first part). A candidate whose words lie
    within a longer candidate with `percent` per cent of its occurrences or more is dropped. n counts the language's
    words. Ranks go by score, occurrences, then phrase; a language without phrases has no rows. Other columns are ignored.

    Texts are indexed in chunks: for each word the list of its positions. Lists of phrases come from merging the
    positions at which frequent phrases end with those of the word that follows; their lengths, summed over chunks,
    are exact frequencies. A phrase takes part in the next step only if both shorter ones are frequent. Chunks are
    bounded by bytes; each names a phrase once, however often it occurs; phrases are dealt into buckets by hash.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "collocations")
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = scratch.table(chunk_lists(texts), "chunks", compression="zstd")
    totals = scratch.table(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    buckets = 1 + int((totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)

    counted = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    words = scratch.table(few_enough(numbered(counted.where(F.col("f") >= least), scratch, "frequent-words")), "words")
    held = chunks.select("chunk", "lang", F.posexplode("words").alias("i", "word")).join(words, ["lang", "word"])
    held = held.groupBy("chunk").agg(F.collect_list(F.struct("i", "id")).alias("found"))
    indexed = scratch.table(chunks.select("chunk", "counts", "positions").join(held, "chunk"), "indexed", compression="zstd")

    pair_sums = scratch.table(frequent(pair_lengths(indexed, buckets), least, tell_chunks=True), "pairs")
    based = with_base(pair_sums, pair_sums.where("chunk = -1").select("bucket", F.size("keys").alias("n")), "bucket")
    told = based.where("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "base", "mask", "places")).alias("told"))
    triple_sums = scratch.table(frequent(triple_lengths(indexed.join(told, "chunk"), buckets), least, tell_chunks=False), "triples")

    pairs = with_base(phrases_of(pair_sums), pair_sums.where("chunk = -1").select("bucket", F.size("keys").alias("n")), "bucket")
    pairs = scratch.table(few_enough(pairs.select((F.col("base") + F.col("place")).alias("id"), "first", "second", "a")), "pair-ids")
    facts = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("f").alias(f"{name}_f"), "lang")
    pairs = looked_up(looked_up(pairs, facts("first"), "first", scratch).drop("lang"), facts("second"), "second", scratch)
    pairs = scratch.table(pairs, "pair-facts")
    triples = phrases_of(triple_sums).select(F.col("first").alias("id"), F.col("second").alias("third"), "a")
    left = pairs.select("id", "lang", F.col("second").alias("middle"), "first_word", "second_word", "first_f", F.col("a").alias("left_a"))
    right = pairs.select(F.col("id").alias("right_id"), F.col("first").alias("middle"), F.col("second").alias("third"), F.col("second_word").alias("third_word"), F.col("second_f").alias("third_f"), F.col("a").alias("right_a"))
    triples = scratch.table(triples.join(left, "id").join(right, ["middle", "third"]), "triple-facts")

    longer = triples.select("a", F.explode(F.array("id", "right_id")).alias("id")).groupBy("id").agg(F.max("a").alias("longer"))
    kept = pairs.join(longer, "id", "left").where(F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True)))
    two = kept.select("lang", F.concat_ws(" ", "first_word", "second_word").alias("phrase"), "a", F.col("first_f").alias("l"), F.col("second_f").alias("r")).withColumn("score", score_of("a", "l", "r"))
    cuts = triples.withColumns({"one": score_of("a", "first_f", "right_a"), "two": score_of("a", "left_a", "third_f")})
    cut = lambda x, y: F.when(F.col("two") < F.col("one"), F.col(y)).otherwise(F.col(x))
    three = cuts.select("lang", F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"), "a", cut("first_f", "left_a").alias("l"), cut("right_a", "third_f").alias("r"), cut("one", "two").alias("score"))
    scored = scratch.table(two.unionByName(three), "scored")
    best = best_of(scored, "lang", "score", [F.col("a").desc(), F.col("phrase").asc()], top)
    scratch.drop("chunks", "frequent-words", "words", "indexed", "pairs", "triples", "pair-ids", "pair-facts", "triple-facts")
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
