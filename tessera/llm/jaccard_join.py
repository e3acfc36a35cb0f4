"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import connected_components
from .runtime import Scratch, small
from .words import SPACES, mix, shingles, slices, words_of

BITS = 1024
#: A block of a tile has about so many sets and shingles at most (a single larger set is a block of its own).
BLOCK_SETS, BLOCK_SHINGLES = 1000, 1_000_000
#: Ids, keys and tiles are broadcast up to this count, else joined by a shuffle.
BROADCAST_ROWS = 500_000
#: A task remembers so many digests, to give the keys of equal sets once.
SEEN = 100_000
#: Keys of a task are looked at in runs of about so many: of the sets of a run that share a key, one stands for all.
RUN_KEYS = 1_000_000
#: What a set is under a key: alone in its run, the first of several, or one of the others; times 2, plus the key's side.
ALONE, FIRST, OTHER = 0, 2, 4
SALT = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Likeness:
    """Sets link when 100 * intersection >= percent * union; shingles have `words` words."""

    words: int = 5
    percent: int = 80

    @cached_property
    def band_starts(self) -> np.ndarray:
        """A set of band g links with sets of bands g - 1, g and g + 1 only."""
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(starts[-1] * 100 // self.percent + 1)
        return np.array(starts)

    def bands(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.band_starts, n, "right") - 1

    def key_bands(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bands, two of the above each, that the smaller set of a pair may have: the set's own, and the one below it or -1."""
        band = self.bands(n)
        return band // 2, np.where(band % 2 == 0, band // 2 - 1, -1)

    def differ(self, key_band: np.ndarray) -> np.ndarray:
        """By how many elements two linked sets, the smaller of this key band, can differ."""
        a = self.band_starts[2 * key_band + 2] - 1
        return (a + a * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)

    @staticmethod
    def weak(differ: np.ndarray) -> np.ndarray:
        """How many of its parts with the fewest elements a set leaves out."""
        return differ // 5 + 1

    @staticmethod
    def spare(differ: np.ndarray) -> np.ndarray:
        """How many of the others, those whose keys the most sets have, it leaves out."""
        return differ // 8 + 1


@dataclass
class Sets:
    """The sorted distinct shingles of some texts, one after the other, and where each text's begin (one more entry)."""

    shingles: np.ndarray
    starts: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.shingles[self.starts[i] : self.starts[i + 1]]

    @cached_property
    def mixed(self) -> np.ndarray:
        return mix(self.shingles)

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
        return total[self.starts[1:]] - total[self.starts[:-1]]

    @cached_property
    def digests(self) -> np.ndarray:
        """128 bits that equal sets share; the first 64 stand for a set where a chance of meeting another does no harm."""
        return np.stack([self.sums(self.mixed), self.sums(mix(self.shingles ^ SALT)) + np.diff(self.starts).astype(np.uint64)], 1)


def sets_of(texts: pa.Array, like: Likeness) -> Iterator[tuple[int, Sets]]:
    """(index of the first text, sets) for slices of texts of bounded size."""
    with np.errstate(over="ignore"):
        for at, to, data, offsets in slices(texts):
            found, starts = shingles(words_of(data, offsets, SPACES), like.words)
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                found[a:b].sort()
            keep = np.ones(len(found), bool)
            keep[1:] = found[1:] != found[:-1]
            keep[starts[:-1][np.diff(starts) > 0]] = True
            yield at, Sets(found[keep], np.append(0, np.cumsum(keep))[starts])


def keys_of(sets: Sets, bands: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, where each set's begin, how many may be left out) for pairs whose smaller set is of the given key bands (-1: none).

    Let two sets that link differ by d elements at most. The hash range is cut into d + 1 + weak + spare parts, so
    weak + spare + 1 parts at least are equal in both; a part's key is a hash of its elements. In any one order of
    keys, each set may leave out the `weak` last: a key that both have is lost only where it is among the last
    ones of one of them, so spare + 1 are left in both. The order here is by the number of elements, the empty parts
    last. After that the same holds for `spare` keys in another order (see `kept_keys`).

    Where a set has more than weak + spare empty parts, its equal parts may all be empty, but only in a pair of two
    such sets; these have their first (1 - percent) n + 1 elements in hash order as keys too: one is common to both.
    Sets that can't differ (d = 0) have no keys.
    """
    n, differ = np.diff(sets.starts), like.differ(np.maximum(bands, 0))
    used = (bands >= 0) & (differ > 0) & (n > 0)
    weak, spare = like.weak(differ), like.spare(differ)
    parts = np.where(used, differ + 1 + weak + spare, 0)
    base = np.append(0, np.cumsum(parts))
    owner = np.repeat(np.arange(len(n)), n)
    with np.errstate(over="ignore"):
        at = (sets.shingles >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)
        inside = used[owner]
        counts = np.bincount(base[owner[inside]] + at[inside].astype(np.int64), minlength=base[-1])
        # A set's elements are in hash order, so a part's are next to each other.
        total = np.append(np.uint64(0), np.cumsum(sets.mixed[inside], dtype=np.uint64))
        ends = np.cumsum(counts)
        of = np.repeat(np.arange(len(n)), parts)
        tag = mix((np.arange(base[-1]) - base[of]).astype(np.uint64) + (parts[of].astype(np.uint64) << np.uint64(24)) + (bands[of].astype(np.uint64) << np.uint64(56)))
        keys = mix((total[ends] - total[ends - counts]) ^ tag)
        full = np.flatnonzero(counts > 0)
        empty = parts - np.bincount(of[full], minlength=len(n))
        order = full[np.lexsort((keys[full], -counts[full], of[full]))]
        mine = np.bincount(of[full], minlength=len(n))
        emitted = mine - np.minimum(np.maximum(weak - empty, 0), mine)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(mine) - mine, mine)
        order = order[rank < emitted[of[order]]]
        out, out_of = keys[order], of[order]
        sparse = used & (empty > weak + spare)
        if sparse.any():
            prefix = np.where(sparse, n - -(-n * like.percent // 100) + 1, 0)
            first = np.repeat(sets.starts[:-1] - (np.cumsum(prefix) - prefix), prefix) + np.arange(prefix.sum())
            who = np.repeat(np.arange(len(n)), prefix)
            out, out_of = np.append(out, mix(sets.shingles[first] ^ mix(bands[who].astype(np.uint64) + SALT))), np.append(out_of, who)
            again = np.argsort(out_of, kind="stable")
            out, out_of = out[again], out_of[again]
    may = np.where(used, np.maximum(spare - np.maximum(empty - weak, 0), 0), 0)
    return out, np.append(0, np.cumsum(np.bincount(out_of, minlength=len(n)))), may


def lists(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> pa.Array:
    """A list column of values[starts[i] : starts[i + 1]] for each i of which."""
    n = (starts[1:] - starts[:-1])[which]
    offsets = np.append(0, np.cumsum(n))
    flat = values[np.repeat(starts[:-1][which] - offsets[:-1], n) + np.arange(offsets[-1])]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))


def binary(digests: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in digests], pa.binary())


def under_keys(keys: np.ndarray) -> np.ndarray:
    """ALONE, FIRST or OTHER for each key of a run."""
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])[: len(keys)]
    alone = new & np.append(new[1:], True)[: len(keys)]
    out = np.zeros(len(keys), np.int8)
    out[order] = np.where(alone, ALONE, np.where(new, FIRST, OTHER))
    return out


def sketches(docs: DataFrame, like: Likeness) -> DataFrame:
    """docs (id, text) to (id, digest, d, n, lead, keys, spare_own, spare_below), one row for each.

    keys are (key, code) for pairs whose smaller set is of the set's own key band (side 0) or of the one below (1);
    code is the side plus what the set is under the key in its run. Of sets that are equal and were met lately in the
    same task, only the first (lead) has keys.
    """
    names = ["id", "digest", "d", "n", "lead", "keys", "spare_own", "spare_below"]
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        seen: OrderedDict[bytes, None] = OrderedDict()
        held, size = [], 0

        def flushed():
            keys = np.concatenate([h[0] for h in held])
            codes = under_keys(keys) + np.concatenate([h[1] for h in held])
            pairs = pa.StructArray.from_arrays([pa.array(keys.view(np.int64)), pa.array(codes)], names=["key", "code"])
            at = 0
            for own, _, counts, columns in held:
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*columns[:5], pa.ListArray.from_arrays(offsets, pairs.slice(at, len(own))), *columns[5:]], names=names)
                at += len(own)

        for batch in batches:
            for at, sets in sets_of(batch.column(1), like):
                n, digests = np.diff(sets.starts), binary(sets.digests)
                lead = np.zeros(len(n), bool)
                for i, x in enumerate(digests.to_pylist()):
                    lead[i] = n[i] > 0 and x not in seen
                    seen[x] = None
                    seen.move_to_end(x)
                for _ in range(len(seen) - SEEN):
                    seen.popitem(last=False)
                which = np.flatnonzero(lead)
                first = Sets(np.concatenate([sets.of(i) for i in which] or [np.zeros(0, np.uint64)]), np.append(0, np.cumsum(n[which])))
                found = [keys_of(first, b, like) for b in like.key_bands(n[which])]
                owner = np.concatenate([np.repeat(which, np.diff(starts)) for _, starts, _ in found])
                order = np.argsort(owner, kind="stable")
                sides = np.repeat([0, 1], [len(keys) for keys, _, _ in found]).astype(np.int8)
                spares = [np.zeros(len(n), np.int32) for _ in found]
                for out, (_, _, spare) in zip(spares, found, strict=True):
                    out[which] = spare
                columns = [batch.column(0).slice(at, len(n)), digests, pa.array(sets.digests[:, 0].view(np.int64)), pa.array(n.astype(np.int64)), pa.array(lead), *map(pa.array, spares)]
                held.append((np.concatenate([keys for keys, _, _ in found])[order], sides[order], np.bincount(owner, minlength=len(n)), columns))
                size += len(owner)
                if size > RUN_KEYS:
                    yield from flushed()
                    held, size = [], 0
        if held:
            yield from flushed()

    schema = f"id {kind}, digest binary, d long, n long, lead boolean, keys array<struct<key: long, code: tinyint>>, spare_own int, spare_below int"
    return docs.mapInArrow(run, schema)


def kept_keys(sketch: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, d): the keys that several sets have, without those that a set may leave out.

    Keys of one set alone lead nowhere, and come first in the order of in how many runs a key is; of the others each
    set leaves out the spare ones that are in the most runs. So a passage that many texts share gives them no common
    key unless it fills a good part of them. Keys are shuffled once, a row for each run that has them; rows of other
    sets of a run meet what was found, and a key that very many sets have is met by a join that Spark can split.
    """
    leads = sketch.where("lead").select("row", "digest", "d", "keys", "spare_own", "spare_below")
    twice = leads.groupBy("digest").agg(F.min("row").alias("first"), F.count("*").alias("c")).where("c > 1").select("digest", "first")
    leads = leads.join(small(scratch.table(twice, "repeated-sets"), BROADCAST_ROWS), "digest", "left").where("first is null or first = row")
    rows = leads.select("d", F.explode("keys").alias("x")).select("d", "x.key", "x.code")
    by_key = Window.partitionBy("key")
    runs = rows.where(F.col("code") < OTHER).withColumns({"runs": F.count("*").over(by_key), "crowd": F.max("code").over(by_key) >= FIRST})
    shared = scratch.table(runs.where("runs > 1 or crowd"), "shared-keys")
    crowded = shared.where("crowd").groupBy("key").agg(F.max("runs").alias("runs"))
    others = rows.where(F.col("code") >= OTHER).join(crowded, "key")
    every = shared.select("d", "key", "code", "runs").unionByName(others).withColumn("side", F.col("code") % 2)
    spare = leads.select("d", "spare_own", "spare_below")
    rank = F.row_number().over(Window.partitionBy("d", "side").orderBy(F.desc("runs"), "key"))
    ranked = every.withColumn("rank", rank).join(small(scratch.table(spare.join(every.select("d").distinct(), "d", "left_semi"), "spares"), BROADCAST_ROWS), "d")
    return ranked.where(F.col("rank") > F.when(F.col("side") == 0, F.col("spare_own")).otherwise(F.col("spare_below"))).select("key", "d")


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BITS), bool)
    for i, s in enumerate(sets):
        out[i, (s % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def tile_links(pdf: pd.DataFrame, like: Likeness) -> pd.DataFrame:
    """Links (a, b) that connect what is connected in a tile of two blocks (sides 0 and 1) or of one.

    Pairs that are known to be connected (label) aren't looked at again. For the others, bits that differ bound the
    overlap from above: each stands for an element that only one of the two has. What passes is intersected exactly.
    """
    pdf = pdf.drop_duplicates("digest").sort_values("n", kind="stable")
    sets = [np.asarray(s).view(np.uint64) for s in pdf["shingles"]]
    maps, n, ids, side = bitmaps(sets), pdf["n"].to_numpy(), pdf["digest"].tolist(), pdf["side"].to_numpy()
    label = np.unique([bytes(x) for x in pdf["label"]], return_inverse=True)[1] if len(pdf) else np.zeros(0, int)
    two = len(np.unique(side)) > 1
    links = []
    for i in range(len(pdf)):
        to = int(np.searchsorted(n, n[i] * 100 // like.percent, "right"))
        j = i + 1 + np.flatnonzero((label[i + 1 : to] != label[i]) & (~two | (side[i + 1 : to] != side[i])))
        if not len(j):
            continue
        differ = np.bitwise_count(maps[j] ^ maps[i]).sum(1, dtype=np.int64)
        # union - intersection >= differ, and union + intersection = n_i + n_j
        j = j[differ * (100 + like.percent) <= (n[i] + n[j]) * (100 - like.percent)]
        for k in j:
            if label[k] == label[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * both >= like.percent * (n[i] + n[k] - both):
                links.append((ids[i], ids[k]))
                label[label == label[k]] = label[i]
    return pd.DataFrame(links, columns=["a", "b"])


def shingle_rows(docs: DataFrame, like: Likeness) -> DataFrame:
    """docs (text) to (digest, d, n, shingles)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for _, sets in sets_of(batch.column(0), like):
                n = np.diff(sets.starts)
                for at in range(0, len(n), 256):
                    which = np.arange(at, min(at + 256, len(n)))
                    columns = [binary(sets.digests[which]), pa.array(sets.digests[which, 0].view(np.int64)), pa.array(n[which].astype(np.int64)), lists(sets.shingles, sets.starts, which)]
                    yield pa.RecordBatch.from_arrays(columns, names=["digest", "d", "n", "shingles"])

    return docs.select("text").mapInArrow(run, "digest binary, d long, n long, shingles array<long>")


def star_links(sets: DataFrame, edges: DataFrame, like: Likeness) -> DataFrame:
    """Links (a, b) of sets (digest, d, n, shingles) with the least other set that they share a key with."""
    hubs = edges.groupBy(F.col("a").alias("d")).agg(F.min("b").alias("hub"))
    other = sets.select(F.col("d").alias("hub"), F.col("digest").alias("b"), F.col("n").alias("m"), F.col("shingles").alias("others"))
    pairs = sets.join(hubs, "d").join(other, "hub").where(F.col("digest") != F.col("b"))
    both = F.size(F.array_intersect("shingles", "others"))
    return pairs.where(100 * both >= like.percent * (F.col("n") + F.col("m") - both)).select(F.col("digest").alias("a"), "b")


def tiles_of(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(digest, label, family, lo, hi, side) for sets (digest, n, band, family, label) of large families.

    Each family's sets are cut into blocks by band and by whether they have the family's commonest label (main).
    Blocks of the same and the next band meet, unless both are main: their sets are connected already. So a cluster
    whose sets nearly all link with its hub needs no more tiles than its few other sets have blocks.
    """
    sizes = scratch.table(members.groupBy("family", "label").agg(F.count("*").alias("c")), "labels")
    main = sizes.groupBy("family").agg(F.max(F.struct("c", "label")).getField("label").alias("main"), F.count("*").alias("labels")).where("labels > 1").drop("labels")
    marked = members.join(main, "family").withColumn("is_main", (F.col("label") == F.col("main")).cast("int")).drop("main")
    salts = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    blocks = small(scratch.table(marked.groupBy("family", "band", "is_main").agg(salts.alias("salts")), "blocks"), BROADCAST_ROWS)
    code = lambda band, is_main, salt: (band * 2 + is_main).cast("long") * (1 << 32) + salt.cast("long")
    salted = marked.join(blocks, ["family", "band", "is_main"]).withColumn("mine", code(F.col("band"), F.col("is_main"), F.pmod(F.xxhash64("digest"), F.col("salts")))).drop("salts")
    others = blocks.select("family", F.col("band").alias("o_band"), F.col("is_main").alias("o_main"), F.col("salts").alias("o_salts"))
    met = salted.join(others, "family").where("abs(band - o_band) <= 1 and not (is_main = 1 and o_main = 1)")
    met = met.select("digest", "label", "family", "mine", "o_band", "o_main", F.explode(F.sequence(F.lit(0), F.col("o_salts") - 1)).alias("salt"))
    yours = code(F.col("o_band"), F.col("o_main"), F.col("salt"))
    return met.select("digest", "label", "family", F.least("mine", yours).alias("lo"), F.greatest("mine", yours).alias("hi"), (F.col("mine") > yours).cast("int").alias("side"))


def band_of(n: str, like: Likeness) -> Column:
    band = F.lit(0)
    for start in like.band_starts[1:].tolist():
        if start > 1 << 30:
            break
        band = band + (F.col(n) >= start).cast("int")
    return band


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = Likeness()) -> DataFrame:
    """(id, n_shingles, component_id) for each row of docs; component_id is the least id that links reach.

    Words are runs of characters other than space and 0x09 to 0x0D, A-Z lower-cased; a set is a text's distinct
    shingles, one of the whole sequence where it has fewer words than a shingle. Texts without words (and null)
    have an empty set, link with nothing and are their own component. Equal sets count as linked and go on as one;
    rows that repeat an id each get their own text's component.

    Sets that may link share a key (see keys_of, kept_keys), and those that are connected through keys form a family.
    A family of one block is a tile. In a larger one, each set is first compared with the least set that it shares
    a key with, which connects a cluster of near copies in one pass; blocks of sets of a size band then meet those of
    the same and the next band in tiles of bounded size, save where all is connected. Tiles give links enough to
    connect what they hold.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = scratch.table(sketches(base, like).withColumn("row", F.monotonically_increasing_id()), "sketch")
    kept = scratch.table(kept_keys(sketch, scratch), "kept-keys")
    hub = kept.groupBy("key").agg(F.min("d").alias("hub"), F.max("d").alias("last")).where("hub < last").drop("last")
    edges = scratch.table(kept.join(hub, "key").where("d <> hub").select(F.col("d").alias("a"), F.col("hub").alias("b")).distinct(), "key-links")
    scratch.drop("shared-keys", "repeated-sets", "spares", "kept-keys")
    family = scratch.table(connected_components(edges).select(F.col("node").alias("d"), F.col("root").alias("family")), "families")

    # One text of each set that is in a family.
    first = sketch.where("n > 0").groupBy("digest", "d", "n").agg(F.min("id").alias("id")).join(small(family, BROADCAST_ROWS), "d")
    first = scratch.table(first.withColumn("band", band_of("n", like)), "family-sets")
    chosen = small(first.select(F.col("id").alias("chosen")).distinct(), BROADCAST_ROWS)
    sets = shingle_rows(base.join(chosen, F.col("id").eqNullSafe(F.col("chosen")), "left_semi"), like)
    whole = scratch.table(first.groupBy("family").agg((F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES) > 1).alias("large")), "family-sizes")
    large = first.join(small(whole.where("large"), BROADCAST_ROWS), "family", "left_semi")
    little = first.join(small(whole.where("not large"), BROADCAST_ROWS), "family", "left_semi").select("digest", "family")
    tile = lambda *by: lambda df: df.groupBy(*by).applyInPandas(lambda pdf: tile_links(pdf, like), "a binary, b binary")
    links = sets.join(small(scratch.table(little, "little"), BROADCAST_ROWS), "digest").withColumns({"side": F.lit(0), "label": F.col("digest")}).transform(tile("family"))
    if not whole.where("large").isEmpty():
        large = scratch.table(large.select("digest", "n", "band", "family"), "large")
        big = scratch.table(sets.join(small(large.select("digest"), BROADCAST_ROWS), "digest", "left_semi").dropDuplicates(["digest"]), "large-sets")
        star = scratch.table(star_links(big, edges, like), "star-links")
        labels = connected_components(star).select(F.col("node").alias("digest"), F.col("root").alias("label"))
        members = scratch.table(large.join(labels, "digest", "left").withColumn("label", F.coalesce("label", "digest")), "members")
        placed = small(scratch.table(tiles_of(members, scratch), "tiles"), BROADCAST_ROWS)
        links = links.unionByName(star).unionByName(big.join(placed, "digest").transform(tile("family", "lo", "hi")))
    joined = connected_components(links)
    group = sketch.where("n > 0").groupBy("digest").agg(F.min("id").alias("least")).join(joined.withColumnRenamed("node", "digest"), "digest", "left")
    group = scratch.table(group.withColumn("root", F.coalesce("root", "digest")), "groups")
    component = group.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.table(group.join(component, "root").select("digest", "component_id"), "named")
    out = scratch.table(sketch.select("id", "digest", "n"), "sizes").join(named, "digest", "left")
    scratch.drop("sketch", "groups", "families", "family-sets", "family-sizes", "little", "large", "large-sets", "star-links", "members", "labels", "blocks", "tiles", "key-links")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
