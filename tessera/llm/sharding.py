"""K-d tree sharding: splits at weighted medians along the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import small, written

#: A row's place along a dimension: 31 bits of the value, then 32 bits that break ties: a hash of the row, and in the
#: last COPY_BITS one of its place in the input, which tells equal rows apart.
TIE_BITS, STEP_BITS, COPY_BITS = 32, 16, 8
#: Windows that number a shard's rows each have one of so many parts of it.
SLOT_PARTS = 64


@dataclass(frozen=True)
class Split:
    """Rows of `node` whose key along `dim` is at most `key` go to node 2n, the rest to 2n + 1."""

    node: int
    dim: int
    key: int


def categorical(c: str) -> Column:
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF))


def numeric(c: str) -> Column:
    """A count as an int of 31 bits; null is 0, what lies outside is moved to the nearest."""
    return F.least(F.greatest(F.coalesce(F.col(c).cast("long"), F.lit(0)), F.lit(0)), F.lit(0x7FFFFFFF))


def of_node(values: dict[int, int | float], kind: str) -> Column:
    """A column with the value that a (bounded) dictionary has for the row's node, else null."""
    pairs = [x for n, v in values.items() for x in (F.lit(n), F.lit(v).cast(kind))]
    return F.try_element_at(F.create_map(*pairs), F.col("node").cast("int"))


def median_keys(nodes: DataFrame, size: str, wanted: dict[int, tuple[int, float]], spans: dict[int, tuple[int, int]]) -> dict[int, int]:
    """For each node the key along a dimension whose rows up to it hold nearest to the wanted bytes.

    wanted: node to (dimension, bytes). spans: the least and greatest key of the node along it. Radix selection:
    a round sums the bytes of each open node by the next STEP_BITS bits below those found so far, and goes on in
    the bin that holds the wanted byte until that bin is one row or one key. What a round shuffles is at most
    nodes x 2 ** STEP_BITS sums for each task, whatever the number of rows.
    """
    left = {n: (lo ^ hi).bit_length() for n, (lo, hi) in spans.items()}
    prefix = {n: hi >> left[n] for n, (_, hi) in spans.items()}
    below = dict.fromkeys(wanted, 0)
    done: dict[int, int] = {}
    while still := [n for n in wanted if n not in done]:
        step = {n: min(STEP_BITS, left[n]) for n in still}
        pick = lambda d, kind="long": of_node({n: d[n] for n in still}, kind)  # noqa: B023, E731
        key = F.get(F.col("keys"), pick({n: wanted[n][0] for n in still}, "int"))
        rest = pick({n: left[n] - step[n] for n in still}, "int")
        bins = (
            nodes.where(F.col("node").isin(still))
            .select("node", F.col(size).alias("size"), key.alias("key"), rest.alias("rest"), pick(left, "int").alias("left"), pick(prefix).alias("prefix"))
            .where("shiftright(key, left) = prefix")
            .groupBy("node", F.expr("shiftright(key, rest)").alias("bin"))
            .agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        )
        upto = F.sum("size").over(Window.partitionBy("node").orderBy("bin"))
        want = pick({n: wanted[n][1] - below[n] for n in still}, "double")
        hits = bins.withColumn("upto", upto).where(F.col("upto") >= want).groupBy("node").agg(F.min(F.struct("bin", "upto", "size", "n")).alias("x"))
        for r in hits.select("node", "x.*").collect():
            n = r["node"]
            prefix[n], left[n] = r["bin"], left[n] - step[n]
            below[n] += r["upto"] - r["size"]
            if r["n"] == 1 or left[n] == 0:
                over, under = below[n] + r["size"] - wanted[n][1], wanted[n][1] - below[n]
                done[n] = ((r["bin"] + (over <= under)) << left[n]) - 1
    return done


def keyed_rows(rows: DataFrame, dims: list[Column], size: str) -> DataFrame:
    """(row, size, tie, keys): a row's own columns are kept together, so that none can clash with those of the tree."""
    copies = (1 << COPY_BITS) - 1
    of_row = F.xxhash64(*rows.columns).bitwiseAND(F.lit((1 << TIE_BITS) - 1 - copies))
    tie = of_row.bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(copies)))
    keyed = rows.select(F.struct(*rows.columns).alias("row"), F.col(size).cast("long").alias("size"), tie.alias("tie"), F.array(*[d.cast("long") for d in dims]).alias("keys"))
    return keyed.withColumn("keys", F.transform("keys", lambda d: F.shiftleft(d, TIE_BITS).bitwiseOR(F.col("tie"))))


def kd_tree_shards(rows: DataFrame, dims: list[Column], size: str, shards: int | None = None, target_bytes: int | None = None) -> tuple[DataFrame, list[Split]]:
    """rows with `shard` (0 to shards - 1) and `slot` (0, 1, ... within the shard) added, and the tree's splits.

    dims: integer columns of 31 bits (see `categorical`, `numeric`). size: a column of positive bytes. Give the
    number of shards, or target_bytes and as many are made as leaves reach it. A node for k leaves is split
    k/2 : k - k/2 by bytes, at the weighted median along the dimension that is widest in it against its width in
    the whole table; ties along it are broken by a hash of the row, so one hot value can be split anywhere.
    Rows that are equal in all columns fall into 2 ** COPY_BITS groups that can be split. No rows give no splits. Slots
    follow a hash order. The driver sees a few numbers for each node only.
    """
    keyed, size = written(keyed_rows(rows.drop("shard", "slot"), dims, size), "kd-rows"), "size"
    ends = [x for i in range(len(dims)) for x in (F.min(F.get("keys", F.lit(i))).alias(f"lo{i}"), F.max(F.get("keys", F.lit(i))).alias(f"hi{i}"))]
    whole = keyed.agg(F.sum(size).alias("size"), *ends).first()
    if shards is None:
        shards = max(1, round((whole["size"] or 0) / target_bytes))
    width = lambda r, i: (r[f"hi{i}"] >> TIE_BITS) - (r[f"lo{i}"] >> TIE_BITS)
    leaves, splits = {1: (0, shards)}, []
    nodes = assigned(keyed, splits)
    while whole["size"] is not None and any(k > 1 for _, k in leaves.values()):
        stats = {r["node"]: r for r in nodes.groupBy("node").agg(F.sum(size).alias("size"), *ends).collect()}
        wanted, spans, after = {}, {}, {}
        for n, (first, k) in leaves.items():
            if k == 1 or n not in stats:
                after[n] = (first, k) if k == 1 else (first, 1)
                continue
            dim = max(range(len(dims)), key=lambda i: (width(stats[n], i) / max(1, width(whole, i)), -i))
            wanted[n] = (dim, stats[n]["size"] * (k // 2) / k)
            spans[n] = (stats[n][f"lo{dim}"], stats[n][f"hi{dim}"])
            after[2 * n], after[2 * n + 1] = (first, k // 2), (first + k // 2, k - k // 2)
        if not wanted:
            break
        keys = median_keys(nodes, size, wanted, spans)
        splits += [Split(n, wanted[n][0], keys[n]) for n in wanted]
        leaves = after
        nodes = assigned(keyed, splits)
    placed = nodes.withColumn("shard", of_node({n: first for n, (first, _) in leaves.items()}, "int")).withColumn("part", F.pmod(F.col("tie"), F.lit(SLOT_PARTS)))
    parts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = parts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    here = F.row_number().over(Window.partitionBy("shard", "part").orderBy("tie", "row")) - 1
    out = placed.withColumn("here", here).join(small(written(before, "slots"), SLOT_PARTS * 4096), ["shard", "part"])
    return out.withColumn("slot", (F.col("before") + F.col("here")).cast("long")).select("row.*", "shard", "slot"), splits


def assigned(keyed: DataFrame, splits: list[Split]) -> DataFrame:
    """keyed with the leaf that each row falls to, as `node`; there are at most as many splits as shards."""
    if not splits:
        return keyed.withColumn("node", F.lit(1).cast("long"))
    look = lambda name, at: F.try_element_at(F.create_map(*[F.lit(x) for s in splits for x in (s.node, getattr(s, name))]), at.cast("int"))
    step = lambda at, _: F.coalesce(at * 2 + (F.get("keys", look("dim", at)) > look("key", at)).cast("long"), at)
    depth = max(s.node for s in splits).bit_length()
    return keyed.withColumn("node", F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(1).cast("long"), step))


def write_shards(placed: DataFrame, docs: DataFrame, key: str, path: str) -> None:
    """Write docs to `path`/shard=N. placed has key, shard and slot; a shard is sized to be one task's file."""
    docs.drop("shard", "slot").join(placed.select(key, "shard", "slot"), key).repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
