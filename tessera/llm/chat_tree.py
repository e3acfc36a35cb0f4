"""Chat formatting: conversations merged into prefix trees, each shared turn's tokens once, depth first."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import Scratch, looked_up
from .sentencepiece import batches_of
from .token_store import encoder

#: What stands before and after a turn's text, by role; for other roles, the role stands between the first two of OTHER.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[ROLE]", "[TEXT]", "[/TEXT]")
#: The role whose texts are learned.
LEARNED = "assistant"
#: A control string in a text gets one backslash more after its first character than it has there. Since no control
#: string has a first character at any other place, such strings don't overlap, and one backslash less gives the text.
CONTROLS = [*(m for pair in MARKS.values() for m in pair), *OTHER]
FIRST, REST = "".join(sorted({re.escape(c[0]) for c in CONTROLS})), "|".join(re.escape(c[1:]) for c in CONTROLS)
ESCAPE, UNESCAPE = re.compile(rf"([{FIRST}]\\*)(?={REST})"), re.compile(rf"([{FIRST}]\\*)\\(?={REST})")


def escaped(text: str) -> str:
    return ESCAPE.sub(r"\1\\", text)


def unescaped(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


def marks_of(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (OTHER[0] + escaped(role) + OTHER[1], OTHER[2])


def formatted(role: str, text: str) -> str:
    before, after = marks_of(role)
    return before + escaped(text) + after


def parsed(turn: str) -> tuple[str, str]:
    """The role and text of a formatted turn."""
    for role, (before, after) in MARKS.items():
        if turn.startswith(before):
            return role, unescaped(turn[len(before) : len(turn) - len(after)])
    role, text = turn[len(OTHER[0]) : len(turn) - len(OTHER[2])].split(OTHER[1], 1)
    return unescaped(role), unescaped(text)


def chained(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, node, parent, role, text): turns (conv_id, turn, role, text) in order, with what stands for each beginning.

    node is a digest of the turn and all before it, parent that of the turn before (empty for the first). Conversations
    are sorted within tasks and read as streams, so one of any length takes a row's memory.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches):
        import pyarrow as pa

        last, seq, node = object(), 0, b""
        for batch in batches:
            seqs, nodes, parents = [], [], []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != last:
                    last, seq, node = conv, 0, b""
                name = role.encode()
                parent, node = node, hashlib.blake2b(b"%b%d:%b%b" % (node, len(name), name, text.encode()), digest_size=16).digest()
                seqs.append(seq)
                nodes.append(node)
                parents.append(parent)
                seq += 1
            columns = [batch.column(0), pa.array(seqs, pa.int64()), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "seq", "node", "parent", "role", "text"])

    return ordered.mapInArrow(run, f"conv_id {kind}, seq long, node binary, parent binary, role string, text string")


@lru_cache(10_000)
def mark_ids(mark: str, path: str) -> np.ndarray:
    return encoder(path).encode(pa.array([mark]))[0].astype(np.int32)


def tokenised(nodes: DataFrame, tokenizer_path: str) -> DataFrame:
    """nodes with role and text (last) replaced by tokens, n_tokens and the part of them that is learned.

    Marks and text are encoded apart, so that each has its own tokens.
    """
    kept = nodes.columns[:-2]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            roles = batch.column(len(kept)).to_pylist()
            for at, texts in batches_of(batch.column(len(kept) + 1)):
                ids, starts = encoder(tokenizer_path).encode(pa.array([escaped(t) for t in texts], pa.large_string()))
                own = [[mark_ids(m, tokenizer_path) for m in marks_of(r)] for r in roles[at : at + len(texts)]]
                tokens = [np.concatenate([b, ids[starts[i] : starts[i + 1]].astype(np.int32), a]) for i, (b, a) in enumerate(own)]
                size = np.array([len(t) for t in tokens])
                begin = np.array([len(b) for b, _ in own])
                end = begin + np.diff(starts) * [r == LEARNED for r in roles[at : at + len(texts)]]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(np.concatenate(tokens)))
                columns = [lists, *(pa.array(x.astype(np.int64)) for x in (size, begin, end))]
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(texts)).columns[:-2], *columns], names=[*kept, "tokens", "n_tokens", "loss_begin", "loss_end"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields[:-2])
    return nodes.mapInArrow(run, f"{head}, tokens array<int>, n_tokens long, loss_begin long, loss_end long")


def sibling_shifts(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """nodes (node, parent, n, subtree) with `light` and `shift`, the tokens below the siblings that come before.

    The child that most rows go through comes first, the others (light) by digest. A parent may have any number of
    children: they are dealt into ranges, and sums of ranges are added up first.
    """
    heavy = nodes.groupBy("parent").agg(F.max_by("node", F.struct("n", "node")).alias("node")).select("node", F.lit(False).alias("light"))
    sides = nodes.join(heavy, "node", "left").withColumn("light", F.coalesce("light", F.lit(True)))
    ranged = scratch.table(sides.repartitionByRange("parent", "light", "node").withColumn("part", F.spark_partition_id()), "siblings")
    before = ranged.groupBy("part", "parent").agg(F.sum("subtree").alias("total"))
    before = before.withColumn("before", F.sum("total").over(Window.partitionBy("parent").orderBy("part")) - F.col("total")).drop("total")
    within = F.sum("subtree").over(Window.partitionBy("part", "parent").orderBy("light", "node")) - F.col("subtree")
    return ranged.withColumn("within", within).join(before, ["part", "parent"]).withColumn("shift", F.col("before") + F.col("within")).drop("part", "before", "within")


def write_chats(turns: DataFrame, path: str, tokenizer_path: str) -> None:
    """Write conversations, turns (conv_id, turn, role, text), as prefix trees of tokens to the folder `path`.

    A conversation's rows are in the order of turn, then role, then text (nulls first); rows with a null conv_id are one
    conversation; a null role or text is empty. `MARKS` and `escaped` say how a turn is formatted.

    `nodes`: a row for each distinct beginning of a conversation, its last turn's tokens, in depth-first order; trees
    are one after the other. begin and end are its place in the sequence of all tokens, tree that of its first turn,
    position_ids count the tokens from the conversation's beginning, attends lists the stretches of the sequence
    that are its earlier turns, loss_begin and loss_end (within its tokens) what is learned: the texts of LEARNED.
    The child that most conversations go through comes first, next to its parent: at each other one the number of
    conversations halves at least, so attends has as many stretches at most as that number has binary digits.
    `paths`: conv_id, seq and the begin of its node for each turn.

    A node's place is a sum along any conversation through it: tokens of the turns before, and all that stands below
    siblings before. What stands below a node is added up from the conversations, each counting the nodes
    that no conversation with a lower id has. So no tree, parent or shared turn needs to be in one task.
    """
    spark, scratch = turns.sparkSession, Scratch(turns.sparkSession, "chats")
    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = scratch.table(chained(clean), "turns", compression="zstd")
    whose = F.min(F.struct(F.col("conv_id").isNotNull().alias("known"), "conv_id")).alias("whose")
    nodes = rows.groupBy("node").agg(F.first("parent").alias("parent"), F.count("*").alias("n"), whose, F.first("role").alias("role"), F.first("text").alias("text"))
    nodes = scratch.table(tokenised(nodes, tokenizer_path), "nodes", compression="zstd")

    steps = rows.select("conv_id", "seq", "node")
    along = Window.partitionBy("conv_id").orderBy("seq")
    own = F.col("conv_id").eqNullSafe(F.col("whose.conv_id"))
    below = looked_up(steps, nodes.select("node", "n_tokens", "whose"), "node", scratch).withColumn("new", F.when(own, F.col("n_tokens")).otherwise(0))
    below = below.withColumn("below", F.sum("new").over(along.rowsBetween(0, Window.unboundedFollowing))).groupBy("node").agg(F.sum("below").alias("subtree"))
    places = sibling_shifts(nodes.select("node", "parent", "n", "n_tokens", "whose").join(below, "node"), scratch)
    places = scratch.table(places.select("node", "n_tokens", "whose", "light", "shift"), "shifts")

    above = F.coalesce(F.sum("n_tokens").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    placed = looked_up(steps, places, "node", scratch).withColumn("position", above).withColumn("begin", F.sum("shift").over(upto) + F.col("position"))
    placed = placed.withColumns({"end": F.col("begin") + F.col("n_tokens"), "tree": F.first("begin").over(upto)}).withColumn("parent_end", F.lag("end").over(along))
    gaps = F.collect_list(F.when(F.col("light") & (F.col("seq") > 0), F.struct(F.col("parent_end").alias("from"), F.col("begin").alias("to")))).over(upto)
    placed = placed.select("conv_id", "seq", "node", "tree", "begin", "end", "position", gaps.alias("gaps"), own.alias("own"))
    placed = scratch.table(placed, "placed")
    placed.select("conv_id", "seq", "begin").write.parquet(f"{path}/paths")
    starts, ends = F.concat(F.array("tree"), F.transform("gaps", lambda g: g["to"])), F.concat(F.transform("gaps", lambda g: g["from"]), F.array("begin"))
    attends = F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("begin"), e.alias("end"))), lambda x: x["begin"] < x["end"])
    position_ids = F.sequence(F.col("position").cast("int"), (F.col("position") + F.col("end") - F.col("begin") - 1).cast("int"))
    # A conversation's own nodes are new in it; of several rows of a node's conversation one has it.
    whole = placed.where("own").select("node", "tree", "begin", "end", position_ids.alias("position_ids"), attends.alias("attends")).join(nodes.select("node", "tokens", "loss_begin", "loss_end"), "node").drop("node")
    whole.repartitionByRange("begin").sortWithinPartitions("begin").write.option("compression", "zstd").parquet(f"{path}/nodes")
    scratch.drop("turns", "nodes", "siblings", "shifts", "placed")


def read_turns(spark: SparkSession, path: str, tokenizer_path: str) -> DataFrame:
    """(conv_id, seq, role, text, learned, formatted_chars, attends_all) for each turn, from the files of `write_chats`.

    Tokens are decoded once for each node, marks taken off and texts unescaped. learned is the text under the loss
    mask (null: nothing is); attends_all: the stretches that the node attends to are as long as what stands before
    it in the conversation, and its positions go on from there. A turn that many conversations share is copied to
    several tasks.
    """

    def decode(batches):
        import pyarrow as pa

        tokenizer = encoder(tokenizer_path).tokenizer
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                parts = []
                for ids, a, b in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    parts += [ids[:a], ids[a:b], ids[b:]]
                texts = tokenizer.decode_batch(parts, skip_special_tokens=False)
                turns = ["".join(texts[i : i + 3]) for i in range(0, len(texts), 3)]
                role, text = zip(*map(parsed, turns), strict=True)
                learned = [unescaped(texts[3 * i + 1]) if r == LEARNED else None for i, r in enumerate(role)]
                good = []
                for ids, stretches in zip(part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True):
                    first = sum(x["end"] - x["begin"] for x in stretches)
                    good.append(ids == list(range(first, first + len(ids))))
                columns = [pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(learned, pa.string()), pa.array([len(t) for t in turns], pa.int64()), pa.array(good, pa.bool_())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["begin", "role", "text", "learned", "formatted_chars", "attends_all"])

    nodes = spark.read.parquet(f"{path}/nodes").select("begin", "tokens", "loss_begin", "loss_end", "position_ids", "attends")
    turns = nodes.mapInArrow(decode, "begin long, role string, text string, learned string, formatted_chars long, attends_all boolean")
    return looked_up(spark.read.parquet(f"{path}/paths"), turns, "begin", Scratch(spark, "read-chats")).drop("begin")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, attends_all) of the rows of `read_turns`.

    Conversations are sorted within tasks and read as streams: a digest needs a conversation's turns one after the other, but never all at once.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "role", "text", "learned", "formatted_chars", "attends_all")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "attends_all"]

    def run(batches):
        import pyarrow as pa

        held = None  # conv_id, turns, digest, learned characters, their digest, formatted characters, whether all is well
        for batch in batches:
            out = []
            for conv, role, text, learned, chars, good in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held[0] != conv:
                    if held:
                        out.append(held)
                    held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                held[1] += 1
                held[2].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    held[3] += len(learned)
                    held[4].update(learned.encode())
                held[5] += chars
                held[6] &= good
            if out:
                yield finished(out, batch.column(0).type)
        if held:
            yield finished([held], batch.column(0).type)

    def finished(rows, id_type):
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        columns = zip(*([x.hexdigest() if hasattr(x, "hexdigest") else x for x in r] for r in rows), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, attends_all boolean")
