"""Line dedup by a deletion-neighbourhood join, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, small

#: Shorter lines match only lines equal to them.
MIN_CHARS = 10
#: Keys of 8 or 16 bytes are broadcast up to this count, else joined by a shuffle.
BROADCAST_KEYS = 500_000
#: Lines are cut into 2 segments, longer ones into sqrt(length) / SEGMENT_ROOT, those over LONG_LINE into sqrt(length) / LONG_ROOT: each
#: segment costs a line's length to hash, and its own length squared to make variants, if another line shares it.
SEGMENT_ROOT, LONG_LINE, LONG_ROOT = 16, 1 << 14, 4


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def second_key(line: Column) -> Column:
    """With k1, 128 bits that stand for a line."""
    return F.xxhash64(F.lit(1), line)


def lines_of(docs: DataFrame) -> DataFrame:
    """(id, h, line_no, key, k1): the lines of docs (id, h, text) that aren't blank."""
    lines = docs.select("id", "h", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("id", "h", "line_no", line_key(F.col("line")).alias("key")).where("key <> ''").withColumn("k1", F.xxhash64("key"))


def segments(lines: DataFrame, *keep: str) -> DataFrame:
    """Rows (keep, seg, long, middle) for all the ways in which one edit may fall into a segment of a line.

    For a pair whose shorter line has c characters, the line is cut at floor(j c / m), j = 0 to m. An edit leaves
    what stands before and after one of the segments unchanged, so a pair within one edit shares the hash `seg`
    of c, j, and those two parts, for some j. A line is the shorter (or equal) of a pair with c its length, the
    longer with c its length less one.
    """
    c = F.explode(F.array(F.length("key"), F.length("key") - 1)).alias("c")
    cut = lines.where(F.length("key") >= MIN_CHARS).select(*keep, "key", c)
    cut = cut.where(F.col("c") >= MIN_CHARS).withColumn("m", F.greatest(F.lit(2), F.floor(F.sqrt("c") * F.when(F.col("c") > LONG_LINE, 1 / LONG_ROOT).otherwise(1 / SEGMENT_ROOT))).cast("int"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"))
    cut = cut.withColumns({"a": F.floor(F.col("j") * F.col("c") / F.col("m")).cast("int"), "z": (F.col("c") - F.floor((F.col("j") + 1) * F.col("c") / F.col("m"))).cast("int")})
    before, after = F.expr("left(key, a)"), F.expr("right(key, z)")
    return cut.select(
        *keep,
        F.xxhash64("c", "j", before, after).alias("seg"),
        (F.length("key") > F.col("c")).alias("long"),
        F.expr("substring(key, a + 1, length(key) - a - z)").alias("middle"),
    )


def variants(cut: DataFrame, *keep: str) -> DataFrame:
    """Rows (keep, v1, v2, role): all variants of a segment within one deletion, as hashed keys.

    Role 0: one of equally long lines that differ at one place at most; the place is part of the key. Role 1: the
    shorter line as it is; role 2: the longer line less one character.
    """
    place = F.sequence(F.lit(1), F.length("middle"))
    shorter = cut.where("not long and middle <> ''").select(*keep, "seg", "middle", F.explode(place).alias("p"))
    longer = cut.where("long and middle <> ''").select(*keep, "seg", "middle", F.explode(place).alias("p"))
    without = F.expr("concat(left(middle, p - 1), substring(middle, p + 1))")

    def hashed(df: DataFrame, role: int, place: Column, text: Column) -> DataFrame:
        kind = F.lit(0 if role == 0 else 1)
        return df.select(*keep, F.xxhash64("seg", kind, place, text).alias("v1"), F.xxhash64(text, place, kind, "seg").alias("v2"), F.lit(role).alias("role"))

    return (
        hashed(shorter, 0, F.col("p"), without)
        .unionByName(hashed(cut.where("not long"), 1, F.lit(0), F.col("middle")))
        .unionByName(hashed(longer, 2, F.lit(0), without))
    )


def near_lines(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """(k1, k2), two hashes of the distinct lines with an earlier line at one edit.

    Only lines that share a segment key with another enter the neighbourhood: this loses none, and leaves out
    the many lines that nothing resembles. Lines that share a variant are all within one edit of each other
    (role 0), or of the one shorter line (1 and 2), so a group needs its earliest line and not its pairs. Rows of
    variants hold hashes and the line's place; a line's text is met again for links alone, to verify them.
    """
    ends = segments(lines, "k1").groupBy("seg").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"))
    shared = scratch.table(ends.where("lo <> hi").select("seg"), "shared-segments")
    hits = segments(lines, "k1").join(small(shared, BROADCAST_KEYS), "seg", "left_semi").select("k1").distinct()
    hits = small(scratch.table(hits, "line-hits"), BROADCAST_KEYS)
    candidates = lines.join(hits, "k1", "left_semi").groupBy("k1", "key").agg(F.min(F.struct("id", "h", "line_no")).alias("ord"))
    candidates = scratch.table(candidates.withColumn("k2", second_key(F.col("key"))), "line-candidates")
    cut = segments(candidates, "k1", "k2", "ord").join(small(shared, BROADCAST_KEYS), "seg", "left_semi")
    twice = variants(cut.select("seg", "long", "middle")).groupBy("v1", "v2").agg(F.count("*").alias("n")).where("n > 1").select("v1", "v2")
    twice = small(scratch.table(twice, "shared-variants"), BROADCAST_KEYS)
    found = scratch.table(variants(cut, "k1", "k2", "ord").join(twice, ["v1", "v2"], "left_semi"), "variant-rows")
    earliest = lambda role: F.min(F.when(F.col("role") == role, F.struct("ord", "k1", "k2")))
    first = found.groupBy("v1", "v2").agg(*[earliest(r).alias(f"first{r}") for r in range(3)])
    partner = F.when(F.col("role") == 0, F.col("first0")).when(F.col("role") == 1, F.col("first2")).otherwise(F.col("first1"))
    links = found.join(first, ["v1", "v2"]).withColumn("partner", partner).where(F.col("partner.ord") < F.col("ord"))
    links = scratch.table(links.select("k1", "k2", F.col("partner.k1").alias("p1"), F.col("partner.k2").alias("p2")).distinct(), "line-links")
    texts = candidates.select("k1", "k2", "key")
    pairs = links.join(texts, ["k1", "k2"]).join(texts.toDF("p1", "p2", "earlier"), ["p1", "p2"])
    near = scratch.table(pairs.where(F.levenshtein("key", "earlier", 1) >= 0).select("k1", "k2").distinct(), "near-lines")
    scratch.drop("shared-segments", "line-hits", "line-candidates", "shared-variants", "variant-rows", "line-links")
    return near


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = False) -> DataFrame:
    """docs with each line of the text removed that equals, or is within one edit of, a line that comes earlier.

    Lines end at a line feed and are compared without blanks, tabs and carriage returns at their ends. One edit
    is a character inserted, deleted or replaced; lines under MIN_CHARS characters match only equal ones. Earlier
    is by id, then (ids that repeat) by a hash of the text, then by place; rows equal in id and text share one
    place and outcome. Whether the earlier line is itself removed doesn't matter. Blank lines stay, a null text
    stays null. Adds n_lines and n_kept (lines that aren't blank, before and after; 0 for null), replacing columns
    of these names. drop_emptied removes the documents that had such lines and keep none. Works on whole texts;
    what is shuffled for each line is hashes, and texts only of lines that nearly match and of documents once.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col]
    base = row.select("row", F.col("row")[id_col].alias("id"), F.xxhash64(text).alias("h"))
    lines = lines_of(base.select("id", "h", text.alias("text")))
    near = near_lines(lines, Scratch(docs.sparkSession, "line-dedup"))
    first = (
        lines.groupBy("k1", second_key(F.col("key")).alias("k2"))
        .agg(F.min(F.struct("id", "h", "line_no")).alias("ord"))
        .join(small(near, BROADCAST_KEYS), ["k1", "k2"], "left_anti")
    )
    kept = first.groupBy(F.col("ord.id").alias("kept_id"), F.col("ord.h").alias("kept_h")).agg(F.collect_list("ord.line_no").alias("kept"))
    joined = base.join(kept, (F.col("h") == F.col("kept_h")) & F.col("id").eqNullSafe(F.col("kept_id")), "left")
    lines_in = F.split(text, "\n")
    stays = lambda x, i: (line_key(x) == "") | F.coalesce(F.array_contains(F.col("kept"), i), F.lit(False))
    count = lambda x: F.size(F.filter(x, lambda y: line_key(y) != ""))
    columns = [F.array_join(F.filter(lines_in, stays), "\n").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_kept")]
    out = joined.select(*columns, F.coalesce(count(lines_in), F.lit(0)).alias("n_lines"), F.coalesce(F.size("kept"), F.lit(0)).alias("n_kept"))
    return out.where("n_lines = 0 or n_kept > 0") if drop_emptied else out
