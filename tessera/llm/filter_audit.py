"""Filter interaction audit: what each filter removes in every order in which filters can be applied."""

from __future__ import annotations

from itertools import permutations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, small

#: Digests of repeated texts are broadcast up to this count, else joined by a shuffle without the commonest ones.
BROADCAST_DIGESTS = 200_000
#: Of n rows, keys with more than n / HOT_SHARE are joined by a broadcast: fewer than HOT_SHARE keys can be so common.
HOT_SHARE = 1000
#: What [^\x20\x09-\x0D]+ leaves out.
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_in(text: Column) -> Column:
    """The maximal runs of [^\\x20\\x09-\\x0D], as an array."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def text_filters(text: Column, fewest: int = 100, distinct_pct: int = 80, upper_pct: int = 10, marks: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions of texts: A short, B repetitive, C upper case, D marks; none looks at other rows."""
    words = words_in(text)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < fewest,
        "B": 100 * F.size(F.array_distinct(words)) < distinct_pct * F.size(words),
        "C": 100 * upper > upper_pct * F.length(text),
        "D": F.length(text) != F.length(F.translate(text, marks, "")),
    }


def repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", digest: str = "digest") -> DataFrame:
    """docs with `repeat`: whether a row with a smaller id has the same digest. Null ids neither are nor make repeats.

    Least ids are taken before the shuffle, so a digest that many rows share is a row for each task; of the digests
    that several ids have, those of a large part of all rows (a bounded number) are met by a broadcast.
    """
    first = docs.groupBy(digest).agg(F.min(id_col).alias("first"), F.max(id_col).alias("last"), F.count("*").alias("n"))
    first = scratch.table(first.where("first < last").drop("last"), "repeated")
    most = (first.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE + 1
    hot = F.broadcast(first.where(F.col("n") > most).select(digest, F.col("first").alias("hot_first")))
    rest = small(first.where(F.col("n") <= most).select(F.col(digest).alias("rest_digest"), F.col("first").alias("rest_first")), BROADCAST_DIGESTS)
    met = docs.join(hot, digest, "left")
    # Rows that are settled spread by their id: no digest is as short.
    key = F.when(F.col("hot_first").isNull(), F.col(digest)).otherwise(F.col(id_col).cast("string").cast("binary"))
    met = met.join(rest, key == F.col("rest_digest"), "left")
    return met.withColumn("repeat", F.coalesce(F.col(id_col) > F.coalesce("hot_first", "rest_first"), F.lit(False))).drop("hot_first", "rest_first", "rest_digest")


class Trie:
    """The trie of all orders of some filters, walked depth first over the rows that are left.

    A node is the set of filters applied so far, whatever their order: 2 ** n states instead of n! orders. Each
    state's survivors are its parent's less the rows that the filter fails; they are persisted while the walk is
    below the node. At each edge the rows that the next filter really removes are counted, by part.
    """

    def __init__(self, flags: DataFrame, filters: list[str], harms: list[str], scratch: Scratch):
        self.filters, self.harms, self.scratch = filters, harms, scratch
        self.counted: dict[str, DataFrame] = {}
        self.walk("", flags)

    def walk(self, state: str, survivors: DataFrame) -> None:
        survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        left = [f for f in self.filters if f not in state]
        edges = [F.struct(F.lit(f).alias("filter"), F.count_if(f).alias("removed"), *[F.count_if(F.col(f) & F.col(h)).alias(f"{h}_lost") for h in self.harms]) for f in left]
        counts = survivors.groupBy("part").agg(F.count("*").alias("rows"), F.array(*edges).alias("edges"))
        self.counted[state] = self.scratch.table(counts.withColumn("state", F.lit(state)), f"state-{state}")
        for f in left:
            below = "".join(sorted(state + f))
            if below not in self.counted and len(below) < len(self.filters):
                self.walk(below, survivors.where(~F.col(f)))
        survivors.unpersist()

    def edges(self) -> DataFrame:
        """(part, state, rows, filter, removed, ..._lost): rows that a state leaves, and what each further filter removes of them."""
        out = None
        for df in self.counted.values():
            out = df if out is None else out.unionByName(df)
        return out.select("part", "state", "rows", F.inline("edges"))


def audit(flags: DataFrame, filters: list[str], harms: list[str] = ()) -> DataFrame:
    """What each filter does at each step of every order of the filters, for each part.

    flags: `part`, a boolean column for each filter (one letter; true: the row fails it) and for each of `harms`.
    A null part is the empty string; a null flag or harm counts as false. Returns a row, zeros included, for each part,
    filter_order and step (from 1): kept (rows left after the step), removed (by it), redundant (failing its filter
    but removed earlier), unique_fails (failing its filter and no other), a column ..._lost for each harm (rows
    removed here that have it), shapley (removed by its filter, summed over all orders). Other columns are left out,
    so clashing names do no harm; no rows give no parts. Counts come from the survivors at each edge of the trie.
    """
    spark, scratch = flags.sparkSession, Scratch(flags.sparkSession, "filter-audit")
    clean = flags.select(F.coalesce("part", F.lit("")).alias("part"), *[F.coalesce(F.col(f"`{c}`"), F.lit(False)).alias(c) for c in (*filters, *harms)])
    clean = scratch.table(clean, "flags")
    trie = Trie(clean, list(filters), list(harms), scratch)
    edges = scratch.table(trie.edges(), "edges")
    fails = sum((F.col(f).cast("int") for f in filters), F.lit(0))
    alone = F.array(*[F.struct(F.lit(f).alias("filter"), F.count_if(F.col(f) & (fails == 1)).alias("unique_fails"), F.count_if(f).alias("fails")) for f in filters])
    totals = clean.groupBy("part").agg(alone.alias("a")).select("part", F.inline("a"))
    steps = [("".join(o), i + 1, "".join(sorted(o[:i])), o[i]) for o in permutations(filters) for i in range(len(filters))]
    steps = spark.createDataFrame(steps, "filter_order string, step int, state string, filter string")
    found = totals.join(F.broadcast(steps), "filter").join(edges, ["part", "state", "filter"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    counts = {"kept": zero(F.col("rows") - F.col("removed")), "removed": zero(F.col("removed")), "redundant": F.col("fails") - zero(F.col("removed")), "unique_fails": F.col("unique_fails")}
    losses = [zero(F.col(f"{h}_lost")).alias(f"{h}_lost") for h in harms]
    found = found.select("part", "filter_order", "step", "filter", *[c.alias(n) for n, c in counts.items()], *losses)
    value = found.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return found.join(value, ["part", "filter"]).drop("filter")


def audit_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit` of docs (doc_id, text, lang) by `text_filters` and E, equal to the text of a smaller doc_id.

    Null texts are empty. harms: good and toxic, where a label of the doc_id says quality or toxic 1. Rows that share
    an id are rows of their own, with the same labels; two rows equal in id and text aren't repeats of each other.
    """
    scratch = Scratch(docs.sparkSession, "filter-flags")
    text = F.coalesce("text", F.lit(""))
    judged = docs.select("doc_id", F.col("lang").alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), *[c.alias(k) for k, c in text_filters(text).items()])
    judged = scratch.table(judged, "judged")
    marked = repeats(judged, scratch).withColumnRenamed("repeat", "E").drop("digest")
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return audit(marked.join(known, "doc_id", "left"), ["A", "B", "C", "D", "E"], ["good", "toxic"])
