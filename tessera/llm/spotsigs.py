"""SpotSigs fingerprints: chains of content words after common-word anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import bounds_for, range_of
from .runtime import small, written
from .words import NOT_WORD, Words, mix, slices, words_of

#: The common words that anchor signatures, by language.
ANCHORS = {
    "en": "the of and to in a is that for it was on are as with be at this have from or by an not but".split(),
    "de": "der die und das in den von zu mit ist im des auf eine ein dem nicht es sich als auch an war".split(),
    "fr": "le la les de des et un une dans en que est pour qui au du par sur pas plus ne se".split(),
    "es": "el la los las de en y que un una por con para del es no se lo al su como".split(),
}
#: Content words in a chain.
CHAIN = 2
#: Signatures are 48 bits, 12 hex digits of the fingerprint.
SIGNATURE_BITS = 48


def anchor_hashes() -> np.ndarray:
    words = sorted({w for ws in ANCHORS.values() for w in ws})
    data = "".join(f"{w} " for w in words).encode()
    with np.errstate(over="ignore"):
        return np.sort(words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]), NOT_WORD).hashes)


def chains(words: Words, anchors: np.ndarray) -> list[np.ndarray]:
    """Each text's sorted distinct signatures: of CHAIN content words after an anchor.

    A text without any takes every word as an anchor and as content; where that gives none either (fewer than
    CHAIN + 1 words), its words as a whole are one signature, and a text without words gives none.
    """
    at = np.minimum(np.searchsorted(anchors, words.hashes), len(anchors) - 1)
    is_anchor = anchors[at] == words.hashes
    content = np.flatnonzero(~is_anchor)
    rank = np.concatenate([[0], np.cumsum(~is_anchor)])
    spots = np.flatnonzero(is_anchor)
    first = rank[spots]  # the place in `content` of the next content word
    owner_end = words.starts[np.searchsorted(words.starts, spots, "right")] if len(spots) else spots
    keep = first + CHAIN <= len(content)
    keep[keep] = content[first[keep] + CHAIN - 1] < owner_end[keep]
    spots, first = spots[keep], first[keep]
    sig = words.hashes[spots]
    for i in range(CHAIN):
        sig = mix(sig * np.uint64(0x9E3779B97F4A7C15) + words.hashes[content[first + i]])
    sig >>= np.uint64(64 - SIGNATURE_BITS)
    cuts = np.searchsorted(spots, words.starts)
    out = []
    for i in range(len(words.starts) - 1):
        found = np.unique(sig[cuts[i] : cuts[i + 1]])
        own = words.hashes[words.starts[i] : words.starts[i + 1]]
        if not len(found) and len(own):
            run = own if len(own) <= CHAIN else None
            step = np.zeros(1 if run is not None else len(own) - CHAIN, np.uint64)
            for j in range(len(own) if run is not None else CHAIN + 1):
                step = mix(step * np.uint64(0x9E3779B97F4A7C15) + (own[j] if run is not None else own[j : len(own) - CHAIN + j]))
            found = np.unique(step >> np.uint64(64 - SIGNATURE_BITS))
        out.append(found)
    return out


def fingerprints(texts: pa.Array) -> list[np.ndarray]:
    """The signature sets of texts. A text without words has one signature, of its bytes; the empty text has none."""
    anchors, out = anchor_hashes(), []
    with np.errstate(over="ignore"):
        for _, _, data, offsets in slices(texts):
            found = chains(words_of(data, offsets, NOT_WORD), anchors)
            for i, f in enumerate(found):
                raw = data[offsets[i] : offsets[i + 1]]
                if not len(f) and len(raw):
                    f = np.frombuffer(hashlib.sha256(raw.tobytes()).digest()[:8], np.uint64) >> np.uint64(64 - SIGNATURE_BITS)
                out.append(f)
    return out


def written_out(signatures: np.ndarray) -> str:
    """The set as text: 12 hex digits for each signature, in order."""
    return signatures.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity of two signature sets; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """text with its last n // 2 code points replaced by the first n // 2 (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_likeness(docs: DataFrame) -> DataFrame:
    """For each row of docs (doc_id, text) its fingerprint beside those of its edited text and of the next document.

    The next document has the next lower id, after the lowest comes the highest; rows that share an id are in the
    order of their texts. Null is the empty text. Rows are dealt into ranges of ids of bounded size; each range is
    sorted and read as a stream, and begins with a copy of the rows that follow the range above, so that no task
    needs another's rows. A single row is its own next. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    light = docs.select("doc_id", F.octet_length("text").cast("long").alias("size"))
    bounds = bounds_for(light, "doc_id", "size")
    which = range_of(F.col("doc_id"), bounds)
    # The first (highest) id of each range is the next of the range above: rows at most as many as ranges.
    heads = light.groupBy(which.alias("range")).agg(F.max("doc_id").alias("head")).orderBy("range").collect()
    above = {h["range"]: heads[(i + 1) % len(heads)]["range"] for i, h in enumerate(heads)}
    to = F.lit(None).cast("int")
    for part in range(0, len(heads), 500):
        pairs = [F.lit(x) for h in heads[part : part + 500] for x in (h["range"], above[h["range"]])]
        to = F.coalesce(to, F.try_element_at(F.create_map(*pairs), F.col("own"))) if pairs else to
    # Null ids have range 0 and come last of all; if they are alone in it, they are its head.
    tops = small(written(docs.sparkSession.createDataFrame([(h["range"], h["head"]) for h in heads], f"own int, head {docs.schema['doc_id'].dataType.simpleString()}"), "heads"), 10_000)
    placed = docs.withColumn("own", which).join(tops, "own").withColumn("is_head", F.col("doc_id").eqNullSafe(F.col("head")))
    spread = F.when(F.col("is_head"), F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("copy")), F.struct(to.alias("range"), F.lit(True).alias("copy"))))
    spread = spread.otherwise(F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("copy"))))
    dealt = placed.select("doc_id", "text", F.explode(spread).alias("x")).select("doc_id", "text", "x.range", "x.copy")
    ordered = dealt.repartition("range").sortWithinPartitions("range", "copy", F.col("doc_id").desc_nulls_last(), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        held = None  # the row whose next isn't known yet: id, text, range
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

        def out(pairs):
            changed = [edited(t, n) for _, t, n in pairs]
            place = {t: i for i, t in enumerate(dict.fromkeys([*(x for _, t, n in pairs for x in (t, n)), *changed]))}
            prints = fingerprints(pa.array(list(place), pa.large_string()))
            own, following, other = ([prints[place[t]] for t in ts] for ts in ([t for _, t, _ in pairs], [n for _, _, n in pairs], changed))
            columns = [
                [d for d, _, _ in pairs],
                [len(t) for _, t, _ in pairs],
                [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                [written_out(f) for f in own],
                [written_out(f) for f in other],
                [likeness(a, b) for a, b in zip(own, other, strict=True)],
                [likeness(a, b) for a, b in zip(own, following, strict=True)],
            ]
            types = [ids.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            ids = batch.column(0)
            pairs, size = [], 0
            for i in range(batch.num_rows):
                doc_id, text, of, copy = (batch.column(c)[i].as_py() for c in range(4))
                if held is not None and held[2] == of:
                    pairs.append((held[0], held[1], text))
                    size += len(held[1])
                held = None if copy else (doc_id, text, of)
                if size > 1 << 20:
                    yield out(pairs)
                    pairs, size = [], 0
            if pairs:
                yield out(pairs)

    return ordered.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def signature_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, signatures) for each row of docs."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = fingerprints(part.column(1))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32))
                flat = pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(f) for f in found], pa.int32()), pa.ListArray.from_arrays(offsets, flat)], names=["id", "n", "signatures"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n int, signatures array<long>")


def spot_pairs(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, similarity) of all pairs of different signature sets with a Jaccard similarity of threshold or more.

    a and b are the least ids of their sets; texts without signatures have no pairs. Sets are partitioned by
    length so that a pair's are in the same partition or neighbours. A set is indexed under the first of its
    signatures, in the order of how rarely they occur, that a partner can't all lack; pairs whose lengths
    differ too much are pruned before their sets are compared.
    """
    sets = written(signature_sets(docs, id_col, text_col).where("n > 0"), "signatures")
    one = written(sets.groupBy("signatures", "n").agg(F.min("id").alias("id")), "signature-sets")
    seen = one.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count("*").alias("df"))
    ranked = one.select("id", "n", F.explode("signatures").alias("s")).join(seen, "s").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("r"))
    head = ranked.select("id", "n", F.floor(F.log("n") / F.log(F.lit(1 / threshold)) + F.lit(1e-9)).alias("band"), F.explode(F.slice(F.col("r"), F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold - F.lit(1e-9)) + 1).cast("int"))).alias("x"))
    head = written(head.select("id", "n", "band", "x.s"), "signature-index")
    left = head.select(F.col("id").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    right = head.select(F.col("id").alias("b"), F.col("n").alias("nb"), "s", "band")
    pairs = left.join(right, ["s", "band"]).where("a <> b and (na < nb or (na = nb and a < b))").where(F.col("na") >= F.col("nb") * threshold - 1e-9).select("a", "b").distinct()
    texts = lambda c: one.select(F.col("id").alias(c), F.col("signatures").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    likened = pairs.join(texts("a"), "a").join(texts("b"), "b").withColumn("similarity", both / (F.size("sa") + F.size("sb") - both))
    return likened.where(F.col("similarity") >= threshold).select("a", "b", "similarity")
