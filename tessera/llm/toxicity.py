"""Severity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import small, written
from .words import NOT_WORD, Words, mix, slices, words_of

#: Features are hashes of 40 bits.
FEATURES = 1 << 40
#: Beside each whole word, its first so many bytes are features: endings vary, stems less.
PREFIXES = (4, 5)
#: The model is fitted on at most so many labelled rows, those with the least hash of their id.
SAMPLE_ROWS = 5000
#: A label's word is a marker of the upper grades where it stands in this many texts, nearly all of them toxic.
MARKER_TEXTS, MARKER_SHARE = 4, 0.9
REJECT = 0.4
LEAST_Z = 7.0


def text_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature) of all distinct features of the texts of a slice, in order."""
    owner = np.repeat(np.arange(len(words.starts) - 1), np.diff(words.starts))
    kinds = [words.hashes, *(mix(words.prefix_hashes(n) + np.uint64(n)) for n in PREFIXES)]
    codes = np.concatenate([owner * FEATURES + (k % np.uint64(FEATURES)).astype(np.int64) for k in kinds])
    codes = np.unique(codes)
    return codes // FEATURES, codes % FEATURES


def feature_rows(texts: pa.Array) -> list[np.ndarray]:
    out = []
    with np.errstate(over="ignore"):
        for at, to, data, offsets in slices(texts):
            owner, feature = text_features(words_of(data, offsets, NOT_WORD))
            cuts = np.searchsorted(owner, np.arange(to - at + 1))
            out += [feature[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def found_in(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in `ordered` of the values that it has, and a mask of these."""
    if not len(ordered):
        return np.zeros(0, np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    mask = ordered[at] == values
    return at[mask], mask


def counts(rows: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of the rows in order, the rows that each stands in, and how many of them are toxic."""
    used, at, seen = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
    return used, seen, np.bincount(at, np.repeat(toxic > 0, [len(r) for r in rows]).astype(float), minlength=len(used))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(score - thresholds[k]); one weight for a feature serves all thresholds.

    A text's score is the sum of its distinct features' weights. Few features have one; they are in order.
    """

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade > k) for each row and k; a text without features has score 0."""
        score = np.array([self.weights[found_in(r, self.features)[0]].sum() for r in rows])
        return sigmoid(score[:, None] - self.thresholds[None, :])


def telling(rows: list[np.ndarray], grades: np.ndarray) -> np.ndarray:
    """The features, in order, that stand in upper-grade texts more often than chance by LEAST_Z deviations.

    Features of few texts could be learned by heart; these alone get weights.
    """
    base = (grades > 0).mean() if len(grades) else 0.0
    if not 0 < base < 1:
        return np.zeros(0, np.int64)
    used, seen, bad = counts(rows, grades)
    z = (bad - seen * base) / np.sqrt(seen * base * (1 - base))
    return used[(seen >= MARKER_TEXTS - 1) & (z >= LEAST_Z)]


def log_likelihood(score: np.ndarray, theta: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """log P(grade) of each row."""
    p = sigmoid(score[:, None] - theta)
    cell = np.hstack([np.ones((len(score), 1)), p]) - np.hstack([p, np.zeros((len(score), 1))])
    return np.log(np.maximum(cell[np.arange(len(score)), grades], 1e-9))


def slopes(score: np.ndarray, theta: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """d log P(grade) / d (score - theta_k) for each row and threshold k: + at the one below the grade, - above it."""
    p = sigmoid(score[:, None] - theta)
    of = np.exp(log_likelihood(score, theta, grades))
    i, low, high = np.arange(len(score)), grades > 0, grades < len(theta)
    out = np.zeros_like(p)
    slope = p * (1 - p)
    out[i[low], grades[low] - 1] += slope[i[low], grades[low] - 1] / of[low]
    out[i[high], grades[high]] -= slope[i[high], grades[high]] / of[high]
    return out


def row_weights(grades: np.ndarray) -> np.ndarray:
    """Toxic rows together weigh as much as the others."""
    low = grades > 0
    return np.where(low, 0.5 / max(1, low.sum()), 0.5 / max(1, (~low).sum()))


def fit(rows: list[np.ndarray], grades: np.ndarray, epochs: int = 600, rate: float = 0.5, decay: float = 1e-4) -> OrdinalModel:
    """The likelihood's maximum by full-batch Adagrad, less decay / 2 times the weights' squares; grades are 0 to K - 1,
    K at least 2. Deterministic."""
    levels = max(2, int(grades.max()) + 1 if len(grades) else 2)
    used = telling(rows, grades)
    rows = [found_in(r, used)[0] for r in rows]
    lengths = np.array([len(r) for r in rows], np.int64)
    theta = np.arange(levels - 1) + 2.0
    if not lengths.sum():
        return OrdinalModel(used, np.zeros(len(used)), theta)
    feature, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), lengths)
    v, v2, t2 = np.zeros(len(used)), np.full(len(used), 1e-8), np.full(levels - 1, 1e-8)
    weight = row_weights(grades)
    for _ in range(epochs):
        at = slopes(np.bincount(owner, v[feature], minlength=len(rows)), theta, grades) * weight[:, None]
        g = np.bincount(feature, at.sum(1)[owner], minlength=len(used)) - decay * v
        gt = -at.sum(0)
        v2 += g * g
        t2 += gt * gt
        v += rate * g / np.sqrt(v2)
        theta = np.sort(theta + rate * gt / np.sqrt(t2))
    return OrdinalModel(used, v, theta)


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """0 where a text isn't toxic; of toxic ones 2 for those with more markers than the median, else 1.

    Labels say toxic or not. Markers are features that stand in MARKER_TEXTS texts or more, MARKER_SHARE of them
    toxic; how many different ones a text has orders the toxic texts, as the model's score adds up what a text has. So
    a long text reaches grade 2 more easily. (By their share of a text's features, which length doesn't change, grades
    go against the score: on 20,598 labelled texts 92 per cent of the toxic ones were rejected, and 99 this way.)
    """
    grades = (toxic > 0).astype(int)
    used, seen, bad = counts(rows, grades)
    marker = used[(seen >= MARKER_TEXTS) & (bad >= MARKER_SHARE * seen)]
    number = np.array([found_in(r, marker)[1].sum() for r in rows])
    if grades.any():
        grades[(grades > 0) & (number > np.median(number[grades > 0]))] = 2
    return grades


def features_table(docs: DataFrame) -> DataFrame:
    """docs with the text column (last) replaced by `features`."""
    kept = docs.columns[:-1]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = feature_rows(part.column(len(kept)))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
                flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.ListArray.from_arrays(offsets, flat)], names=[*kept, "features"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(run, f"{head}, features array<long>")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on the labelled documents (doc_id, text; doc_id, toxic) with the sample_rows least hashes of their id.

    Rows with a null id, text or label are left out; of rows of docs that share an id one counts, that with the least
    hash of its text. Features are counted, and those that can matter (telling ones and markers) chosen, in Spark;
    the driver gets these alone. Without toxic rows, or any, the model gives every text the same small severity, and
    so it does where labels are so few (under about 50 toxic ones) that no word tells by LEAST_Z deviations: a word
    seen a few times in toxic texts alone is mostly chance, and would reject clean texts.
    """
    # Ids whose labels disagree count as toxic.
    picked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.where("text is not null").select("doc_id", "text").join(small(written(picked, "labels"), sample_rows), "doc_id")
    sample = sample.withColumn("h", F.xxhash64("text"))
    sample = sample.join(sample.groupBy("doc_id").agg(F.min("h").alias("h")), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    sample = sample.select(F.xxhash64("doc_id", "text").alias("row"), (F.col("toxic") > 0).cast("int").alias("toxic"), "text")
    sample = written(features_table(sample), "features")
    base = sample.agg(F.avg("toxic")).first()[0] or 0.0
    of = sample.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("seen"), F.sum("toxic").alias("bad"))
    z = F.try_divide(F.col("bad") - F.col("seen") * base, F.sqrt(F.col("seen") * (base * (1 - base))))
    telling_ones = (F.col("seen") >= MARKER_TEXTS - 1) & (z >= LEAST_Z)
    chosen = of.where(telling_ones | ((F.col("seen") >= MARKER_TEXTS) & (F.col("bad") >= MARKER_SHARE * F.col("seen")))).select("f")
    few = sample.select("row", F.explode("features").alias("f")).join(small(written(chosen, "telling"), 1_000_000), "f").groupBy("row").agg(F.sort_array(F.collect_set("f")).alias("features"))
    got = sample.select("row", "toxic").join(few, "row", "left").orderBy("row").collect()
    rows = [np.array(r["features"] or [], np.int64) for r in got]
    return fit(rows, severity_grades(rows, np.array([r["toxic"] for r in got], np.int64)))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """(id, expected_severity, p_toxic, grade, rejected) for each row of docs.

    expected_severity is the sum of P(grade > k); p_toxic is P(grade > 0), and rejected where it reaches
    `reject`; grade is the likeliest. Null and empty texts have no features. Whole texts count.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                above = sent.value.above(feature_rows(part.column(1)))
                cells = np.hstack([np.ones((len(above), 1)), above]) - np.hstack([above, np.zeros((len(above), 1))])
                columns = [pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(cells.argmax(1).astype(np.int32)), pa.array(above[:, 0] >= reject)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["id", "expected_severity", "p_toxic", "grade", "rejected"])

    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, expected_severity double, p_toxic double, grade int, rejected boolean")
    return out.withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of docs, all columns as they are, whose text isn't rejected (see `score`)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                yield part.filter(pa.array(sent.value.above(feature_rows(part.column(at)))[:, 0] < reject))

    return docs.mapInArrow(run, docs.schema)
