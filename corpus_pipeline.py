"""A corpus pipeline of five stages over `documents`: toxicity, line dedup, n-gram Jaccard join, decontamination, SentencePiece."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, jaccard_join, line_dedup, sentencepiece, toxicity
from tessera.llm.runtime import small, table, written

#: All stages on word shingles take five words and a similarity of 0.8; this one's links do.
LIKENESS = jaccard_join.Likeness(words=5, percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model doesn't reject. It is fitted on labelled rows of documents itself."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that came before; those that keep no line of theirs go. n_chars follows the text."""
    out = line_dedup.dedup_lines(docs, drop_emptied=True)
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", n_chars).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows that links connect, the first by doc_id (null first), then by a hash of the row.

    Rows are told apart by their whole content, so that a copy takes no other row of its id with it; of rows that are
    equal in all columns one stays. Texts without words are in no group, and all stay.
    """
    row = docs.select(F.struct(*docs.columns).alias("row"))
    rows = row.select("row", F.struct("row.doc_id", F.xxhash64("row").alias("h")).alias("id"), "row.text")
    parts = jaccard_join.near_duplicates(rows.select("id", "text"), "id", like=LIKENESS)
    found = parts.where("n_shingles > 0").groupBy("id").agg(F.min("component_id").alias("first"), F.count("*").alias("rows"))
    found = found.select(F.col("id.doc_id").alias("of"), F.col("id.h").alias("h"), (F.col("id") != F.col("first")).alias("gone")).where("gone or rows > 1")
    found = small(written(found, "near-copies"), jaccard_join.BROADCAST_ROWS)
    judged = rows.join(found, (F.col("id.h") == F.col("h")) & F.col("id.doc_id").eqNullSafe(F.col("of")), "left")
    once = judged.where("not gone").dropDuplicates(["id"])
    return judged.where("gone is null").unionByName(once).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document that is left, by the Viterbi over the file's pieces and scores, decoded again (round_trip)."""
    return sentencepiece.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), kind=sentencepiece.UNIGRAM)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]
#: SQL can't express the model, the links of the join or the tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on what the one before wrote to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
