"""The stages of the corpus pipeline, and all of it, against plain versions on small tables."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
from test_table_ops import plain_components, plain_dedup, plain_sets
from test_text_ops import brute_contamination

from tessera.llm import sentencepiece, toxicity
from tessera.llm.runtime import shared_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark):
    """(folder, rows, labels, items): near copies, toxic texts, repeated lines, benchmark items, nulls, repeated ids and rows."""
    rng = random.Random(21)
    plain, bad = [f"word{i}" for i in range(500)], ["vile", "scum", "rotten", "filth", "loathed"]
    prose = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    texts, labels = [], []
    for i in range(360):
        words = prose(rng.randrange(30, 70)).split(" ")
        for _ in range(rng.randrange(3, 8) if i % 4 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        labels.append((i, 1, int(i % 4 == 0)))
    items = [(k, prose(25)) for k in range(5)]
    texts += [f"{prose(30)} {items[k][1]} {prose(20)}" for k in range(3)]
    line = prose(12)
    texts += [f"{prose(20)}\\n{line}\\n{prose(15)}" for _ in range(4)] + [line, line + "s"]
    base = prose(80)
    texts += [base, base + " more", base.replace(" ", "  "), " ".join(base.split(" ")[:78]), "", None, "   ", "ab", "ab"]
    rows = [(i, t, "en", "web", None if t is None else len(t)) for i, t in enumerate(texts)]
    again = next(r for r in rows if r[1] == base)
    rows += [again, again, (again[0], prose(60), "en", "web", 1), (None, prose(50), None, None, None), (None, prose(50), None, None, None)]
    folder = shared_path(spark, "corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, items


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def ran(spark, corpus, name, rows):
    out = stage(name)(spark, spark.createDataFrame(rows, SCHEMA), corpus[0])
    return out.columns, sorted(map(tuple, out.collect()), key=repr)


def plain_toxic(spark, corpus, rows):
    """Rows whose probability, from the model's weights summed word by word, stays under the limit."""
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{corpus[0]}/labels.parquet"))
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    out = []
    for r in rows:
        (features,) = toxicity.feature_rows(toxicity.pa.array([r[1] or ""]))
        score = sum(weight.get(f, 0.0) for f in features.tolist())
        if 1 / (1 + np.exp(-(score - model.thresholds[0]))) < toxicity.REJECT:
            out.append(r)
    return out


def plain_lines(rows):
    """Without the lines that came before: texts in the order of id (those that share one aren't here with lines in common)."""
    text = {}
    for at, r in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))):
        text[at] = r
    kept = plain_dedup([(at, r[1]) for at, r in text.items()])
    return [(r[0], kept[at], r[2], r[3], r[4] if r[1] is None else len(kept[at])) for at, r in text.items() if not (r[1] or "").strip() or kept[at].strip()]


def plain_near(rows):
    numbered = dict(enumerate(sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, repr(r)))))
    sets = plain_sets([(i, r[1]) for i, r in numbered.items()], 5)
    group = plain_components(sets, 80)
    return [r for r in rows if not plain_sets([(0, r[1])], 5)[0]] + [r for i, r in numbered.items() if sets[i] and group[i] == i]


def plain_clean(rows, items):
    found = {i for i, _ in brute_contamination([(i, r[1]) for i, r in enumerate(rows)], items)}
    return [r for i, r in enumerate(rows) if i not in found]


def once(rows):
    return sorted(rows, key=repr)


def test_each_stage_against_a_plain_version(spark, corpus):
    _, rows, labels, items = corpus
    columns, got = ran(spark, corpus, "toxicity", rows)
    assert columns == [c.split()[0] for c in SCHEMA.split(", ")] and got == once(plain_toxic(spark, corpus, rows))
    toxic = {i for i, _, t in labels if t}
    assert len({r[0] for r in got} & toxic) <= 2 and len({r[0] for r in got}) >= len({r[0] for r in rows} - toxic)
    distinct = list(dict.fromkeys(r for r in rows if r[0] is not None))
    assert ran(spark, corpus, "line dedup", distinct)[1] == once(plain_lines(distinct))
    columns, got = ran(spark, corpus, "n-gram Jaccard join", rows)
    ids = [r[0] for r in got]
    assert columns == [c.split()[0] for c in SCHEMA.split(", ")] and sorted(got, key=repr) == once(plain_near(rows))
    assert ids.count(None) == 2  # rows of one id are judged each by its own text
    assert ran(spark, corpus, "benchmark decontamination", rows)[1] == once(plain_clean(rows, items))


def test_rows_of_one_id_and_equal_rows(spark, corpus):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, near, None, None, 1), (2, near + " aa", None, None, 1), (2, "wholly other words than the first has in it", None, None, 1), (3, "x y z", None, None, 1), (3, "x y z", None, None, 1), (None, near, None, None, 1)]
    got = ran(spark, corpus, "n-gram Jaccard join", rows)[1]
    assert got == once([rows[2], rows[3], rows[5]])
    for name, _ in corpus_pipeline.STAGES:
        assert stage(name)(spark, spark.createDataFrame([], SCHEMA), corpus[0]).count() == 0


def test_the_whole_pipeline(spark, corpus):
    folder, rows, _, items = corpus
    left = plain_clean(plain_near(plain_lines(plain_toxic(spark, corpus, list(dict.fromkeys(rows))))), items)
    got = corpus_pipeline.run(spark, folder).collect()
    pieces = sentencepiece.load_file(P.path("piece_bpe_32k.model"), sentencepiece.UNIGRAM)
    want = sorted((r[0] is None, r[0] or 0, tuple(ids.tolist())) for r, ids in zip(left, sentencepiece.encode_batch([r[1] or "" for r in left], pieces), strict=True))
    assert sorted((r.doc_id is None, r.doc_id or 0, tuple(r.ids)) for r in got) == want and all(r.round_trip for r in got)
