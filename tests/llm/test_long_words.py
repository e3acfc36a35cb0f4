"""Thue-Morse words: sums of values times powers are the same for one and its complement."""

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece as spm
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import decontaminate, jaccard_join, sentencepiece, spotsigs, token_store, toxicity
from tessera.llm.words import byte_hashes

MODEL = P.path("piece_bpe_32k.model")


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() & 1 else a for i in range(n))


SIZES = [16, 64, 1024, 2048, 4096, 8192]
PAIRS = [(thue_morse(n), thue_morse(n, "b", "a")) for n in SIZES]
TEXTS = [f"p q r s {t}" for pair in PAIRS for t in pair]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")


def test_hashes_of_ranges():
    data = np.frombuffer("".join(x for pair in PAIRS for x in pair).encode(), np.uint8)
    ends = np.cumsum([len(x) for pair in PAIRS for x in pair])
    begin = np.append(0, ends[:-1])
    with np.errstate(over="ignore"):
        found = [byte_hashes(data, begin, ends, seed) for seed in (0, 1, 2)]
        assert len(set(np.concatenate(found).tolist())) == 3 * len(ends)
        # The hash depends on the bytes of the range alone, whatever stands before or after, for all lengths.
        rng = np.random.default_rng(2)
        raw = rng.integers(0, 256, 400, dtype=np.uint8)
        for n in [*range(20), 63, 64, 65, 130]:
            other = np.concatenate([rng.integers(0, 256, 7, dtype=np.uint8), raw[9 : 9 + n], rng.integers(0, 256, 3, dtype=np.uint8)])
            assert byte_hashes(raw, np.array([9]), np.array([9 + n])) == byte_hashes(other, np.array([7]), np.array([7 + n]))
        lists = [raw[:n] for n in range(100)] + [np.append(raw[:n], 0).astype(np.uint8) for n in range(100)]
        own = {x.tobytes() for x in lists}
        assert len({int(byte_hashes(np.frombuffer(x, np.uint8), np.array([0]), np.array([len(x)]))[0]) for x in own}) == len(own)


@pytest.mark.parametrize("kind", [None, sentencepiece.BPE, sentencepiece.UNIGRAM])
def test_sentencepiece(docs, kind):
    rows = sorted(sentencepiece.encode(docs, MODEL, kind=kind).collect())
    assert all(r.round_trip for r in rows)
    ref = spm.SentencePieceProcessor(model_file=MODEL)
    if kind != sentencepiece.UNIGRAM:  # the file is a BPE model
        assert [list(r.ids) for r in rows] == ref.encode(TEXTS)
    else:
        assert [list(r.ids) for r in rows] != ref.encode(TEXTS)


def test_token_store(spark, docs):
    path = token_store.new_store(spark)
    token_store.write_store(docs, path, P.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32, r.verified) for r in token_store.read_facts(spark, path).collect()}
    ref = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for i, t in enumerate(TEXTS):
        ids = [*ref.encode(t, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)


@pytest.mark.parametrize("words", [3, 5])
def test_jaccard_join(docs, words):
    rows = jaccard_join.near_duplicates(docs, like=jaccard_join.Likeness(words=words, percent=80)).collect()
    assert len(rows) == len(TEXTS) and all(r.id == r.component_id for r in rows)
    alone = jaccard_join.near_duplicates(docs.selectExpr("doc_id", "split(text, ' ')[4] as text"), like=jaccard_join.Likeness(words=words, percent=80)).collect()
    assert len(alone) == len(TEXTS) and all(r.id == r.component_id for r in alone)


def test_pipeline_keeps_both(spark, docs):
    assert corpus_pipeline.drop_near_copies(spark, docs, "").count() == len(TEXTS)


def test_spotsigs_and_toxicity():
    prints = [f.tolist() for f in spotsigs.fingerprints(pa.array(TEXTS, pa.large_string()))]
    assert len({tuple(f) for f in prints}) == len(TEXTS)
    # Beginnings of 4 and 5 bytes are the same for all sizes, whole words are not.
    rows = [set(r.tolist()) for r in toxicity.feature_rows(pa.array(TEXTS, pa.large_string()))]
    assert len({frozenset(r) for r in rows}) == len(TEXTS)


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if i % 2], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(i, i) for i in range(len(TEXTS)) if i % 2}
