"""SentencePiece, SpotSigs, the token store, decontamination and toxicity against plain versions."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece as spm
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from tessera.llm import decontaminate, sentencepiece, spotsigs, token_store, toxicity

ODD = ["", " ", "  a  b", "日本語 text\n\nnew", "a" * 700, "x\ty z", "thethethe" * 200, "é" * 300 + "the and" * 90, "😀 a▁b"]


MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(80).collect()
    return [r[0] for r in rows] + ODD


def model_bytes():
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def test_bpe_ids_are_those_of_the_library(texts):
    pieces = sentencepiece.load(model_bytes())
    ref = spm.SentencePieceProcessor(model_proto=model_bytes())
    mine = sentencepiece.encode_batch(texts, pieces)
    assert [r.tolist() for r in mine] == ref.encode(texts)
    assert sentencepiece.decode_batch(mine, pieces) == [ref.decode(r.tolist()) for r in mine]


def as_unigram(change=None):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model_bytes())
    proto.trainer_spec.model_type = sentencepiece.UNIGRAM
    for p in proto.pieces if change else []:
        if p.type == sentencepiece.NORMAL:
            p.score = change()
    return proto.SerializeToString()


def test_query_model_gives_the_ids_of_the_library_on_the_same_pieces(texts):
    """The file's pieces and scores as a unigram model: the greatest sum of scores, as the library's lattice search has it (its
    faster `encode` takes '▁the', -13, for '▁t', 'he', -2 and -6). The library adds up 32-bit floats: exact up to 2 ** 24,
    which short texts reach only by an unknown character or two blanks (a score of -1e9 each)."""
    pieces, ref = sentencepiece.load(model_bytes(), sentencepiece.UNIGRAM), spm.SentencePieceProcessor(model_proto=as_unigram())
    short = sorted({" ".join(t.split(" ")[i : i + 20])[:300] for t in texts for i in range(0, 200, 20)})
    score = lambda ids: sum(pieces.scores[i] if i != pieces.unknown_id and not 3 <= i < 259 else pieces.unknown_score for i in ids)
    for _ in range(2):  # the second time all words are known
        mine = sentencepiece.encode_batch(short, pieces)
        exact = [i for i, r in enumerate(mine) if score(r) > -(2**24)]
        theirs = [ref.nbest_encode(short[i], nbest_size=2)[0] if short[i] else [] for i in exact]
        assert len(exact) > 300 and [score(mine[i]) for i in exact] == [score(r) for r in theirs]
        assert sum(mine[i].tolist() == r for i, r in zip(exact, theirs, strict=True)) > 0.9 * len(exact)  # others are ties
    assert sentencepiece.decode_batch(mine, pieces) == [ref.decode(r.tolist()) for r in mine]
    for text, own in zip(texts, sentencepiece.encode_batch(texts, pieces), strict=True):
        assert score(own) >= score(ref.encode(text)) - 1e-6


def test_viterbi_reaches_the_best_score_of_the_library(texts):
    rng = random.Random(3)
    raw = as_unigram(lambda: -8 - 4 * rng.random())
    pieces, ref = sentencepiece.load(raw), spm.SentencePieceProcessor(model_proto=raw)
    score = lambda ids: sum(pieces.scores[i] for i in ids)
    for text, mine in zip(texts, sentencepiece.encode_batch(texts, pieces), strict=True):
        theirs = ref.encode(text)
        assert mine.tolist() == theirs or abs(score(mine.tolist()) - score(theirs)) < 1e-2


@pytest.mark.parametrize("kind", [sentencepiece.UNIGRAM, sentencepiece.BPE])
def test_very_long_words(monkeypatch, kind):
    pieces = sentencepiece.load(model_bytes(), kind)
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(200_000)), "a" * 60_000, "é" * 5000, "0123456789" * 3000]
    started = time.monotonic()
    long = sentencepiece.encode_batch(words, pieces)
    assert time.monotonic() - started < 60 and sentencepiece.decode_batch(long, pieces) == words
    # Words that are cut, or go character by character, get the ids that the batch of short words gives them.
    some = ["".join(rng.choice("ethanso") for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    want = [r.tolist() for r in sentencepiece.encode_batch(some, pieces)]
    monkeypatch.setattr(sentencepiece, "LONG", 20)
    pieces.known = sentencepiece.Remembered()
    assert [r.tolist() for r in sentencepiece.encode_batch(some, pieces)] == want
    monkeypatch.setattr(sentencepiece, "cuts_of", lambda word, p: np.zeros(0, np.int64))
    monkeypatch.setattr(sentencepiece, "REMEMBERED", 0)
    assert [r.tolist() for r in sentencepiece.encode_batch(some, pieces)] == want


def test_encode_handles_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b")], "doc_id long, text string")
    rows = sentencepiece.encode(docs, P.path("piece_bpe_32k.model")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows)[1:] == [(1, 0), (2, 0), (2, 0)] and all(r.round_trip for r in rows)
    back = sentencepiece.decode(sentencepiece.encode(docs, P.path("piece_bpe_32k.model")), P.path("piece_bpe_32k.model"))
    assert {r.text for r in back.collect()} == {"", "a b"}
    assert sentencepiece.encode(docs.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_spotsigs_query_against_a_loop(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).unionByName(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "?! .")], "doc_id long, text string"))
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in spotsigs.edit_likeness(docs).collect()}
    assert len(got) == len(rows)
    anchors = {w for ws in spotsigs.ANCHORS.values() for w in ws}

    def plain(text):
        words = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        content = [i for i, w in enumerate(words) if w not in anchors]
        out = set()
        for i, w in enumerate(words):
            chain = [j for j in content if j > i][: spotsigs.CHAIN]
            if w in anchors and len(chain) == spotsigs.CHAIN:
                out.add((w, *(words[j] for j in chain)))
        return out

    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = plain(text), plain(edited)
        if a and b:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 1e-9
    assert got[10**6].fingerprint == got[10**6 + 1].fingerprint == "" and got[10**6 + 2].fingerprint


def test_spotsigs_ranges_keep_the_order(spark, monkeypatch):
    from tessera.llm import ordering

    monkeypatch.setattr(ordering, "RANGE_WEIGHT", 40)
    rows = [(i * 3 % 50, f"the w{i} of x{i} and y{i}") for i in range(50)] + [(7, "dup the a b"), (None, "the end of all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted([r for r in rows if r[0] is not None], key=lambda r: (-r[0], r[1])) + [r for r in rows if r[0] is None]
    got = Counter((r.doc_id, r.edited_sha256) for r in spotsigs.edit_likeness(docs).collect())
    want = Counter()
    for i, (doc_id, t) in enumerate(order):
        want[doc_id, hashlib.sha256(spotsigs.edited(t, order[(i + 1) % len(order)][1]).encode()).hexdigest()] += 1
    assert got == want


def test_spot_pairs_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(120)
    sets = {r.doc_id: frozenset(r.s) for r in spotsigs.signature_sets(docs).toDF("doc_id", "n", "s").collect()}
    first = {}
    for d in sorted(sets):
        first.setdefault(sets[d], d)
    ids = sorted(first.values())
    want = {(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5}
    assert {tuple(sorted((r.a, r.b))) for r in spotsigs.spot_pairs(docs, 0.5).collect()} == want


def test_encoder_gives_the_tokenizers_ids(texts, monkeypatch):
    own, ref = token_store.Encoder(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    more = [*texts, "a \n b  c\t d", "it's  don't <|endoftext|> z", "　 q", "a\x1c b", "9 9a 'll 'x", " lead", "trail "]
    rng = random.Random(6)
    odd = [" ", " ", ".", ",", ")", "\n", "  ", "\n", "\t", "\u00a0", "\u3000", "'s", "9", "a", "Z", "é", "日", "!", "\u2028", "\x85", "\x1c", "'"]
    more += ["".join(rng.choice(odd) for _ in range(rng.randrange(12))) for _ in range(12000)]
    want = [e.ids for e in ref.encode_batch(more, add_special_tokens=False)]
    for remembered in (token_store.REMEMBERED, 50):  # the second and third time words are known, or were forgotten
        monkeypatch.setattr(token_store, "REMEMBERED", remembered)
        for _ in range(3):
            ids, starts = own.encode(pa.array(more))
            assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == want
    for part in (more[:1], [None, ""], [], ["a\n b"], ["a\n", "b", "\n", "c\nd", "e.\n\nf", "g,\n", "."]):
        ids, starts = own.encode(pa.array(part, pa.string()))
        assert ids.tolist() == [i for e in ref.encode_batch([x or "" for x in part], add_special_tokens=False) for i in e.ids] and len(starts) == len(part) + 1


def plain_chunk_ends(ids):
    """Place by place: the window's ids alone say whether a chunk ends there."""
    ends, last = [], 0
    for i in range(len(ids)):
        window = ids[max(0, i + 1 - token_store.WINDOW) : i + 1]
        if i + 1 == len(ids) or ends_at(window):
            while i + 1 - last > token_store.MOST_IDS:
                last += token_store.MOST_IDS
                ends.append(last)
            ends.append(i + 1)
            last = i + 1
    return ends


def ends_at(window):
    """Whether the hash of a window alone ends a chunk at its last id: then one more id starts a new chunk."""
    longer = np.append(window, np.uint32(7))
    return len(window) in token_store.chunk_ends(longer, np.array([0, len(longer)])).tolist()


def test_chunks_and_crcs(monkeypatch):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50000, 30000).astype(np.uint32)
    ends = token_store.chunk_ends(ids, np.array([0, len(ids)]))
    assert ends[-1] == len(ids) and (np.diff(ends) <= token_store.MOST_IDS).all()
    longer = np.concatenate([ids[:100], ids])
    shifted = token_store.chunk_ends(longer, np.array([0, len(longer)]))
    assert set((ends[2:] + 100).tolist()) <= set(shifted.tolist())
    # Many texts at once are cut as each one is.
    monkeypatch.setattr(token_store, "MOST_IDS", 300)
    cuts = np.unique(np.concatenate([[0, 30000], rng.integers(1, 30000, 40)]))
    every = token_store.chunk_ends(ids, cuts)
    one = [a + e for a, b in zip(cuts[:-1], cuts[1:], strict=True) for e in token_store.chunk_ends(ids[a:b], np.array([0, b - a]))]
    assert every.tolist() == one and (np.diff(every, prepend=0) <= 300).all()
    assert plain_chunk_ends(ids[:2000]) == token_store.chunk_ends(ids[:2000], np.array([0, 2000])).tolist()
    a, b = b"abc" * 99, b"defgh" * 1000
    pieces = [a, b, b"", b, a, a, b"x" * 100_000]
    found = token_store.joined_crcs(np.array([zlib.crc32(x) for x in pieces]), np.array([len(x) for x in pieces]), np.array([0, 2, 2, 3, 7]))
    assert found.tolist() == [zlib.crc32(a + b), 0, 0, zlib.crc32(b + a + a + b"x" * 100_000)]


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_token_store_round_trip(spark, sf, monkeypatch, broadcast):
    from tessera.llm import ordering

    monkeypatch.setattr(token_store, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(ordering, "RANGE_WEIGHT", 20_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(100)
    docs = docs.unionByName(spark.createDataFrame([(10**6, None), (-5, ""), (10**6, "the same"), (10**6 + 1, "the same"), (10**6 + 1, "the same")], "doc_id long, text string"))
    path = token_store.new_store(spark)
    token_store.write_store(docs, path, P.path("byte_bpe_50k.json"))
    facts = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32, r.verified) for r in token_store.read_facts(spark, path).collect())
    ref, start = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert [f[1] for f in facts] == [r[0] for r in rows] and all(f[4] for f in facts)
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*ref.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((f[1], f[2], f[3]) for f in facts) == want
    for f in facts:
        assert f[0] == start
        start += f[2]
    chunks = token_store.read_chunks(spark, path)
    assert chunks.count() == chunks.select("digest").distinct().count()
    recipes = token_store.read_recipes(spark, path).collect()
    assert len({r.range for r in recipes}) > 5
    # Files hold ascending ids: chunks stand in the order of their first use, recipes in that of their start.
    use = {}
    for r in sorted(recipes, key=lambda r: r.start):
        for x in r.digests:
            use.setdefault(bytes(x), len(use))
    for name, place in (("chunks", lambda r: use[r["digest"]]), ("recipes", lambda r: r["start"])):
        at = []
        for n in sorted({r.range for r in recipes}):
            (file,) = Path(f"{path}/{name}/range={n}".removeprefix("file://")).glob("*.parquet") if name == "recipes" else list(Path(f"{path}/{name}/range={n}".removeprefix("file://")).glob("*.parquet")) or [None]
            at += [place(r) for r in pq.ParquetFile(file).read().to_pylist()] if file else []
        assert at == sorted(at) and len(at) == (len(use) if name == "chunks" else len(recipes))
    whole = {r.start: r.ids for r in token_store.read_ids(spark, path).collect()}
    assert all(zlib.crc32(np.array(whole[f[0]], "<u4").tobytes()) == f[3] for f in facts)


def test_token_store_of_a_very_long_text(spark):
    rng = random.Random(14)
    texts = ["x" * 300_000, " ".join(f"w{rng.randrange(9000)}" for _ in range(200_000)), "a b"]
    path = token_store.new_store(spark)
    token_store.write_store(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, P.path("byte_bpe_50k.json"))
    ref = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [np.array([*ref.encode(t, add_special_tokens=False).ids, 2], "<u4") for t in texts]
    got = sorted((r.doc_id, r.n_tokens, r.ids_crc32, r.verified) for r in token_store.read_facts(spark, path).collect())
    assert got == [(i, len(w), zlib.crc32(w.tobytes()), True) for i, w in enumerate(want)]


def test_token_store_notices_damage(spark):
    docs = spark.createDataFrame([(i, f"some text {i} of a document") for i in range(20)], "doc_id long, text string")
    path = token_store.new_store(spark)
    token_store.write_store(docs, path, P.path("byte_bpe_50k.json"))
    chunks = token_store.read_chunks(spark, path).orderBy("digest").limit(15).toPandas()
    spark.createDataFrame(chunks, "digest binary, n int, ids binary, range int").write.mode("overwrite").partitionBy("range").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="missing or damaged"):
        token_store.read_facts(spark, path).collect()
    empty = token_store.new_store(spark)
    token_store.write_store(docs.limit(0), empty, P.path("byte_bpe_50k.json"))
    assert token_store.read_facts(spark, empty).count() == 0


def brute_contamination(docs, items, n=5, least=0.8):
    words = lambda t: re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (t or "").lower())
    out = {}
    for d, text in docs:
        w = words(text)
        for k, item in items:
            v = words(item)
            if not v or not w:
                continue
            g = min(n, len(v))
            b = Counter(tuple(v[i : i + g]) for i in range(len(v) - g + 1))
            for s in range(max(1, len(w) - len(v) + 1)):
                part = w[s : s + len(v)]
                a = Counter(tuple(part[i : i + g]) for i in range(len(part) - g + 1))
                if a and (score := sum((a & b).values()) / sum((a | b).values())) >= least:
                    out[d, k] = max(out.get((d, k), 0), score)
    return out


def test_contamination_against_all_windows(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").limit(12).collect()] + [(900, "tiny item"), (901, None), (902, "?!"), (903, "a b a b a b a b a b a b c d e f g")]
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    rng = random.Random(5)
    docs = list(base)
    for i, (k, text) in enumerate(items[:12]):
        words = text.split(" ")
        for j in range(i % 4):
            words[rng.randrange(len(words))] = f"new{j}"
        docs.append((5000 + i, base[i][1][:300] + " " + " ".join(words).upper() + " " + base[i + 1][1][:200]))
    docs += [(6000, None), (6001, ""), (6002, "tiny item"), (6003, "x a b a b a b a b a b a b c d e f g y"), (6003, "tiny item")]
    got = {}
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for r in found.collect():
        got[r.doc_id, r.item_id] = max(got.get((r.doc_id, r.item_id), 0), r.similarity)
    want = brute_contamination(docs, [x for x in items])
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    kept = decontaminate.drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in docs if not any(d == x for x, _ in want))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0


def test_contamination_of_a_very_long_text(spark):
    rng = random.Random(13)
    words = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    items = [(i, words(60)) for i in range(40)]
    long = words(100_000) + " " + items[7][1].upper() + " " + words(100_000) + " " + items[31][1]
    docs = spark.createDataFrame([(1, long), (2, "x" * 2_000_000), (3, words(200))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.first_word) for r in got} == {(1, 7, 100_000), (1, 31, 200_060)}


def test_hamming_index_is_complete(monkeypatch):
    monkeypatch.setattr(decontaminate, "CELLS", 5000)
    rng = np.random.default_rng(2)
    words = decontaminate.PRINT_WORDS
    prints = rng.integers(0, 2**63, (300, words), dtype=np.uint64)
    flips = [np.packbits(np.isin(np.arange(64 * words), rng.choice(64 * words, n, replace=False))).view(np.uint64) for n in range(100)]
    queries = np.concatenate([prints[:100] ^ np.array(flips), rng.integers(0, 2**63, (200, words), dtype=np.uint64)])
    q, f = decontaminate.HammingIndex(prints).within(queries)
    near = np.bitwise_count(queries[:, None] ^ prints[None, :]).sum(2) <= decontaminate.RADIUS
    assert set(zip(q.tolist(), f.tolist(), strict=True)) == set(zip(*np.nonzero(near), strict=True)) and near.sum() == decontaminate.RADIUS + 1
    # Few random pairs have a block that is near.
    blocks = decontaminate.HammingIndex.blocks_of(rng.integers(0, 2**64, (2000, words), dtype=np.uint64))
    assert np.mean([(np.bitwise_count(blocks[:, i, None] ^ blocks[:, i + 1 :]) <= decontaminate.RADIUS // decontaminate.BLOCKS).any(0).mean() for i in range(200)]) < 0.01


def toxic_docs(n, seed):
    rng = random.Random(seed)
    plain, bad = [f"word{i}" for i in range(400)], ["vile", "scum", "rotten", "filth", "loathed"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        for _ in range(rng.randrange(2, 7) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "est", "ly"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_docs(900, 1)
    frame = spark.createDataFrame(docs + [(9001, None), (9002, "")], "doc_id long, text string")
    train = spark.createDataFrame(labels[:600] + [(9001, 1), (9002, None)], "doc_id long, toxic int")
    model = toxicity.train(frame, train)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    right = sum(got[d].rejected == bool(t) for d, t in labels[600:])
    assert right >= 0.99 * 300 and not got[9001].rejected and not got[9002].rejected
    mild = np.mean([got[d].expected_severity for d, t in labels[600:] if not t])
    assert mild < 0.5 < np.mean([got[d].expected_severity for d, t in labels[600:] if t])
    kept = toxicity.drop_toxic(frame.selectExpr("text", "doc_id", "'x' as features"), model)
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.rejected} and kept.columns == ["text", "doc_id", "features"]


def test_gradient_and_maximum_of_the_ordinal_model():
    rng = np.random.default_rng(4)
    score, theta, grades = rng.normal(size=50) * 2, np.array([-0.5, 0.4, 2.0]), rng.integers(0, 4, 50)
    got, h = toxicity.slopes(score, theta, grades), 1e-5
    for k in range(3):  # the threshold's derivative is minus the slope's
        step = h * (np.arange(3) == k)
        numeric = (toxicity.log_likelihood(score, theta + step, grades) - toxicity.log_likelihood(score, theta - step, grades)) / (2 * h)
        assert np.allclose(-got[:, k], numeric, atol=1e-6)
    numeric = (toxicity.log_likelihood(score + h, theta, grades) - toxicity.log_likelihood(score - h, theta, grades)) / (2 * h)
    assert np.allclose(got.sum(1), numeric, atol=1e-6)
    # Three grades, two features that all toxic and some other texts have: a grid finds nothing better than fit.
    grades = np.repeat([0, 0, 0, 1, 2], 80)
    has = np.stack([(grades > 0) ^ (rng.random(400) < 0.1), ((grades > 1) | (grades == 1) & (rng.random(400) < 0.5)) ^ (rng.random(400) < 0.05)], 1)
    rows = [np.flatnonzero(x) for x in has]
    model = toxicity.fit(rows, grades, epochs=4000)
    assert model.features.tolist() == [0, 1]
    weight = toxicity.row_weights(grades)
    value = lambda w, t: (toxicity.log_likelihood(has @ w, t, grades) * weight).sum() - 1e-4 / 2 * (w * w).sum()
    best = value(model.weights, model.thresholds)
    for w0 in np.arange(0, 8, 0.5):
        for w1 in np.arange(0, 6, 0.5):
            for t0 in np.arange(0, 6, 0.5):
                for gap in (0.5, 1, 2, 3, 4):
                    assert value(np.array([w0, w1]), np.array([t0, t0 + gap])) <= best + 1e-4


def test_grades_follow_the_number_of_markers():
    rows = [np.arange(n) for n in (1, 1, 2, 3)] + [np.array([9])] * 4
    toxic = np.array([1, 1, 1, 1, 0, 0, 0, 0])
    assert toxicity.severity_grades([r for r in rows], toxic).tolist() == [1, 1, 1, 1, 0, 0, 0, 0]  # 1 and 2 stand in too few texts
    rows = [np.arange(n) for n in (2, 2, 2, 2, 2, 4, 4, 4, 5)] + [np.array([9])] * 4
    assert toxicity.severity_grades(rows, np.array([1] * 9 + [0] * 4)).tolist() == [1] * 5 + [2] * 4 + [0] * 4


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.rejected for r in toxicity.score(docs, model).collect()] == [False, False]
