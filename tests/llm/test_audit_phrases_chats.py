"""Filter audit, collocations and chat trees against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path as tokenizer_file
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import chat_tree, collocations, filter_audit, runtime
from tessera.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE = tokenizer_file("byte_bpe_50k.json")

# Filter audit


def plain_flags(rows):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    out = []
    for d, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        out.append((d, lang or "", fails + "E" * (d is not None and d > first[t])))
    return out


def plain_audit(flags, harms):
    out = {}
    parts = {p for _, p, _ in flags}
    for part in parts:
        rows = [(f, harms.get(d, set())) for d, p, f in flags if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for i, f in enumerate(order):
                gone, stay = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                out[part, order, i + 1] = [len(stay), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == f for r in rows), sum("good" in r[1] for r in gone), sum("toxic" in r[1] for r in gone)]
                left = stay
        for f in "ABCDE":
            value = sum(v[1] for k, v in out.items() if k[0] == part and k[1][k[2] - 1] == f)
            for k in out:
                if k[0] == part and k[1][k[2] - 1] == f:
                    out[k].append(value)
    return out


def audit_rows(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "X#", "ABC", "日本"]
    texts = [" ".join(rng.choice(vocabulary[:k]) for _ in range(n)) for n in (3, 99, 100, 101, 150) for k in (60, 404) for _ in range(3)]
    texts += ["", None, " \t\n", "A" * 50, "a b " * 60, "#" * 3, "\x0b".join(vocabulary[:120]), " ".join(vocabulary[:120]), "word " * 30_000]
    ids = [*range(len(texts)), *rng.sample(range(len(texts)), 15), *[None] * 6]
    return [(d, rng.choice(texts) if d is None or i >= len(texts) else texts[d], rng.choice(["en", "de", None, ""])) for i, d in enumerate(ids)]


AUDIT = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("share", [2, 1000])
def test_audit_against_every_order(spark, monkeypatch, share):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
    rows = audit_rows() + [(900 + i, "the same text", "en") for i in range(30)]
    labels = [(d, d % 2, int(d % 3 == 0)) for d in range(0, 930, 2)] + [(0, 1, 0), (None, 1, 1), (4, None, None)]
    # Columns that clash with those made on the way.
    docs = spark.createDataFrame([(*r, "x", True, 1, "y") for r in rows], "doc_id long, text string, lang string, part string, A boolean, state int, digest string")
    got = filter_audit.audit_texts(docs, spark.createDataFrame([(*r, "e") for r in labels], "doc_id long, quality int, toxic int, part string")).collect()
    harms = {}
    for d, q, t in labels:
        harms.setdefault(d, set()).update(["good"] * (q == 1) + ["toxic"] * (t == 1))
    harms.pop(None)
    want = plain_audit(plain_flags(rows), harms)
    assert len(got) == len(want)
    assert {(r.part, r.filter_order, r.step): [r[c] for c in AUDIT] for r in got} == want


def test_audit_of_nothing_and_of_other_filters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_texts(docs, labels).count() == 0
    flags = spark.createDataFrame([(None, True, None), ("p", False, True), ("p", None, True)], "part string, X boolean, Y boolean")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in filter_audit.audit(flags, ["X", "Y"]).collect()}
    assert got["", "XY", 1] == (0, 1, 0, 2) and got["p", "XY", 2] == (0, 2, 0, 4) and got["p", "YX", 2] == (0, 0, 0, 0) and len(got) == 8


# Collocations


def plain_collocations(rows, least, top, percent=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if any(k[0] == lang and len(k[1]) > len(p) and any(k[1][i : i + len(p)] == p for i in range(len(k[1]))) and 100 * b >= percent * a for k, b in found.items()):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    ranks, rows = Counter(), set()
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.add((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


def phrase_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "a", "x" * 40, "été", "日本", "b-c", "ÀB", " ", "o'", "😀"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " ! ", "\r\n", "\x0b", "?;:"]
    text = lambda: "".join(rng.choice(["new york city", "of the a", *words, *words]) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 3, 40, 90])))
    rows = [(rng.choice(["en", "en", "de", None, "und", ""]), text()) for _ in range(n)]
    return rows + [(None, None), ("en", ""), ("en", "..."), ("xx", "a b"), *[("de", "la la la la la la.")] * 20]


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 10, 2000), (2, 2, 7), (3, 1, 500)])
def test_collocations_against_counting(spark, monkeypatch, seed, least, top):
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 500)
    monkeypatch.setattr(runtime, "HOT_SHARE", 20)
    rows = phrase_rows(seed)
    docs = spark.createDataFrame([(*r, 1, 2, "f") for r in rows], "lang string, text string, chunk int, n int, word string").repartition(5)
    got = {tuple(r) for r in collocations.collocations(docs, least, top).collect()}
    assert got == plain_collocations(rows, least, top) and got


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "a b.")], "lang string, text string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        a = rng.randrange(10, 4 * 10**15)
        rows.append((a, a + rng.choice([0, 1, rng.randrange(10**6), rng.randrange(10**18)]), a + rng.randrange(10**15)))
    df = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", collocations.score_of("a", "l", "r"))
    assert all(x.s == 1_000_000 * x.a * x.a // (x.l * x.r) for x in df.collect()) and dict(df.dtypes)["s"] == "bigint"


def test_vertical_lists(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 64)
    texts = ["", "a", "b b", "one two. three\ttwo", " , ", "é" * 30 + " x" * 100 + "." + "y " * 90, "tail", "long" * 100]
    found = Counter()
    for _, _, data, offsets in slices(pa.array(texts, pa.large_string()), 1 << 20):
        for some, own in collocations.stretches(data, offsets):
            words, sizes, positions = collocations.vertical(some, own)
            assert (collocations.undone(collocations.deltas(positions, sizes), sizes) == positions).all()
            posts, ids = collocations.postings(sizes, collocations.deltas(positions, sizes).tobytes(), np.arange(len(words)), np.arange(len(words)))
            _, keys = collocations.extended(posts, ids, posts, ids)
            found.update((words[int(k >> np.uint64(32))].as_py(), words[int(k & collocations.ID_MASK)].as_py()) for k in keys)
    want = Counter()
    for t in texts:
        for piece in re.split(r"[.,;:!?\n]", t):
            w = piece.split()
            want.update(zip(w, w[1:], strict=False))
    assert found == want


def test_numbers_without_gaps(spark):
    scratch = runtime.Scratch(spark, "numbers")
    got = collocations.numbered(spark.range(1000).withColumnRenamed("id", "x").repartition(7), scratch, "numbers")
    assert sorted(r.id for r in got.collect()) == list(range(1000))
    sizes = spark.createDataFrame([(k, k % 5 + 1) for k in range(0, 20_000, 7)], "bucket long, n long")
    bases, total = {r.bucket: r.base for r in collocations.with_base(sizes, sizes, "bucket").collect()}, 0
    for k in range(0, 20_000, 7):
        assert bases[k] == total
        total += k % 5 + 1


# Chat trees


def test_marks_in_texts_are_escaped_reversibly():
    rng = random.Random(8)
    bits = [*chat_tree.CONTROLS, "[", "]", "<", "/", "\\", "INST]", "s>", " ok ", "é", "\n", "[/", "/s>", "<|endoftext|>", "[\\INST]"]
    for _ in range(3000):
        role = rng.choice([*chat_tree.MARKS, "", "tool", "".join(rng.choice(bits) for _ in range(3))])
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 9)))
        turn = chat_tree.formatted(role, text)
        assert chat_tree.parsed(turn) == (role, text)
        assert sum(turn.count(c) for c in chat_tree.CONTROLS) == (2 if role in chat_tree.MARKS else 3)
    assert chat_tree.escaped("plain [x] </b> \\") == "plain [x] </b> \\"


def chats(seed):
    rng = random.Random(seed)
    bits = ["hello", "[INST]", "</s>", "Ça va?", "日本\n", "<|endoftext|>", "\\", " "]
    rows = []
    for c in range(60):
        n = rng.choice([1, 2, 3, 8, 60 if c < 3 else 5])
        rows += [(c, t, rng.choice(["user", "assistant"]), bits[0] if t == 0 and c % 3 else rng.choice(bits[: 2 + t % 3])) for t in range(n)]
    rows += [(100 + c, t, "assistant" if t else "system", ["Be kind.", "".join(rng.choice(bits) for _ in range(5)), None][t]) for c in range(25) for t in range(3)]
    rows += [(None, 1, "user", "no id"), (None, None, None, None), (7, 1, "user", "again"), (7, 1, "user", "again"), (200, 5, "tool", "x" * 200_000), (201, 0, "", ""), (202, None, "user", None)]
    return rows + [(300 + c, t, ["user", "assistant"][t % 2], f"turn {t}") for c in range(20) for t in range(4)]


def conversations_of(rows):
    key = lambda x: [(v is not None, v if v is not None else 0) for v in x]
    out = {}
    for c, t, r, x in sorted(((c, t, r or "", x or "") for c, t, r, x in rows), key=lambda r: key(r[:2]) + [r[2].encode(), r[3].encode()]):
        out.setdefault(c, []).append((r, x))
    return out


@pytest.mark.parametrize(("seed", "share"), [(1, 1000), (2, 4)])
def test_trees_against_a_plain_walk(spark, monkeypatch, seed, share):
    monkeypatch.setattr(runtime, "HOT_SHARE", share)
    rows = chats(seed)
    turns = spark.createDataFrame([(*r, 1, b"x", 2) for r in rows], "conv_id long, turn long, role string, text string, seq int, node binary, begin int").repartition(6)
    path = runtime.shared_path(spark, "chats")
    chat_tree.write_chats(turns, path, BPE)
    want, n_turns = conversations_of(rows), len(rows)
    nodes = sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: r.begin)
    paths = {}
    for r in sorted(spark.read.parquet(f"{path}/paths").collect(), key=lambda r: r.seq):
        paths.setdefault(r.conv_id, []).append(r.begin)
    assert {c: len(p) for c, p in paths.items()} == {c: len(t) for c, t in want.items()}
    # Each beginning once, one after the other, without gaps.
    beginnings = {tuple(t[: i + 1]) for t in want.values() for i in range(len(t))}
    assert len(nodes) == len(beginnings) and [r.begin for r in nodes] == [0, *[r.end for r in nodes[:-1]]] and all(r.end - r.begin == len(r.tokens) for r in nodes)
    at, tokenizer = {r.begin: r for r in nodes}, Tokenizer.from_file(BPE)
    ids = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    below = {}
    for c, turns_of in want.items():
        above = []
        for i, (role, text) in enumerate(turns_of):
            node = at[paths[c][i]]
            before, after = chat_tree.marks_of(role)
            assert node.tokens == ids(before) + ids(chat_tree.escaped(text)) + ids(after)
            assert node.position_ids == list(range(len(above), len(above) + len(node.tokens)))
            assert node.tokens[node.loss_begin : node.loss_end] == (ids(chat_tree.escaped(text)) if role == "assistant" else [])
            assert [x for s in node.attends for x in range(s.begin, s.end)] == above
            assert len(node.attends) <= 1 + math.log2(n_turns) and node.tree == paths[c][0]
            above += range(node.begin, node.end)
            for b in paths[c][:i]:
                below.setdefault(b, set()).add(node.begin)
    # Depth first: what stands below a node follows it directly.
    for r in nodes:
        end = max([r.end, *(at[b].end for b in below.get(r.begin, ()))])
        assert {x.begin for x in nodes if r.begin < x.begin < end} == below.get(r.begin, set())
    got = {r.conv_id: r for r in chat_tree.digests(chat_tree.read_turns(spark, path, BPE)).collect()}
    assert len(got) == len(want)
    for c, turns_of in want.items():
        learned = "".join(x for r, x in turns_of if r == "assistant")
        plain = "".join(f"{r}\n{x}\n" for r, x in turns_of)
        assert tuple(got[c])[1:] == (len(turns_of), hashlib.sha256(plain.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), sum(len(chat_tree.formatted(*t)) for t in turns_of), True)


def test_chats_of_nothing_and_of_named_conversations(spark):
    for rows, n in (([], 0), ([("a", 0, "user", "x"), ("b", 0, "user", "x")], 2)):
        path = runtime.shared_path(spark, "chats")
        chat_tree.write_chats(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), path, BPE)
        assert chat_tree.digests(chat_tree.read_turns(spark, path, BPE)).count() == n


def test_lookups_spread_common_keys(spark, monkeypatch):
    monkeypatch.setattr(runtime, "HOT_SHARE", 10)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(1000, None), (1001, "none")], "x long, key string")
    facts = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 300, 3)], "key string, y long")
    got = runtime.looked_up(rows, facts, "key", runtime.Scratch(spark, "lookups"))
    assert sorted((r.x, r.y) for r in got.collect()) == [(i, 1 if i % 3 else i) for i in range(300)] and got.columns == ["key", "x", "y"]


@pytest.mark.parametrize("top", [1, 5, 40, 300])
def test_best_of_many_with_ties(spark, top):
    rng = random.Random(top)
    rows = [("a" if rng.random() < 0.9 else "b", rng.randrange(30), f"p{i}") for i in range(600)] + [("c", 1, "x"), ("d", 2, "y")]
    df = spark.createDataFrame(rows, "lang string, score long, phrase string")
    want = {(lang, k + 1, s, p) for lang in "abcd" for k, (s, p) in enumerate(sorted(((s, p) for x, s, p in rows if x == lang), key=lambda x: (-x[0], x[1]))[:top])}
    assert {(r.lang, r.rank, r.score, r.phrase) for r in collocations.best_of(df, "lang", "score", [F.col("phrase")], top).collect()} == want
