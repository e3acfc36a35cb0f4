"""Line dedup, sharding, WARC, URL filters and the Jaccard join against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import jaccard_join, line_dedup, sharding, url_filter, warc
from tessera.llm.queries import URL_RULES
from tessera.llm.runtime import Scratch, shared_path


def one_edit(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.MIN_CHARS or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] or a[p:] == b[p + 1 :] or a[p + 1 :] == b[p:]


def plain_dedup(rows):
    lines = [((d, n), x, x.strip(" \t\r")) for d, t in rows for n, x in enumerate((t or "").split("\n"))]
    seen, kept = [], set()
    for at, _, key in sorted(lines):
        if key and not any(one_edit(key, k) for k in seen):
            kept.add(at)
        if key:
            seen.append(key)
    out = {}
    for d, t in rows:
        out[d] = None if t is None else "\n".join(x for at, x, key in lines if at[0] == d and (not key or at in kept))
    return out


def varied_lines(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.choice([3, 9, 10, 11, 40, 300, 3000]))) for _ in range(12)]
    rows = []
    for d in range(n):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            x = rng.choice(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                p = rng.randrange(len(x) + 1)
                x = rng.choice([x[:p] + "z" + x[p:], x[:p] + x[p + 1 :], x[:p] + "q" + x[p + 1 :]])
            lines.append(rng.choice(["", " "]) + x + rng.choice(["", "\r"]))
        rows.append((d, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_against_all_pairs(spark, seed):
    rows = varied_lines(seed, 40) + [(900, None), (901, ""), (902, "\n\n"), (903, "x"), (904, "x")]
    docs = spark.createDataFrame([(t, d, "extra") for d, t in rows], "text string, doc_id long, key string")
    got = line_dedup.dedup_lines(docs)
    assert got.columns[:3] == ["text", "doc_id", "key"]
    assert {r.doc_id: r.text for r in got.collect()} == plain_dedup(rows)
    dropped = {r.doc_id for r in line_dedup.dedup_lines(docs, drop_emptied=True).collect()}
    plain = plain_dedup(rows)
    assert dropped == {d for d, t in rows if not (t or "").strip() or plain[d].strip()}


def test_line_dedup_of_repeated_rows_and_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", 0)
    rows = varied_lines(3, 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == plain_dedup(rows)
    twice = spark.createDataFrame([(1, "the very same line"), (1, "the very same line"), (1, "the very same lime"), (None, "the very same line")], "doc_id long, text string")
    assert Counter((r.doc_id, r.n_kept) for r in line_dedup.dedup_lines(twice).collect())[None, 1] == 1
    assert line_dedup.dedup_lines(twice.limit(0)).count() == 0


def test_line_dedup_of_very_long_lines(spark):
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    rows = [(1, line), (2, line[:9_000] + "z" + line[9_001:]), (3, line[:19_000] + line[19_001:]), (4, line[:5] + "zz" + line[7:]), (5, "é" * 17_000), (6, "é" * 17_001 + "\n" + "é" * 16_998)]
    got = {r.doc_id: (r.n_lines, r.n_kept) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 0), 3: (1, 0), 4: (1, 1), 5: (1, 1), 6: (2, 1)}


def test_shards_are_even_and_slots_gapless(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", (F.octet_length("text") + 16).cast("long").alias("size"), "lang", "source", "n_chars")
    docs = docs.unionByName(spark.createDataFrame([(None, 16, None, None, None), (5, 700, "en", None, -1), (5, 700, "en", None, -1)], docs.schema))
    dims = [sharding.categorical("lang"), sharding.categorical("source"), sharding.numeric("n_chars")]
    placed, splits = sharding.kd_tree_shards(docs, dims, "size", 7)
    rows = placed.collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, r.size) for r in docs.collect())
    bytes_of, most = Counter(), max(r.size for r in rows)
    for r in rows:
        bytes_of[r.shard] += r.size
    assert set(bytes_of) == set(range(7)) and max(bytes_of.values()) - min(bytes_of.values()) <= 3 * most
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len(splits) == 6
    again, _ = sharding.kd_tree_shards(docs, dims, "size", 7)
    assert Counter((r.doc_id, r.size, r.shard, r.slot) for r in again.collect()) == Counter((r.doc_id, r.size, r.shard, r.slot) for r in rows)


def plain_tree(rows, widths, first, k):
    """(row, shard) of rows (keys, size, row) by recursion over sorted lists; `widths` are the whole table's along each dimension."""
    if k == 1 or not rows:
        return [(r, first) for _, _, r in rows]
    width = lambda i: (max(x[i] for x, _, _ in rows) >> 32) - (min(x[i] for x, _, _ in rows) >> 32)
    dim = max(range(len(widths)), key=lambda i: (width(i) / max(1, widths[i]), -i))
    wanted, sums = sum(s for _, s, _ in rows) * (k // 2) / k, Counter()
    for x, s, _ in rows:
        sums[x[dim]] += s
    below = 0
    for key in sorted(sums):
        if below + sums[key] >= wanted:
            cut = key if below + sums[key] - wanted <= wanted - below else key - 1
            break
        below += sums[key]
    left, right = [r for r in rows if r[0][dim] <= cut], [r for r in rows if r[0][dim] > cut]
    return plain_tree(left, widths, first, k // 2) + plain_tree(right, widths, first + k // 2, k - k // 2)


@pytest.mark.parametrize("shards", [2, 7, 12])
def test_shards_against_a_plain_recursion(spark, sf, shards):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", (F.octet_length("text") + 16).cast("long").alias("size"), "lang", "source", "n_chars")
    dims = [sharding.categorical("lang"), sharding.categorical("source"), sharding.numeric("n_chars")]
    keyed = sharding.keyed_rows(docs, dims, "size").select("row.doc_id", "size", "keys").collect()
    rows = [(r["keys"], r["size"], r["doc_id"]) for r in keyed]
    widths = [(max(x[i] for x, _, _ in rows) >> 32) - (min(x[i] for x, _, _ in rows) >> 32) for i in range(3)]
    got = {r.doc_id: r.shard for r in sharding.kd_tree_shards(docs, dims, "size", shards)[0].collect()}
    assert got == dict(plain_tree(rows, widths, 0, shards))


def test_rows_equal_in_all_columns_are_split(spark):
    docs = spark.range(4000).select(F.lit(100).cast("long").alias("size"), F.lit("x").alias("source"))
    placed, _ = sharding.kd_tree_shards(docs, [sharding.categorical("source")], "size", 4)
    sizes = Counter(r.shard for r in placed.collect())
    assert len(sizes) == 4 and max(sizes.values()) - min(sizes.values()) < 100


def test_shards_by_target_hot_values_and_empty_tables(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(100).cast("long").alias("size"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("source"), F.lit(1).alias("node"), F.lit(2).alias("keys"), F.lit(3).alias("row"))
    placed, _ = sharding.kd_tree_shards(docs, [sharding.categorical("source")], "size", target_bytes=20_000)
    sizes = Counter(r.shard for r in placed.collect())
    assert len(sizes) == 10 and max(sizes.values()) - min(sizes.values()) <= 3
    empty, splits = sharding.kd_tree_shards(docs.limit(0), [sharding.categorical("source")], "size", 4)
    assert empty.count() == 0 and splits == []


def test_written_shards_hold_their_rows(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit(10).cast("long").alias("size"), F.col("id").cast("string").alias("text"))
    placed, _ = sharding.kd_tree_shards(docs.select("doc_id", "size"), [sharding.numeric("doc_id")], "size", 4)
    path = shared_path(spark, "shards")
    sharding.write_shards(placed, docs, "doc_id", path)
    assert Counter(r.shard for r in spark.read.parquet(path).collect()) == Counter(r.shard for r in placed.collect())


def test_warc_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "SMALL_BYTES", 1000)
    pages = spark.range(60).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("repeat(cast(id as string), cast(case when id % 20 = 7 then 200000 when id % 3 = 0 then 2000 else 20 end as int))").alias("html")).coalesce(1)
    path = shared_path(spark, "warc")
    warc.write_warc(pages, path, records_per_file=16)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length", "content").collect()
    records = [f.content.count(b"WARC/1.1\r\n") for f in files]
    assert sum(records) == 60 and max(records) <= 16 and all(f.length <= 16 * 2000 or n == 1 for f, n in zip(files, records, strict=True))
    got = {r.page_id: r.payload for r in warc.read_warc(spark, path).collect()}
    assert {i: bytes(x) for i, x in got.items()} == {r.page_id: r.html.encode() for r in pages.collect()}


def test_warc_round_trip(spark):
    big, small = "<p>é" * 400, "<b>x</b>\r\n\r\nWARC/1.1"
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "u\r\nv", small), (4, "u", small), (5, "u", None), (6, "", ""), (None, "n", big), (9, None, big), (7, "o", "y" * 1000), (8, "o", "y" * 999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_path(spark, "warc")
    warc.write_warc(pages, path, records_per_file=3)
    records = warc.read_warc(spark, path)
    got = warc.resolved(records).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        others = [j for j, _, h in rows if h == html and j is not None]
        revisit = len(data) >= 1000 and i is not None and i != max(others)
        want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(others) if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {bytes(r.payload) for r in records.where("record_type = 'response'").collect()} == {(h or "").encode() for _, _, h in rows}
    assert {r.target_uri for r in records.collect() if r.page_id == 3} == {"u%0D%0Av"}
    none = shared_path(spark, "warc")
    warc.write_warc(pages.limit(0), none)
    assert warc.resolved(warc.read_warc(spark, none)).count() == 0


def plain_verdict(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(r), r, v) for r, v in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_url_rules_against_a_loop(spark):
    rng = random.Random(4)
    parts = ["com", "example.com", "EXAMPLE.net", "x.example.net", "badexample.com", "org", "net"]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(parts)}/{rng.choice(['en', 'de', 'es', 'En'])}/{rng.choice(['', '7', '78x', '8/', 'q'])}{rng.choice(['', '?a=/en/7', '#z'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://com/en/", "a://b://com/en/", "http://com\n/en/", "http://user@com/en/x", "http://com:80/en/"]
    rules = [*URL_RULES, ("com/en/7\\E.*", "allow"), ("example.com/e", "block"), ("a/", "block")]
    pages = spark.createDataFrame([(i, u, "mine", 0, 0) for i, u in enumerate(urls)] + [(0, urls[0], "mine", 0, 0)], "page_id long, url string, verdict string, best int, target int")
    got = url_filter.filter_urls(pages, url_filter.rules_table(spark, rules)).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(urls[r.page_id], rules)
    index = {r.rule: r.token for r in url_filter.rule_index(url_filter.rules_table(spark, rules), pages.selectExpr("substring_index(url, '://', -1) as target")).collect()}
    assert set(index) == {r for r, _ in rules}
    assert url_filter.filter_urls(pages.limit(0), url_filter.rules_table(spark, rules)).count() == 0


def plain_sets(rows, n):
    out = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


def plain_components(sets, percent):
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in ids}


def near_copies(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(60)]
    rows = []
    for d in range(n):
        if d % 6 == 0:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 6, 12, 14, 25, 60, 200]))]
        copy = list(words)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
            p = rng.randrange(len(copy))
            copy[p : p + 1] = rng.choice([[], ["new"], [copy[p], "more"]])
            copy = copy or ["one"]
        rows.append((d, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("words", "percent", "sets", "shingles"), [(3, 90, 1000, 10**6), (5, 80, 1000, 10**6), (3, 80, 6, 300), (1, 60, 5, 100)])
def test_components_against_all_pairs(spark, monkeypatch, words, percent, sets, shingles):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", shingles)
    rows = near_copies(words * percent, 240) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "A b"), (1004, "a B")]
    docs = spark.createDataFrame([(t, d, 0) for d, t in rows], "text string, doc_id long, n long")
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs, like=jaccard_join.Likeness(words, percent)).collect()}
    own = plain_sets(rows, words)
    components = plain_components(own, percent)
    assert got == {d: (len(own[d]), components[d]) for d in own}


def test_join_of_empty_tables_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y z"), (None, "a b c d e f")], "doc_id long, text string")
    got = Counter((r.id, r.component_id) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == Counter({(1, 1): 2, (2, 2): 1, (None, 1): 1})
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (3, 90), (1, 60)])
def test_large_families_are_cut_into_tiles(spark, monkeypatch, words, percent):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 2000)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    rng = random.Random(percent)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(90):  # near copies of one text, some of them far from it but near each other
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
            copy[rng.randrange(len(copy))] = rng.choice(["x", "y", f"n{d}"])
        rows.append((d, " ".join(copy[: rng.choice([150, 150, 130, 110, 90, 75, 60])])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in jaccard_join.near_duplicates(docs, like=jaccard_join.Likeness(words, percent)).collect()}
    assert got == plain_components(plain_sets(rows, words), percent)


def test_a_shared_passage_gives_no_family(spark, monkeypatch):
    """Texts that share a passage, a third of each, have no kept key in common; near copies do."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = [(d, " ".join([*(str(rng.random()) for _ in range(60)), *passage, *(str(rng.random()) for _ in range(60))])) for d in range(300)]
    rows += [(1000 + d, rows[d][1] + " more") for d in range(5)]
    docs = spark.createDataFrame(rows, "id long, text string")
    like = jaccard_join.Likeness()
    scratch = Scratch(spark, "test")
    sketch = scratch.table(jaccard_join.sketches(docs, like).withColumn("row", F.monotonically_increasing_id()), "sketch")
    kept = jaccard_join.kept_keys(sketch, scratch)
    assert kept.select("d").distinct().count() <= 30
    for run_keys in (1, 2000):  # runs of a slice, and of several: the same components
        monkeypatch.setattr(jaccard_join, "RUN_KEYS", run_keys)
        monkeypatch.setattr(jaccard_join, "SEEN", 3)
        got = {r.id: r.component_id for r in jaccard_join.near_duplicates(docs.repartition(3), "id", like=like).collect()}
        assert got == {d: d - 1000 if d >= 1000 else d for d, _ in rows}
    got = {r.id: r.component_id for r in jaccard_join.near_duplicates(docs, "id", like=like).collect()}
    assert got == {d: d - 1000 if d >= 1000 else d for d, _ in rows}


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_keys_miss_no_linked_pair(percent):
    """Also after each set has left out its spare keys, in a random order of all keys."""
    rng = np.random.default_rng(percent)
    like = jaccard_join.Likeness(3, percent)
    missed = linked = 0
    for turn in range(4000):
        n = int(rng.choice([3, 5, 10, 11, 12, 15, 19, 20, 40, 90]))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        if turn % 5 == 0:
            a = np.unique(a >> np.uint64(3))  # crowded: many empty parts
        drop, add = rng.integers(0, n // 3 + 1), rng.integers(0, n // 3 + 1)
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < percent * (len(a) + len(b) - both) or both == max(len(a), len(b)):
            continue
        linked += 1
        band = like.key_bands(np.array([min(len(a), len(b))]))[0]
        assert all(band[0] in [x[0] for x in like.key_bands(np.array([len(s)]))] for s in (a, b))
        salt = np.uint64(rng.integers(1, 2**63))
        left = []
        for s in (a, b):
            keys, starts, spare = jaccard_join.keys_of(jaccard_join.Sets(s, np.array([0, len(s)])), band, like)
            assert starts.tolist() == [0, len(keys)]
            left.append(set(sorted(np.unique(keys).tolist(), key=lambda k: (k ^ int(salt)) * 0x9E3779B97F4A7C15 % 2**64)[int(spare[0]) :]))
        missed += not left[0] & left[1]
    assert linked > 150 and not missed
