"""Columns that are named like those an operator makes on its way come out as they went in."""

import corpus_pipeline
import pytest
from test_table_ops import plain_dedup, plain_verdict

from tessera.llm import line_dedup, url_filter

NAMES = """row id h hh __h __id __k __kh __kept __gone __best kept kept_id kept_h key k1 k2 seg ord line line_no first of gone rows best target token tokens
    copy copies pattern band family hub n d n_shingles component_id features toxic item similarity words begin end state part digest""".split()


def clashing(spark, rows, schema, names):
    """rows with a column for each name that holds the name and the row's number."""
    more = [f"{n}_{{0}}" for n in names]
    return spark.createDataFrame([(*r, *(m.format(i) for m in more)) for i, r in enumerate(rows)], schema + "".join(f", `{n}` string" for n in names))


def unchanged(df, names, number):
    assert set(names) <= set(df.columns)
    for r in df.collect():
        assert [r[n] for n in names] == [f"{n}_{number(r)}" for n in names]


def test_line_dedup(spark):
    texts = ["a line of some length\nand another one here", "a line of some length\nwholly different words", None, "", "and another one hers"]
    docs = clashing(spark, list(enumerate(texts)), "doc_id long, text string", NAMES)
    got = line_dedup.dedup_lines(docs)
    unchanged(got, NAMES, lambda r: r.doc_id)
    assert {r.doc_id: r.text for r in got.collect()} == plain_dedup(list(enumerate(texts)))
    # The names of the id and the text are free as well.
    odd = docs.select("doc_id", "text").withColumnsRenamed({"doc_id": "h", "text": "row"})
    assert {r.h: r.row for r in line_dedup.dedup_lines(odd, "h", "row").collect()} == plain_dedup(list(enumerate(texts)))


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_url_filter(spark, monkeypatch, broadcast):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", broadcast)
    urls = ["http://a.com/en/1", "http://www.com/en/", None, "x", "http://b.net/de/8", "http://www.b.net/de/8", *[f"http://www.c{i}.com/x" for i in range(30)]]
    rules = [("com/en/", "block"), ("b.net/de/8", "block"), ("www.b.net/", "allow"), ("a/", "block"), ("com/", "block")]
    got = url_filter.filter_urls(clashing(spark, list(enumerate(urls)), "page_id long, url string", NAMES), url_filter.rules_table(spark, rules))
    unchanged(got, NAMES, lambda r: r.page_id)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_pipeline_stages(spark, tmp_path):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(words) + " x", None, "other text altogether\nwith lines", ""]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = clashing(spark, rows, "doc_id long, text string, lang string, source string, n_chars long", NAMES)
    folder = f"file://{tmp_path}"
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(words[:30]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = {"toxicity": [0, 1, 2, 3, 4], "line dedup": [0, 1, 2, 3, 4], "n-gram Jaccard join": [0, 2, 3, 4], "benchmark decontamination": [2, 3, 4]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns
        unchanged(got, NAMES, lambda r: r.doc_id)
        assert sorted(r.doc_id for r in got.collect()) == kept[name], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 5
