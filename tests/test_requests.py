"""Conditions of requests, unreadable geometries, undated polygons, first matches and clusters of long chains."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import components, geometry, tiles
from tessera.plans import report


def polygons(spark):
    rows = [("a", "n1", "f1", "u1", ["x", "y"], 3), ("a", "n2", "f1", "u2", ["y"], 5), ("b", "n1", "f2", "u3", None, 9), (None, "n3", "f2", "u4", [], 1)]
    return spark.createDataFrame(rows, "project_id string, short_name string, framework_key string, poly_uuid string, cohort array<string>, area int")


def test_effects_of_conditions(spark):
    df = polygons(spark)
    given = {"projects": ["a", "zz"], "cohorts": ["y"], "where": "area > 4"}
    rows = [tuple(r) for r in report.filter_effects(df, **given).collect()]
    assert rows == [("project_id", "a", 2), ("project_id", "zz", 0), ("cohort", "y", 2), ("predicate", "area > 4", 2), ("all conditions", None, 1)]
    assert [r.poly_uuid for r in tiles.filtered(df, **given).collect()] == ["u2"]
    assert "| project_id | a | 2 |" in report.markdown(report.filter_effects(df, **given), "Filter")
    with pytest.raises(ValueError):
        tiles.filtered(df)


@pytest.mark.parametrize("word", "drop Delete INSERT update alter create truncate grant revoke attach copy pragma".split())
def test_predicates_hold_no_statement(word):
    for text in (f"{word} x", f"a = 1 or ({word})", "a = 1; b"):
        with pytest.raises(ValueError):
            tiles.checked_predicate(text)
    assert tiles.checked_predicate(f"a_{word} > 1 and {word}s = 2")


def test_unreadable_geometries(spark):
    square = geometry.wkb_of([[geometry.closed([(0, 0), (4, 0), (4, 4), (0, 4)])]])
    df = spark.createDataFrame([(0, square), (1, None), (2, b"xx"), (3, b"")], "k int, geom binary")
    one = F.lit(1.0)
    got = df.select("k", geometry.tile_overlap(F.col("geom"), one, one, one * 3, one * 3).alias("area"), geometry.within(F.col("geom"), one, one).alias("holds"), geometry.meets(F.col("geom"), one, one, one, one).alias("meets")).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, 4.0, True, True), *((k, 0.0, False, False) for k in (1, 2, 3))]
    assert [r.k for r in geometry.exploded(df).collect()] == [0]


def test_needed_tiles_of_undated_polygons(spark):
    schema = "valid boolean, plantstart date, ttc map<int, double>, x0 int, y0 int, x1 int, y1 int"
    grid = spark.createDataFrame([(0, 0)], "x_tile int, y_tile int")
    undated, dated = (True, None, None, 10, 10, 20, 20), (True, datetime.date(2020, 5, 1), None, 10, 10, 20, 20)
    with pytest.raises(ValueError):
        tiles.needed_tiles(spark.createDataFrame([undated], schema), grid)
    assert [tuple(r) for r in tiles.needed_tiles(spark.createDataFrame([undated, dated], schema), grid).collect()] == [(2019, 0, 0)]
    assert tiles.needed_tiles(spark.createDataFrame([], schema), grid).count() == 0


def least_of(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    first = {}
    for n, k in pairs:
        a, b = find(n), find(first.setdefault(k, n))
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}


def test_clusters_against_union_find(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.choice([None, *range(250)])) for _ in range(500)]
    df = spark.createDataFrame([(n, k, "p") for n, k in pairs], "node int, cell int, project string")
    assert {r.node: r.cluster for r in components.clusters(df, "node", "project", "cell").collect()} == least_of(pairs)
    assert components.clusters(df.limit(0), "node", "cell").count() == 0


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, turns, real = 10_000, [], components.state_of
    monkeypatch.setattr(components, "state_of", lambda links: turns.append(1) or real(links))
    order = list(range(n))
    random.Random(5).shuffle(order)
    df = spark.createDataFrame([(order[i + d], i) for i in range(n - 1) for d in (0, 1)], "node int, cell int")
    assert components.clusters(df, "node", "cell").where("cluster = 0").count() == n
    assert len(turns) < 25 and len(turns) < 2 * math.log2(n)
