"""Cells and pieces of polygons against tests of every cell, cascading fills against loops, the order of the coverage report."""

import datetime
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import coverage, geometry, temporal, tiles, zonal


def star(rng, x, y, size, n):
    angle, reach = np.sort(rng.uniform(0, 2 * np.pi, n)), rng.uniform(0.3, 1, n) * size
    return geometry.closed(list(np.stack([x + reach * np.cos(angle), y + reach * np.sin(angle)], 1)))


def shapes(seed):
    rng = np.random.default_rng(seed)
    out = [[[star(rng, *rng.uniform(-20, 20, 2), rng.uniform(0.5, 15), rng.integers(3, 40))] for _ in range(rng.integers(1, 3))] for _ in range(25)]
    outer = star(rng, 0, 0, 30, 60)
    out.append([[outer, star(rng, 0, 0, 5, 9)]])
    out.append([[geometry.closed([(0, 0), (8, 0), (8, 4), (0, 4)])]])  # edges on cells' sides
    out.append([[geometry.closed([(1, 1), (1.5, 1), (1.5, 1.5)])], [geometry.closed([(10, -10), (40, -10), (40, 20), (10, 20)])]])
    return out


@pytest.mark.parametrize("side", [4.0, 1.3])
def test_cells_against_a_test_of_each(side):
    for parts in shapes(3):
        cells, crossed = geometry.cover(parts, side)
        got = set(map(tuple, cells.tolist()))
        every = np.concatenate([r for p in parts for r in p])
        low, high = np.floor(every.min(0) / side).astype(int) - 2, np.floor(every.max(0) / side).astype(int) + 2
        want = {(i, j) for i in range(low[0], high[0] + 1) for j in range(low[1], high[1] + 1) if geometry.meets_box(parts, i * side, j * side, (i + 1) * side, (j + 1) * side)}
        assert got == want and len(got) == len(cells)
        for (i, j), edge in zip(cells.tolist(), crossed.tolist(), strict=True):
            if not edge:
                assert geometry.clip_area(parts, i * side, j * side, (i + 1) * side, (j + 1) * side) == pytest.approx(side * side)
    assert len(geometry.cover([], side)[0]) == 0


def test_pieces_hold_the_same_points(spark):
    rng, side = np.random.default_rng(8), 3.0
    all_parts = shapes(5)
    df = spark.createDataFrame([(k, geometry.wkb_of([r for r in parts])) for k, parts in enumerate(all_parts)] + [(-1, None)], "k int, geom binary")
    rows = df.select("k", F.inline(geometry.cell_pieces(F.col("geom"), side))).collect()
    assert {r.k for r in rows} == set(range(len(all_parts)))
    pieces = {}
    for r in rows:
        assert (r.k, r.i, r.j) not in pieces
        pieces[r.k, r.i, r.j] = None if r.piece is None else geometry.rings_of(bytes(r.piece))[1]
    for k, parts in enumerate(all_parts):
        for x, y in rng.uniform(-45, 45, (300, 2)):
            at = (k, int(np.floor(x / side)), int(np.floor(y / side)))
            assert geometry.contains(parts, x, y) == (at in pieces and (pieces[at] is None or geometry.contains(pieces[at], x, y)))


def test_what_is_shuffled_grows_with_the_edge(spark):
    rng = np.random.default_rng(1)
    angle = np.linspace(0, 2 * np.pi, 4000, endpoint=False)
    ring = geometry.closed(list(np.stack([100 * np.cos(angle), 100 * np.sin(angle)], 1) * rng.uniform(0.97, 1, (4000, 1))))
    df = spark.createDataFrame([(geometry.wkb_of([[ring]]),)], "geom binary")
    found = {}
    for side in (8.0, 4.0, 2.0):
        found[side] = df.select(F.inline(geometry.cell_pieces(F.col("geom"), side))).agg(F.count("*"), F.count("piece"), F.sum(F.octet_length("piece"))).first()
    assert found[2.0][0] > 12 * found[8.0][0] and found[2.0][1] < 8 * found[8.0][1]
    # All pieces together have little more than the ring, not a ring for each cell.
    assert all(n[2] < 3 * 16 * len(ring) + 250 * n[1] for n in found.values())


def test_region_of_points_in_large_regions(spark):
    rng = np.random.default_rng(6)
    regions = shapes(9)
    points = [(k, *map(float, p)) for k, p in enumerate(rng.uniform(-30, 30, (400, 2)))]
    table = spark.createDataFrame([(f"r{k:02}", geometry.wkb_of(p)) for k, p in enumerate(regions)], "place string, geom binary")
    want = {k: next((f"r{i:02}" for i, p in enumerate(regions) if geometry.contains(p, x, y)), None) for k, x, y in points}
    for cell in (2.0, 17.0, 500.0):
        assert {r.k: r.place for r in zonal.first_region(spark.createDataFrame(points, "k int, x double, y double"), table, "k", cell).collect()} == want


def test_polygons_on_grid_leave_geometries_behind(spark):
    grid = spark.createDataFrame([(i, j) for i in range(-5, 5) for j in range(-5, 5)], "x_tile int, y_tile int")
    rows = [(k, geometry.wkb_of([[r * 50 for r in rings] for rings in parts])) for k, parts in enumerate(shapes(2))]
    out = tiles.polygons_on_grid(spark.createDataFrame(rows, "k int, geom binary"), grid).select("k", "x_tile", "y_tile")
    got = {tuple(r) for r in out.collect()}
    assert got == {(k, i, j) for k, parts in enumerate(shapes(2)) for i in range(-5, 5) for j in range(-5, 5) if geometry.meets_box([[r * 50 for r in x] for x in parts], i * 200, j * 200, i * 200 + 200, j * 200 + 200)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert all("geom" not in line for line in exchanges)


def test_cascading_fill_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(p, t, None if p == 3 and t == 2 else rng.choice([0.0, 1.0, 0.0, rng.random(), rng.random()])) for p in range(40) for t in range(rng.randrange(1, 12))]
    want = {}
    for p in range(40):
        own = sorted((t, v) for q, t, v in rows if q == p)
        v = [x for _, x in own]
        for bad in (0.0, 1.0):
            for i in range(len(v)):
                if v[i] == bad:
                    v[i] = statistics.median(x for x in v if x is not None)
        want |= {(p, t): x for (t, _), x in zip(own, v, strict=True)}
    got = {(r.p, r.t): r.v for r in temporal.cascading_filled(spark.createDataFrame(rows, "p int, t int, v double"), ["p"]).collect()}
    assert got == pytest.approx(want)


def test_coverage_is_ordered(spark):
    day = datetime.date(2020, 1, 1)
    rows = [("b", "p", day, None), ("b", "p", day, {2019: 1.0}), ("a", "p", day, None), (None, "c", day, None), (None, "c", day, {}), ("z", "p", day, {2000: 1.0})]
    df = spark.createDataFrame(rows, "short_name string, project_id string, plantstart date, ttc map<int, double>")
    assert [r.label for r in coverage.coverage(df).collect()] == ["c", "a", "b", "z"]
