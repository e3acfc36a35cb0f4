"""Unions of polygons against counting of half squares, known shapes and sampled points."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import geometry, overlay, zonal


def poly(*points):
    return geometry.wkb_of([[geometry.closed(points)]])


def halves(kind, x, y, n):
    """Half squares (i, j, lower right or upper left) of a triangle with its long side along a diagonal, or of a square."""
    for i in range(n):
        for j in range(n):
            if kind == "box" or (j < i if kind == "low" else j > i):
                yield from ((x + i, y + j, 0), (x + i, y + j, 1))
            elif i == j:
                yield x + i, y + j, int(kind == "up")


def shape(kind, x, y, n):
    return poly(*{"box": [(x, y), (x + n, y), (x + n, y + n), (x, y + n)], "low": [(x, y), (x + n, y), (x + n, y + n)], "up": [(x, y), (x + n, y + n), (x, y + n)]}[kind])


@pytest.mark.parametrize("cell", [7.0, 3.3, 100.0])
def test_union_of_triangles_and_boxes(spark, cell):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(260):
        g, kind, x, y, n = rng.choice(["a", "b", None]), rng.choice(["box", "low", "up"]), rng.randrange(-10, 25), rng.randrange(-10, 25), rng.randrange(1, 6)
        rows.append((k, g, shape(kind, x, y, n)))
        want.setdefault(g, set()).update(halves(kind, x, y, n))
    rows += [(0, "a", rows[0][2]), (998, "a", None), (999, "c", b"xx")]
    df = spark.createDataFrame(rows, "k int, g string, geom binary")
    got = {r.g: r.area for r in overlay.union_areas(df, "g", cell).collect()}
    assert got == pytest.approx({g: len(h) / 2 for g, h in want.items()}, abs=1e-6)
    whole = {r.g: (r.geom, r.area) for r in overlay.dissolved(df, "g", cell).collect()}
    assert set(whole) == set(want)
    for g, (raw, area) in whole.items():
        parts = geometry.rings_of(bytes(raw))[1]
        assert geometry.area_centre(parts)[0] == pytest.approx(area, abs=1e-5) and area == pytest.approx(len(want[g]) / 2, abs=1e-6)
        for i in range(-10, 31):
            for j in range(-10, 31):
                for low, (x, y) in ((0, (i + 0.7, j + 0.3)), (1, (i + 0.3, j + 0.7))):
                    assert geometry.contains(parts, x, y) == ((i, j, low) in want[g])


def test_adjoining_boxes_become_one(spark):
    rows = [(x % 2, shape("box", 3 * x, 3 * y, 3)) for x in range(12) for y in range(9)]
    rows = [("even" if x else "odd", g) for x, g in rows] + [("all", g) for _, g in rows] + [("ring", shape("box", x, y, 1)) for x in range(5) for y in range(5) if (x, y) != (2, 2)]
    df = spark.createDataFrame(rows, "region string, geom binary")
    got = {r.region: (geometry.rings_of(bytes(r.geom))[1], r.area) for r in overlay.dissolved(df, "region", 10.0).collect()}
    assert got["all"][1] == 12 * 9 * 9 and [len(r) for p in got["all"][0] for r in p] == [5]
    assert len(got["even"][0]) == 6 and all(len(p) == 1 and len(p[0]) == 5 for p in got["even"][0])
    assert got["ring"][1] == 24 and [len(p) for p in got["ring"][0]] == [2]


def test_unions_of_any_triangles(spark, monkeypatch):
    monkeypatch.setattr(overlay, "MOST_EDGES", 30)
    rng = np.random.default_rng(3)
    corners = rng.uniform(0, 20, (60, 3, 2))
    parts = [[[geometry.closed(c)]] for c in corners]
    area, edges = overlay.united([p for q in parts for p in q], 0, 0, 20, 20)
    points = rng.uniform(0, 20, (3000, 2))
    inside = np.array([any(geometry.contains(p, *x) for p in parts) for x in points])
    assert area / 400 == pytest.approx(inside.mean(), abs=0.03)
    whole = overlay.traced(overlay.swept(overlay.edges_of([p for q in parts for p in q]))[1])
    assert sum(geometry.contains(whole, *x) for x in points) == inside.sum()
    df = spark.createDataFrame([("g", geometry.wkb_of(p)) for p in parts], "g string, geom binary")
    for cell in (3.0, 50.0):
        (row,) = overlay.dissolved(df, "g", cell).collect()
        shapes = geometry.rings_of(bytes(row.geom))[1]
        assert row.area == pytest.approx(area, rel=1e-9) and geometry.area_centre(shapes)[0] == pytest.approx(area, rel=1e-6)
        assert all(geometry.contains(shapes, *x) == y for x, y in zip(points, inside, strict=True))
    assert overlay.dissolved(df.where(F.lit(False)), "g", 3.0).count() == 0


def test_countries_of_a_sub_region_merge(spark):
    rows = [("north", shape("box", x, 10, 2)) for x in (0, 2, 4)] + [("south", shape("box", 0, 0, 3)), ("other", shape("box", 9, 9, 1))]
    intervals = spark.createDataFrame([("north", 1.0, 2.0, 3.0, 4.0), ("south", 5.0, 6.0, 7.0, 8.0)], "category string, p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double")
    countries = spark.createDataFrame(rows, "subregion string, geom binary")
    assert zonal.sub_regions(countries, intervals).count() == 4
    merged = {r.region: (geometry.rings_of(bytes(r.geom))[1], r.p_lower_95) for r in zonal.sub_regions(countries, intervals, 4.0).collect()}
    assert set(merged) == {"north", "south"} and [len(x) for p in merged["north"][0] for x in p] == [5] and merged["north"][1] == 1.0


def polygon_area(parts):
    return geometry.area_centre(parts)[0]


def test_crossing_rings_are_untangled(spark):
    bow = geometry.closed([(0, 0), (4, 4), (4, 0), (0, 4)])
    parts = overlay.untangled([bow])
    assert sorted(polygon_area([p]) for p in parts) == [4, 4] and not any(geometry.crosses_itself(r) for p in parts for r in p)
    # A five-pointed star drawn in one stroke: the pentagon in the middle is wound around twice, and kept.
    tips = [(np.cos(a), np.sin(a)) for a in np.pi / 2 + np.arange(5) * 4 * np.pi / 5]
    (star,) = overlay.untangled([geometry.closed(tips)])
    inner = (3 - np.sqrt(5)) / 2  # of the circle through the inner corners
    assert polygon_area([star]) == pytest.approx(5 * inner * np.sin(np.pi / 5), rel=1e-9) and len(star) == 1 and len(star[0]) == 11
    # A ring that goes around twice, a hole in the second lobe of a bow tie, a hole that crosses the edge.
    twice = geometry.closed([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0), (4, 0), (4, 4), (0, 4)])
    assert polygon_area(overlay.untangled([twice])) == 16
    hole = geometry.closed([(3.2, 1.8), (3.6, 1.8), (3.6, 2.2), (3.2, 2.2)])
    assert polygon_area(overlay.untangled([bow, hole])) == pytest.approx(8 - 0.16)
    assert polygon_area(overlay.untangled([bow, geometry.closed([(3.5, 1.75), (5, 1.75), (5, 2.25), (3.5, 2.25)])])) == pytest.approx(8 - 0.25)
    mended = geometry.rings_of(geometry.repaired(geometry.wkb_of([[geometry.closed([(0, 0), (6, 6), (6, 0), (0, 4)])]])))[1]
    assert len(mended) == 1 and polygon_area(mended) == pytest.approx(10.8)
    df = spark.createDataFrame([(geometry.wkb_of([[bow]]),), (geometry.wkb_of([[geometry.closed(tips)]]),)], "geom binary")
    assert [r.status for r in geometry.described(df.select(geometry.repair(F.col("geom")).alias("geom"))).collect()] == ["ok", "ok"]


@pytest.mark.parametrize("seed", range(5))
def test_random_rings_wind_as_before(seed):
    rng = np.random.default_rng(seed)
    ring = geometry.closed(list(rng.uniform(0, 10, (14, 2))))
    parts = overlay.untangled([ring])

    def winding(x, y):
        a = np.arctan2(ring[:, 1] - y, ring[:, 0] - x)
        return round(((np.diff(a) + np.pi) % (2 * np.pi) - np.pi).sum() / (2 * np.pi))

    points = rng.uniform(0, 10, (1500, 2))
    assert all(geometry.contains(parts, *p) == (winding(*p) != 0) for p in points)


def test_long_rings_are_swept_in_parts():
    angle = np.linspace(0, 2 * np.pi, 3001)[:-1]
    ring = geometry.closed(list(np.stack([10 * np.cos(angle), 10 * np.sin(angle)], 1)))
    assert not geometry.crosses_itself(ring)
    ring[700], ring[701] = ring[701].copy(), ring[700].copy()
    assert geometry.crosses_itself(ring)
    assert polygon_area(overlay.untangled([ring])) == pytest.approx(100 * np.pi, rel=1e-4)
    big = geometry.closed(list(np.random.default_rng(1).uniform(0, 1, (60, 2)) + np.arange(60)[:, None]))
    (i, j), want = zip(*[x for x in geometry.near_pairs(np.hstack([big[:-1], big[1:]]))], strict=True), set()
    e = np.hstack([big[:-1], big[1:]])
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    for a in range(60):
        for b in range(a):
            if (low[a] <= high[b]).all() and (low[b] <= high[a]).all():
                want.add(frozenset((a, b)))
    assert {frozenset(x) for x in zip(np.concatenate(i).tolist(), np.concatenate(j).tolist(), strict=True)} == want
