"""The plan of polygons of several years: first matches, repeated keys, parts, repairs, against the steps one by one."""

import math

import pytest

from tessera.operators import geometry
from tessera.plans import report


def ring(*points):
    return geometry.closed(points)


def test_polygons_of_two_years(spark):
    square = [[ring((1, 1), (4, 1), (4, 4), (1, 4))]]
    two = [[ring((0, 0), (2, 0), (2, 2), (0, 2))], [ring((5, 5), (8, 5), (8, 8), (5, 8))]]
    bow = [[ring((0, 0), (4, 4), (4, 0), (0, 3))]]
    rows = [
        ("a", 2020, 0, geometry.wkb_of(square), 0.3, "urban"), ("a", 2021, 1, geometry.wkb_of(square), 9.0, "forest"), ("b", 2020, 2, geometry.wkb_of(two), 2.0, None),
        ("c", 2020, 3, geometry.wkb_of(bow), 2.0, "forest"), ("d", None, 4, geometry.wkb_of(square), 1.0, "forest"), ("e", 2020, 5, b"xx", 1.0, "forest"), ("f", 2021, 6, None, 1.0, "forest"), ("g", 1999, 7, geometry.wkb_of(square), 1.0, "forest"),
    ]
    polygons = spark.createDataFrame(rows, "poly_uuid string, year int, place int, geom binary, area double, category string")
    value = lambda year, r, c: 10 + r + 2 * c + (30 if year == 2021 else 0)
    pixels = spark.createDataFrame([(y, r, c, value(y, r, c)) for y in (2020, 2021) for r in range(10) for c in range(10)], "year int, r int, c int, u8 int")
    intervals = spark.createDataFrame([("forest", 0.9, 0.95, 0.88, 0.97), ("urban", 0.7, 0.9, 0.6, 0.95)], "category string, p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double")
    everywhere = geometry.wkb_of([[ring((-1, -1), (4.5, -1), (4.5, 4.5), (-1, 4.5))]])
    regions = spark.createDataFrame([(1, everywhere, 0.8, 0.9, 0.7, 0.95)], "place int, geom binary, p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double")
    got = {(r.poly_uuid, r.year, r.place, r.part_idx): r for r in report.polygon_statistics(polygons, pixels, intervals, regions, 0.5).collect()}
    assert set(got) == {("a", 2020, 0, 0), ("a", 2021, 1, 0), ("b", 2020, 2, 0), ("b", 2020, 2, 1), ("c", 2020, 3, 0), ("g", 1999, 7, 0)}

    def mean(year, x0, x1, dx=0.0, dy=0.0):
        total = weight = 0
        for r in range(10):
            for c in range(10):
                part = max(min(x1 + dx, c + 1) - max(x0 + dx, c), 0) * max(min(x1 + dy, r + 1) - max(x0 + dy, r), 0)
                if part >= 0.05:
                    total, weight = total + part * value(year, r, c), weight + part
        return total / weight

    for key, x0, x1, area, small, lo, hi in ((("a", 2020, 0, 0), 1, 4, 0.3, 16.68, 0.9 - 0.6, 0.95 - 0.7), (("a", 2021, 1, 0), 1, 4, 0.3, 23.468, 0.9 - 0.6, 0.95 - 0.7), (("b", 2020, 2, 0), 0, 2, 2.0, 0, 0.95 - 0.88, 0.97 - 0.9), (("b", 2020, 2, 1), 5, 8, 2.0, 0, 0.95 - 0.88, 0.97 - 0.9)):
        ttc = mean(key[1], x0, x1)
        shift = math.sqrt(sum((mean(key[1], x0, x1, dx / 2, dy / 2) / ttc - 1) ** 2 for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy) / 8)
        inside = key[0] == "a"  # of the multipolygon, the centre of both parts is outside
        common = shift**2 / 4 + (small / ttc) ** 2 / 4
        r = got[key]
        assert (r.ttc, r.area) == pytest.approx((ttc, area))  # the first row of the key says the area
        assert r.error_minus == pytest.approx(ttc * math.sqrt(common + (lo / ttc) ** 2 + (((0.9 - 0.7) / ttc) ** 2 if inside else 0)))
        assert r.error_plus == pytest.approx(ttc * math.sqrt(common + (hi / ttc) ** 2 + (((0.95 - 0.8) / ttc) ** 2 if inside else 0)))
    assert got["a", 2021, 1, 0].category == "urban" and got["g", 1999, 7, 0].ttc is None and got["c", 2020, 3, 0].ttc is not None
    assert report.polygon_statistics(polygons.limit(0), pixels, intervals, regions, 0.5).count() == 0


def test_details_that_repeat_a_key(spark):
    boxes = spark.createDataFrame([("a", 1.0, 1.0, 4.0, 4.0)], "k string, x0 double, y0 double, x1 double, y1 double")
    pixels = spark.createDataFrame([(r, c, 50) for r in range(6) for c in range(6)], "r int, c int, u8 int")
    details = spark.createDataFrame([("a", 2, 9.0, "urban", 2.0, 2.0), ("a", 1, 5.0, "forest", 2.0, 2.0), ("a", 3, 1.0, "urban", 2.0, 2.0)], "k string, place int, area double, category string, x double, y double")
    intervals = spark.createDataFrame([("forest", 0.9, 0.95, 0.88, 0.97)], "category string, p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double")
    regions = spark.createDataFrame([], "place int, geom binary, p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double")
    (row,) = report.statistics(boxes, pixels, "k", details, intervals, regions, 0.5).collect()
    assert (row.area, row.category, row.ttc) == (5.0, "forest", 50.0)
