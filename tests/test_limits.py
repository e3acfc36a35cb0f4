"""Values on the limits of squares, of whole numbers and of parts that count."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import clouds, geometry, radar, raster, zonal


def test_points_on_a_squares_side_are_found(spark):
    """A cut's points lie on the line of the cut exactly, so a point on it stays in the piece."""
    shape = geometry.closed([(0.3, 0.3), (5500.3, 0.3), (5500.3, 10500.3), (0.3, 10500.3)])
    for limit in np.arange(500.0, 10500.0, 500.0):
        cut = geometry.cut_to([[shape]], -np.inf, limit, np.inf, limit + 500)[0][0]
        assert set(cut[:, 1]) <= {limit, min(limit + 500, 10500.3)}
    regions = spark.createDataFrame([("west", geometry.wkb_of([[shape]]))], "place string, geom binary")
    points = spark.createDataFrame([(k, 155.5, 500.0 * k) for k in range(1, 21)], "k int, x double, y double")
    assert {r.place for r in zonal.first_region(points, regions, "k").collect()} == {"west"}


def test_a_band_counts_whole_numbers_whole(spark):
    """3 / 65535 * 65535 and the like are whole numbers, whatever the last bits say."""
    rows = [(0, c, (c + 1) / 65535 - 1e-12) for c in range(200)]
    image = spark.createDataFrame(rows, "r int, c int, dn double")
    assert {r.c: r.v for r in radar.terrain_corrected(image, 1, 200, F.lit(0.0)).collect()} == {c: c + 1 for c in range(200)}


def test_lines_are_read_from_both_ends(spark):
    """A window up to all that follows is reckoned anew for each row, which is quadratic in a line's length."""
    pixels = spark.range(12).select(F.lit(0).alias("tile"), F.lit(0).alias("t"), F.lit(0).alias("r"), F.col("id").cast("int").alias("c"), F.col("id").isin(2, 9).alias("f"))
    points = spark.createDataFrame([(0, 0, 1.0)], "line int, pixel int, v double")
    found = raster.cross_distance(pixels, "f", "steps"), clouds.nearness(pixels, "f", 3, "near"), radar.nearest_values(points, "v", 2, 2)
    for df in found:
        assert "unboundedfollowing" not in df._jdf.queryExecution().analyzed().toString().lower()
    assert [r.steps for r in found[0].orderBy("c").collect()] == [2, 1, 0, 1, 2, 3, 3, 2, 1, 0, 1, 2]
    assert [round(r.near, 6) for r in found[1].orderBy("c").limit(4).collect()] == [0.333333, 0.666667, 1.0, 0.666667]
