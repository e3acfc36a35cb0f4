"""A radar band against a plain loop over pixels, with and without each of its tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import radar

H, W, LOOK = 7, 9, math.pi / 2


def points(spark, rows):
    return spark.createDataFrame([(line, pixel, None if v is None else float(v)) for line, pixel, v in rows], "line int, pixel int, value double")


def bilinear(grid, r, c):
    lines, pixels = sorted({p[0] for p in grid}), sorted({p[1] for p in grid})
    at = {(a, b): v for a, b, v in grid}
    i = max(k for k in range(len(lines) - 1) if lines[k] <= r or k == 0)
    j = max(k for k in range(len(pixels) - 1) if pixels[k] <= c or k == 0)
    y, x = (r - lines[i]) / (lines[i + 1] - lines[i]), (c - pixels[j]) / (pixels[j + 1] - pixels[j])
    a, b = (at[lines[k], pixels[j]] * (1 - x) + at[lines[k], pixels[j + 1]] * x for k in (i, i + 1))
    return a * (1 - y) + b * y


@pytest.mark.parametrize("used", ["", "c", "cn", "t", "ti", "cnti"])
def test_band_against_a_loop(spark, used):
    rng = np.random.default_rng(len(used))
    dn = rng.integers(0, 400 if "c" in used else 2, (H, W))
    slope, aspect = rng.uniform(0, 1.3, (H, W)), rng.uniform(0, 6, (H, W))
    lut, noise = [(0, 1, 350), (3, 7, 500), (6, 0, 420), (50, 1, 1), (2, 2, 0)], [(0, 0, 900), (6, 8, 2500)]
    degrees = [(a, b, 30 + a + b / 2) for a in (0, 4, 9) for b in (0, 5, 10)]
    image = spark.createDataFrame([(r, c, int(dn[r, c])) for r, c in np.ndindex(H, W)], "r int, c int, dn int")
    terrain = spark.createDataFrame([(r, c, float(slope[r, c]), float(aspect[r, c])) for r, c in np.ndindex(H, W) if (r, c) != (5, 5)], "r int, c int, slope double, aspect double")
    tables = {"calibration": points(spark, lut) if "c" in used else None, "noise": points(spark, noise) if "n" in used else None, "incidence": points(spark, degrees) if "i" in used else None, "terrain": terrain if "t" in used else None}
    got = {(r.r, r.c): r.v for r in radar.terrain_corrected(image, H, W, F.lit(LOOK), **tables, angle=38.0).collect()}
    nearest = lambda table, r, c: min((((r - a) ** 2 + (c - b) ** 2, b, a), v) for a, b, v in table if v > 0 and a < H and b < W)[1]
    for r, c in np.ndindex(H, W):
        g = float(dn[r, c])
        if "c" in used:
            g = max(g * g - (nearest(noise, r, c) if "n" in used else 0), 0) / nearest(lut, r, c) ** 2
        if "t" in used and (r, c) != (5, 5):
            theta = math.radians(bilinear(degrees, r, c) if "i" in used else 38.0)
            local = math.cos(slope[r, c]) * math.cos(theta) + math.sin(slope[r, c]) * math.sin(theta) * math.cos(aspect[r, c] - LOOK)
            g = g * math.cos(theta) / local if local >= 0.2 else 0
        assert abs(got[r, c] - min(max(g, 0), 1) * 65535) <= 1
