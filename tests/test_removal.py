"""Removal of clouds against its steps called one by one, and pruning with a detector that counts its runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import clouds, regression, removal

KEY = ["tile", "t", "r", "c"]


def scene(spark, images=5, n=16):
    rng = np.random.default_rng(4)
    ground = rng.uniform(0.05, 0.4, (n, n, 10))
    rows = []
    for t in range(images):
        img = ground + rng.normal(0, 0.01, ground.shape)
        cloud = np.zeros((n, n), bool)
        if t == 1:
            cloud[:5, :5] = True
        if t == 3:
            cloud[:] = True
        img[cloud] += 0.5
        rows += [("a", t, r, c, *map(float, img[r, c]), bool(cloud[r, c]), "kept") for r, c in np.ndindex(n, n)]
    bands = ", ".join(f"b{i} double" for i in range(10))
    return spark.createDataFrame(rows, f"tile string, t int, r int, c int, {bands}, cloud boolean, more string").repartition(4)


def values(df, key, columns):
    return {tuple(r[k] for k in key): [r[c] for c in columns] for r in df.collect()}


def test_steps_one_by_one(spark):
    pixels = scene(spark)
    false = spark.createDataFrame([("a", 9, 9)], "tile string, r int, c int")
    out = removal.removed(pixels, false, F.lit(0))
    assert out["pixels"].columns == [*pixels.columns, "interp"]
    weighted = clouds.interpolation_weights(pixels, "cloud", 20)
    one = {}
    for i in range(10):
        single = clouds.aligned_mosaic(weighted.select("tile", "t", "r", "c", "interp", F.col(f"b{i}").alias("v")))
        one[i] = values(single, ["tile", "r", "c"], ["v"])
    mosaic = values(out["mosaic"], ["tile", "r", "c"], [f"m{i}" for i in range(10)])
    assert all(m == pytest.approx([one[i][k][0] for i in range(10)], abs=1e-12) for k, m in mosaic.items()) and len(mosaic) == 256
    ground = out["mosaic"].join(regression.places(weighted), ["tile", "r", "c"])
    blended = values(regression.regression_filled(weighted, ground, F.lit(0)), KEY, removal.BANDS)
    got = values(out["pixels"], KEY, removal.BANDS)
    assert set(got) == set(blended) and all(got[k] == pytest.approx(blended[k], abs=1e-9) for k in got)
    left = values(removal.left_over(weighted, out["mosaic"], false), ["tile", "r", "c"], ["cloud"])
    weight, final = values(weighted, KEY, ["interp"]), values(out["pixels"], KEY, ["interp"])
    assert all(final[k][0] == pytest.approx(min(1, weight[k][0] + left[k[0], k[2], k[3]][0])) for k in final)
    assert [tuple(r) for r in out["dropped"].collect()] == [("a", 3)]
    # Clear images stay as they are, clouds come down to the ground.
    before = values(pixels, KEY, removal.BANDS)
    assert all(got[k] == before[k] for k in got if k[1] in (0, 2, 4))
    assert max(max(got["a", 1, r, c]) for r in range(5) for c in range(5)) < 0.5


def test_even_closings_like_the_two_windows(spark):
    rng = np.random.default_rng(1)
    n = 30
    flag = rng.random((n, n)) < 0.01
    rows = [("a", 0, r, c, bool(flag[r, c])) for r, c in np.ndindex(n, n)]
    got = values(clouds.interpolation_weights(spark.createDataFrame(rows, "tile string, t int, r int, c int, cloud boolean"), "cloud", 20), ["r", "c"], ["interp"])
    at = np.argwhere(flag)
    d = np.array([[min(12, np.hypot(*(at - [r, c]).T).min()) for c in range(n)] for r in range(n)])
    soft = np.where(1 - d / 12 < 0.2, 0, 1 - d / 12)
    top = np.array([[soft[max(r - 9, 0) : r + 11, max(c - 9, 0) : c + 11].max() for c in range(n)] for r in range(n)])
    want = np.array([[top[max(r - 10, 0) : r + 10, max(c - 10, 0) : c + 10].min() for c in range(n)] for r in range(n)])
    assert all(got[r, c][0] == pytest.approx(want[r, c]) for r, c in np.ndindex(n, n))


def test_pruning_runs_the_detector_once_a_round(spark):
    rows = [("a", t, r, 0, float(t)) for t in range(6) for r in range(4)] + [("b", t, r, 0, 9.0) for t in range(3) for r in range(4)]
    pixels, runs = spark.createDataFrame(rows, "tile string, t int, r int, c int, v double"), []

    def detect(df):
        # An image is bad if it is the brightest of its tile that is over 3; what is left changes from round to round.
        runs.append(1)
        top = df.groupBy("tile").agg(F.max("v").alias("top"))
        return df.join(top, "tile").select("tile", "t", "r", "c", ((F.col("v") == F.col("top")) & (F.col("v") > 3)).cast("double").alias("interp"))

    left, found = clouds.pruned(pixels, detect)
    assert {(r.tile, r.t) for r in left.collect()} == {("a", t) for t in range(4)} | {("b", t) for t in range(3)}
    assert {(r.tile, r.t) for r in found.collect()} == {(r.tile, r.t) for r in left.collect()}
    assert len(runs) == 3 and found.where("interp > 0 and tile = 'a'").count() == 0
    found.count()
    assert len(runs) == 3
