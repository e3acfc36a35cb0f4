"""Regression of gaps on the mosaic against plain least squares over every set of free variables."""

from itertools import combinations

import numpy as np
import pytest

from tessera.operators import regression as R


def best_of_all_sets(g, h):
    best, value = np.zeros(len(h)), 0.0
    for n in range(1, len(h) + 1):
        for free in combinations(range(len(h)), n):
            x = np.zeros(len(h))
            x[list(free)] = np.linalg.lstsq(g[np.ix_(free, free)], h[list(free)], rcond=1e-12)[0]
            if (x >= 0).all() and x @ g @ x / 2 - h @ x < value:
                best, value = x, x @ g @ x / 2 - h @ x
    return best, value


@pytest.mark.parametrize("seed", range(8))
def test_solver_reaches_the_best_set(seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(40, 7)) + (seed % 3)
    if seed == 5:
        a[:, 3] = a[:, 2]  # not of full rank
    if seed == 6:
        a[:, 4] = 0
    y = a @ np.maximum(rng.normal(size=7), 0) + rng.normal(size=40) * (0.1 if seed % 2 else 2)
    g, h = a.T @ a, a.T @ y
    x, (want, value) = R.nonnegative(g, h), best_of_all_sets(g, h)
    assert (x >= 0).all() and x @ g @ x / 2 - h @ x <= value + 1e-8 * abs(value)
    if seed not in (5, 6):
        assert x == pytest.approx(want, abs=1e-6)
    assert R.nonnegative(g, -np.abs(h) * 0 - 1).tolist() == [0] * 7


def scene(seed, n=8, images=5):
    rng = np.random.default_rng(seed)
    img = rng.uniform(0.02, 0.6, (images, n, n, 10))
    interp = np.where(rng.random((images, n, n)) < 0.4, rng.uniform(0.2, 1, (images, n, n)), 0.0)
    interp[1], interp[3] = 0, 1  # nothing to fill; nothing clear
    mosaic = rng.uniform(-0.01, 1.2, (n, n, 10))
    return img, interp, mosaic, rng.random((n, n)) < 0.2, rng.integers(0, 3, (n, n)) / 4


def plain_fill(img, interp, mosaic, water, snow):
    """Loops over images and bands; of each fifth the first pixels in the order of (t, r, c)."""
    out, T = img.copy(), len(img)
    for d in range(T):
        gap = interp[d] > 0
        if not gap.any() or gap.all() or (interp[d] < 1).mean() <= 0.01:
            out[d] = np.where(gap[..., None], img[d] * (1 - interp[d][..., None]) + mosaic * interp[d][..., None], img[d])
            continue
        times = range(max(d - (2 if d == T - 1 else 1), 0), min(d + 2, T))
        keep = [(interp[t] == 0) & ~water for t in times]
        y = np.concatenate([img[t][k] for t, k in zip(times, keep, strict=True)])
        x = np.concatenate([np.concatenate([mosaic, snow[..., None]], -1)[k] for k in keep])
        b, r, nir = (np.clip(y[:, i], 0, 1) for i in (0, 2, 3))
        e = np.clip(2.5 * (nir - r) / (nir + 6 * r - 7.5 * b + 1), -1.5, 1.5)
        p = {q: np.percentile(e, q) for q in (2, 20, 40, 60, 80, 98)}
        limits = [-np.inf, p[20], p[40], p[60], p[80], np.inf]
        parts = [np.flatnonzero((e >= a) & (e < z))[: len(e) // 5] for a, z in zip(limits, limits[1:], strict=False)]
        rows = np.concatenate([*parts, *[np.flatnonzero(e < p[2])] * 10, *[np.flatnonzero(e >= p[98])] * 10])
        fit, own = np.zeros_like(mosaic), x[rows].copy()
        for band in range(10):
            train = own.copy()
            own[:, band] = np.clip(own[:, band], 0.005, 1)
            g, h = train.T @ train, train.T @ y[rows, band]
            fit[..., band] = np.concatenate([mosaic, snow[..., None]], -1) @ R.nonnegative(g, h)
        out[d] = np.where(gap[..., None], img[d] * (1 - interp[d][..., None]) + fit * interp[d][..., None], img[d])
    return out


def test_filled_against_a_plain_loop(spark):
    from pyspark.sql import functions as F

    pixel_rows, ground_rows, want = [], [], {}
    for tile in range(3):
        img, interp, mosaic, water, snow = scene(tile)
        done = plain_fill(img, interp, mosaic, water, snow)
        at = [(t, r, c) for t in range(len(img)) for r in range(8) for c in range(8)]
        pixel_rows += [(f"t{tile}", t, r, c, float(interp[t, r, c]), *map(float, img[t, r, c]), "kept") for t, r, c in at]
        ground_rows += [(f"t{tile}", r, c, bool(water[r, c]), float(snow[r, c]), *map(float, mosaic[r, c])) for r in range(8) for c in range(8)]
        want |= {(f"t{tile}", *k): done[k] for k in at}
    doubles = lambda x: ", ".join(f"{x}{i} double" for i in range(10))
    pixels = spark.createDataFrame(pixel_rows, f"tile string, t int, r int, c int, interp double, {doubles('b')}, more string").repartition(3)
    ground = spark.createDataFrame(ground_rows, f"tile string, r int, c int, water boolean, snow double, {doubles('m')}")
    out = R.regression_filled(pixels, ground, order=F.lit(0))
    assert out.columns == pixels.columns
    got = {(r.tile, r.t, r.r, r.c): [r[f"b{i}"] for i in range(10)] for r in out.collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-7)
    assert R.regression_filled(pixels.limit(0), ground).count() == 0


def test_images_that_are_clear_enough_stand_alone(spark, monkeypatch):
    monkeypatch.setattr(R, "ENOUGH", 2)
    clear = {0: 3, 1: 2, 2: 1, 3: 4, 4: 1}
    rows = [("a", t, i, 0, 0.0 if i < n else 0.5) for t, n in clear.items() for i in range(5)]
    found = {}
    for r in R.fitted_images(spark.createDataFrame(rows, "tile string, t int, r int, c int, interp double")).collect():
        found.setdefault(r.date, set()).add(r.t)
    assert found == {0: {0}, 1: {0, 1, 2}, 2: {1, 2, 3}, 3: {3}, 4: {2, 3, 4}}


def test_an_images_rows_are_made_once_for_all_its_cuts(spark):
    pixels = spark.createDataFrame([(0, t, 0, 0, 0.0, *[0.1] * 10) for t in range(3)], "tile int, t int, r int, c int, interp double, " + ", ".join(f"b{i} double" for i in range(10)))
    ground = spark.createDataFrame([(0, 0, 0, False, 0.0, *[0.1] * 10)], "tile int, r int, c int, water boolean, snow double, " + ", ".join(f"m{i} double" for i in range(10)))
    plan = R.samples(pixels, ground)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "percentile_approx" not in plan
