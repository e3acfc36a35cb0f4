"""All steps that find clouds and shadows against plain loops on scenes of 16 x 16 pixels and twelve images."""

import numpy as np
import pytest
from test_detection import plain_haze, plain_levels, plain_outliers, plain_scores

from tessera.operators import clouds
from tessera.operators import detection as D

N, T = 16, 12


def scene(seed):
    rng = np.random.default_rng(seed)
    img = rng.uniform(0.08, 0.3, (N, N, 10))[None] * rng.uniform(0.9, 1.1, (T, N, N, 10))
    img[..., 3] = img[..., 3] * 0.8 + 0.12
    img[..., 8] = img[..., 8] * 0.6 + 0.1
    water = np.zeros((N, N), bool)
    water[:4, 10:] = True
    img[:, water] = rng.uniform(0.5, 1.5, (T, water.sum(), 1)) * np.array([0.1, 0.12, 0.08, 0.04, 0.04, 0.04, 0.04, 0.04, 0.05, 0.04])
    for _ in range(18):
        t, r, c, size = rng.integers(T), rng.integers(N), rng.integers(N), rng.integers(2, 9)
        img[t, r : r + size, c : c + size] += rng.choice([0.1, 0.3, 0.5, 0.7])
    for _ in range(14):
        t, r, c, size = rng.integers(T), rng.integers(N), rng.integers(N), rng.integers(4, 9)
        img[t, r : r + size, c : c + size] *= rng.choice([0.1, 0.2, 0.3])
    img[5] = img[5] * 0.1 + 0.35
    metres, woods, urban = rng.choice([0, 10, 26, 200], (N, N)), rng.random((N, N)) < 0.3, np.zeros((N, N), bool)
    urban[12:14, 2:4] = seed % 2
    return img, metres.astype(float), woods, urban


def steps(flag):
    """L1 distance to the nearest flagged pixel of an image."""
    at = np.argwhere(flag)
    return np.array([[np.abs(at - [r, c]).sum(1).min() if len(at) else 999 for c in range(N)] for r in range(N)])


def grow(flag, n):
    return steps(flag) <= n


def shrink(flag, n):
    return ~grow(~flag, n)


def disk(flag, n):
    at = np.argwhere(flag)
    return np.array([[bool(len(at)) and (((at - [r, c]) ** 2).sum(1).min() <= n * n) for c in range(N)] for r in range(N)])


def around(flag):
    mirrored = np.pad(flag.astype(int), 1, mode="reflect")
    return sum(mirrored[1 + i : N + 1 + i, 1 + j : N + 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1))


def in_time(flags, n):
    far = np.array([steps(f) for f in flags])
    return np.array([np.any([far[k] + abs(k - t) <= n for k in range(T) if abs(k - t) <= n], axis=0) for t in range(T)])


def plain_shadows(img, water, metres):
    cloudy = (img[..., 7] > 0.166) & (img[..., 1] > 0.28) & (img[..., 5] / img[..., 8] < 4.292)
    cloudy = np.array([grow(shrink(x, 2), 10) for x in cloudy])
    out = np.zeros((T, N, N), bool)
    bands = [0, 1, 7, 8]
    for t, r, c in np.ndindex(out.shape):
        window = range(0, 4) if t == 0 else range(max(t - 4, 0), min(t + 3, T))
        clear = [img[k, r, c, bands] for k in window if not cloudy[k, r, c]]
        every = [img[k, r, c, bands] for k in range(T) if not cloudy[k, r, c]]
        x = img[t, r, c, bands]
        middle = np.median(clear, 0) if clear else img[:, r, c][:, bands].min(0)
        whole = np.median(every, 0) if every else np.median(img[:, r, c][:, bands], 0)
        if water[r, c] > 0:
            out[t, r, c] = x[0] - whole[0] < -0.05 and x[1] - whole[1] < -0.05 and x[2] < 0.03 and whole[1] - x[1] > 0.02
            continue
        low = x[2] - middle[2] < -0.04 and x[3] - middle[3] < -0.04 and x[0] - middle[0] < -0.02 and x[0] < 0.09 and x[2] < 0.17
        far = bool(clear) and x[2] - np.max(clear, 0)[2] < -0.04 and x[3] - np.max(clear, 0)[3] < -0.04
        deep = far and x[0] < 0.03 and x[2] < 0.18
        steep = far and x[0] < 0.07 and x[2] < 0.18 and img[t, r, c, :3].sum() < 0.28 and metres[r, c] >= 25
        out[t, r, c] = low or deep or steep
    return np.array([disk(grow(shrink(x, 2), 3), 5) for x in out])


def plain_identified(img, metres, woods, candidate, false):
    water = np.median((img[..., 1] - img[..., 3]) / (img[..., 1] + img[..., 3]), 0)
    vis = img[..., :3]
    shadow = plain_shadows(img, water, metres)
    far, score = plain_scores(vis, shadow, woods)
    close = plain_levels(far, score) & (vis.sum(-1) < 0.75)
    cloud = far | np.array([np.where(woods, x, shrink(x, 2)) for x in close])
    cloud = plain_outliers(vis, cloud, shadow, water)
    cloud &= ~((vis.mean(-1) < 0.4) & (np.ptp(vis, axis=-1) / vis.mean(-1) > 0.5))
    steady = np.array([vis[t].mean(-1) - vis[max(t - 1, 0) : t + 2].min((0, 3)) < 0.4 for t in range(T)])
    cloud &= ~(false & steady)
    shadow &= ~(false & steady)
    bare = in_time(img[..., 3] / (img[..., 8] + 0.01) < 0.75, 3) & (water >= 0)
    cloud &= ~(bare & steady)
    for t in range(T):
        cloud[t] &= ~grow((water > 0) & (img[t, ..., 8] < 0.11), 10)
        cloud[t] &= around(cloud[t]) >= 5
        cloud[t] &= ~(grow(vis[t].sum(-1) < 0.21, 3) & ~woods)
    weight = np.zeros((T, N, N), int)
    for t in range(T):
        core, town = shrink(cloud[t], 1), grow(candidate[t], 5)
        urban, free = shrink(core & town, 3), core & ~town
        many = around(free)
        free = disk(grow(free & (many >= 6), 5) | grow(free & (many < 6), 1), 3)
        weight[t] = free.astype(int) + urban
        if (shadow[t].mean() > weight[t].mean() + 0.3 and weight[t].mean() < 0.3) or (weight[t].mean() < 0.05 and shadow[t].mean() > 3 * weight[t].mean()):
            shadow[t] &= grow(weight[t] > 0, 50) | (metres >= 30)
    weight = np.maximum(weight, shadow)
    out = weight > 0
    for t in range(T):
        if weight[t].mean() < 0.9:
            inverse = 1 / img[t, ..., 0][weight[t] == 0]
            deep = (1 / img[t, ..., 0] > inverse.mean() + 2 * inverse.std()) & (img[t, ..., 7] < 0.17)
            out[t] |= grow(shrink(deep, 2), 2) & ~(water > 0)
    for t in plain_haze(vis, out):
        out[t] = True
    return shadow, out, in_time(false | bare, 2)


@pytest.fixture(scope="module")
def tables(spark):
    scenes = [scene(1), scene(2), scene(3)]
    pixels, ground = [], []
    for k, (img, metres, woods, urban) in enumerate(scenes):
        pixels += [(f"t{k}", t, r, c, *map(float, img[t, r, c])) for t, r, c in np.ndindex(T, N, N)]
        ground += [(f"t{k}", r, c, float(metres[r, c]), int(woods[r, c]), int(urban[r, c])) for r, c in np.ndindex(N, N)]
    bands = ", ".join(f"b{i} double" for i in range(10))
    pixels = spark.createDataFrame(pixels, f"tile string, t int, r int, c int, {bands}").repartition(4)
    return scenes, pixels, spark.createDataFrame(ground, "tile string, r int, c int, elevation double, woods int, urban int")


def arrays(rows, tile, *columns):
    out = [np.zeros((T, N, N), bool) for _ in columns]
    for r in rows:
        if r.tile == tile:
            for a, c in zip(out, columns, strict=True):
                a[r.t, r.r, r.c] = r[c]
    return out


def test_all_steps_against_loops(spark, tables):
    scenes, pixels, ground = tables
    wrong = clouds.false_positives(pixels, ground).collect()
    found = D.identified(pixels, ground)
    assert found.columns == [*pixels.columns, "cloud", "false_cloud"]
    rows, seen = found.collect(), np.zeros(2)
    for k, (img, metres, woods, _) in enumerate(scenes):
        candidate, false = arrays(wrong, f"t{k}", "candidate", "false_cloud")
        _, cloud, fcp = plain_identified(img, metres, woods, candidate, false)
        got, got_fcp = arrays(rows, f"t{k}", "cloud", "false_cloud")
        assert (got == cloud).all() and (got_fcp == fcp).all()
        seen += [cloud.mean(), (~cloud).mean()]
    assert (seen > 0.15).all()


def test_shadows_alone(spark, tables):
    scenes, pixels, ground = tables
    water = pixels.groupBy("tile", "r", "c").agg(D.F.median(D.normalised_difference(D.F.col("b1"), D.F.col("b3"))).alias("water"))
    dark = D.shaded(clouds.bright_clouds(pixels, D.FIRST_GREEN), ground.join(water, ["tile", "r", "c"]))
    rows = D.disked(clouds.opened(dark, "shadow", 2, 3), "shadow", 5).collect()
    for k, (img, metres, _, _) in enumerate(scenes):
        want = plain_shadows(img, np.median((img[..., 1] - img[..., 3]) / (img[..., 1] + img[..., 3]), 0), metres)
        (got,) = arrays(rows, f"t{k}", "shadow")
        assert (got == want).all() and want.any()
