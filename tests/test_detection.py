"""Clouds by comparison in time against plain loops on scenes of 16 x 16 pixels and twelve images."""

import numpy as np
import pytest

from tessera.operators import detection as D


def scene(seed, images=12, n=16):
    rng = np.random.default_rng(seed)
    img = rng.uniform(0.02, 0.12, (n, n, 3))[None] + rng.normal(0, 0.01, (images, n, n, 3))
    for _ in range(14):
        t, r, c, size = rng.integers(images), rng.integers(n), rng.integers(n), rng.integers(2, 7)
        img[t, r : r + size, c : c + size] += rng.choice([0.06, 0.09, 0.2, 0.4, 0.9]) * rng.uniform(0.8, 1.2, 3)
    img[3 % images] += 0.14  # brighter as a whole
    img[7 % images] = img[7 % images] * 0.2 + 0.11  # haze
    shadow = rng.random((images, n, n)) < 0.15
    shadow[:, 2, 2] = True
    shadow[4:9, 5, :] = True
    return np.clip(img, 0.001, None), shadow, rng.random((n, n)) < 0.3, np.where(rng.random((n, n)) < 0.2, 0.3, -0.2)


def plain_near_window(t, n):
    """The images near t, then ever more of them, by walking outwards."""
    near = [t - 1, t + 1]
    if t == 0:
        near = [1, 2]
    if t == n - 1:
        near = [n - 3, n - 2]
    if near[1] in (n - 2, n - 1) and n > 3:
        near.insert(0, near[0] - 1)
    yield near
    first, last = near[0], near[-1]
    for _ in range(10):
        first, last = max(first - 1, 0), min(last + 1, n)
        yield [k for k in range(first, last) if k != t]


def plain_scores(img, shadow, woods):
    n, size = len(img), img.shape[1]
    far, score = np.zeros(shadow.shape, bool), np.zeros(shadow.shape)
    for t in range(n):
        around = range(0, 5) if t == 0 else range(n - 5, n) if t == n - 1 else range(t - 2, t + 3)
        for r in range(size):
            for c in range(size):
                seen = [img[k, r, c] for k in around if 0 <= k < n and not shadow[k, r, c]]
                upper = np.min(seen, 0) if seen else np.percentile(img[:, r, c], 25, axis=0)
                for ks in plain_near_window(t, n):
                    some = [img[k, r, c] for k in ks if not shadow[k, r, c]]
                    if some:
                        near = np.min(some, 0)
                        break
                else:
                    near = img[:, r, c].min(0)
                limit = max(min(near[0] / 0.02 / 100 + 0.005, 0.10), 0.05) - (0.02 if woods[r, c] else 0)
                limit = max(limit, 0.04)
                d = img[t, r, c] - near
                far[t, r, c] = bool((img[t, r, c] - upper > [0.08, 0.08, 0.07]).all())
                score[t, r, c] = min(d[0] - limit - 0.01, d[1] - limit - 0.01, d[2] - limit)
    return far, score


def plain_levels(far, score):
    out = np.zeros(far.shape, bool)
    for t in range(len(far)):
        level = 0
        while (score[t] > level * 0.0025).mean() - far[t].mean() > 0.075:
            level += 1
        out[t] = score[t] > level * 0.0025
    return out


def shrunk(mask, n):
    """Flagged pixels all of whose neighbours within n steps inside the image are flagged."""
    size = mask.shape[0]
    near = [(i, j) for i in range(-n, n + 1) for j in range(-n, n + 1) if abs(i) + abs(j) <= n]
    return np.array([[all(mask[r + i, c + j] for i, j in near if 0 <= r + i < size and 0 <= c + j < size) for c in range(size)] for r in range(size)])


def plain_outliers(img, cloud, shadow, water):
    new = np.zeros(cloud.shape, bool)
    for t in range(len(img)):
        total = img[t].sum(-1)
        clear = total[~cloud[t] & ~shadow[t]]
        if not len(clear):
            continue
        ratio = np.where(water > 0, 1.0, total / np.median(clear))
        base = ratio if cloud[t].all() else ratio[~cloud[t]]
        new[t] = (ratio - base.mean() > 3.5 * base.std()) & (water < 0) & ~cloud[t]
    return cloud | (new & (new.sum(0) == 1))


def plain_haze(img, cloud):
    stats = {t: (img[t][~cloud[t]].mean(-1).mean(), img[t][~cloud[t]].mean(-1).std(), np.ptp(img[t][~cloud[t]], axis=-1).std()) for t in range(len(img)) if not cloud[t].all()}
    middle = np.median(list(stats.values()), axis=0)
    over = {t: np.array(s) / middle for t, s in stats.items()}
    return {t for t, (m, s, c) in over.items() if (m >= 1.5 and s <= 0.67 and c < 1) or (m >= 1.3 and s <= 0.5)}


def tables(spark, scenes):
    pixels, ground = [], []
    for k, (img, shadow, woods, water) in enumerate(scenes):
        pixels += [(f"t{k}", t, r, c, *map(float, img[t, r, c]), bool(shadow[t, r, c])) for t, r, c in np.ndindex(shadow.shape)]
        ground += [(f"t{k}", r, c, int(woods[r, c]), float(water[r, c])) for r, c in np.ndindex(woods.shape)]
    return spark.createDataFrame(pixels, "tile string, t int, r int, c int, b0 double, b1 double, b2 double, shadow boolean").repartition(4), spark.createDataFrame(ground, "tile string, r int, c int, woods int, water double")


def arrays(rows, shape, tile, *columns):
    out = [np.zeros(shape, bool if c != "score" else float) for c in columns]
    for r in rows:
        if r.tile == tile:
            for a, c in zip(out, columns, strict=True):
                a[r.t, r.r, r.c] = r[c]
    return out


def test_each_step_and_all_against_loops(spark):
    scenes = [scene(1), scene(2), scene(3, images=4)]
    pixels, ground = tables(spark, scenes)
    scored = D.rising(pixels, ground)
    near_rows = D.levelled(scored).collect()
    end = D.clouds_in_time(pixels, ground)
    assert end.columns == [*pixels.columns, "cloud"]
    end_rows, changed = end.collect(), 0
    for k, (img, shadow, woods, water) in enumerate(scenes):
        far, score = plain_scores(img, shadow, woods)
        got_far, got_score, got_near = arrays(near_rows, shadow.shape, f"t{k}", "far", "score", "near")
        assert (got_far == far).all() and got_score == pytest.approx(score, abs=1e-12)
        near = plain_levels(far, score)
        assert (got_near == near).all()
        changed += (near != (score > 0)).any()
        close = near & (img.sum(-1) < 0.75)
        cloud = far | np.array([np.where(woods, x, shrunk(x, 2)) for x in close])
        cloud = plain_outliers(img, cloud, shadow, water)
        mean = img.mean(-1)
        cloud &= ~((mean < 0.4) & (np.ptp(img, axis=-1) / mean > 0.5))
        haze = plain_haze(img, cloud)
        for t in haze:
            cloud[t] = True
        (got,) = arrays(end_rows, shadow.shape, f"t{k}", "cloud")
        assert (got == cloud).all() and cloud.any() and not cloud.all()
        if k < 2:
            assert 7 in haze
    assert changed >= 2  # levels above 0


def test_few_images_and_none(spark):
    img, shadow, woods, water = scene(5, images=2)
    pixels, ground = tables(spark, [(img, shadow, woods, water)])
    least = img.min(0)
    got = {(r.t, r.r, r.c): r.far for r in D.rising(pixels, ground).collect()}
    assert all(got[t, r, c] == bool((img[t, r, c] - least[r, c] > [0.08, 0.08, 0.07]).all()) for t, r, c in np.ndindex(shadow.shape))
    assert D.clouds_in_time(pixels.limit(0), ground).count() == 0
    assert [x for n in (3, 4, 5, 9) for around, layers in D.compared_images(n) for x in (*around, *layers[0]) if not 0 <= x < n] == []
