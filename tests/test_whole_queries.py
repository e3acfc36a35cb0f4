"""Queries over whole tables: nothing is left out that a query over a part leaves out."""

import math
from datetime import timedelta
from statistics import median

import pytest

from tessera.fixtures import view
from tessera.queries import QUERIES, pixels


def test_zonal_queries_see_every_tile(spark, sf):
    patch = {(r.tile, r.r, r.c): r.u8 for r in view(spark, sf, "v_patch").collect()}
    side = math.ceil(math.sqrt(max(t for t, _, _ in patch) + 1))
    want = {(t // side * 8 + r, t % side * 8 + c): 255 if u % 17 == 0 else u for (t, r, c), u in patch.items()}
    assert len(want) == len(patch) == 64 * 500
    got = pixels.site_raster(spark, sf).collect()
    assert {(r.r, r.c): r.u8 for r in got} == want and len(got) == len(want)
    boxes = pixels.site_boxes(spark, sf).collect()

    def mean(b, dx=0.0, dy=0.0):
        x0, x1, y0, y1 = b.x0 + dx, b.x1 + dx, b.y0 + dy, b.y1 + dy
        total = weight = 0
        for r in range(math.floor(y0), math.ceil(y1)):
            for c in range(math.floor(x0), math.ceil(x1)):
                part = max(min(x1, c + 1) - max(x0, c), 0) * max(min(y1, r + 1) - max(y0, r), 0)
                if part >= 0.05 and want.get((r, c), 255) != 255:
                    total, weight = total + part * want[r, c], weight + part
        return total / weight if weight else None

    means = {b.k: mean(b) for b in boxes}
    found = {r.k: r.ttc for r in QUERIES["zonal_mean"](spark, sf).collect()}
    assert found == pytest.approx({k: m for k, m in means.items() if m is not None}, abs=2e-6)
    errors = {r.k: (r.ttc, r.shift_error) for r in QUERIES["shift_error"](spark, sf).collect()}
    assert set(errors) == set(found) == {r.k for r in QUERIES["error_propagation"](spark, sf).collect()}
    for b in boxes[:200]:
        if means[b.k]:
            moved = [mean(b, dx / 2, dy / 2) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy]
            assert errors[b.k] == pytest.approx((means[b.k], math.sqrt(sum((m / means[b.k] - 1) ** 2 for m in moved if m is not None) / 8)), abs=2e-6)


def test_every_label_has_its_multipliers(spark, sf):
    rows = pixels.predictions(spark, sf).collect()
    at, off = {}, {}
    for r in rows:
        at.setdefault((r.label, r.r, r.c), []).append(r.p)
    for r in rows:
        x = at[r.label, r.r, r.c]
        if len(x) > 1:
            off.setdefault((r.label, r.w), []).append(abs((sum(x) - r.p) / (len(x) - 1) - r.p))
    ratio = {k: sum(x) / len(x) for k, x in off.items()}
    windows = {(r.label, r.w) for r in rows}
    want = {}
    for label in {k for k, _ in windows}:
        own = [x for (k, _), x in ratio.items() if k == label]
        for k, w in windows:
            if k == label:
                want[k, w] = min(median(own) / ratio[k, w], 1.5) if (k, w) in ratio and min(own) > 0 else 1.0
    got = QUERIES["window_agreement"](spark, sf).collect()
    assert len(got) == len(want) == 500 and len({r.label for r in got}) == 10
    assert {(r.label, r.w): r.multiplier for r in got} == pytest.approx(want, abs=2e-6)


def test_every_step_is_looked_up(spark, sf):
    by = {}
    rows = view(spark, sf, "v_scenes").collect()
    for r in rows:
        by.setdefault((r.tile, r.acquired), []).append(r)
    want = {}
    for tile, step in {(r.tile, r.acquired + timedelta(r.scene_id % 5)) for r in rows}:
        near = sorted((abs(n), -r.coverage, r.scene_id) for n in range(-2, 3) for r in by.get((tile, step + timedelta(n)), []))
        if near:
            better = [x for x in near if x[0] <= 1 and -x[1] >= 0.95] if -near[0][1] < 0.95 else []
            want[tile, str(step)] = min(better, key=lambda x: (x[1], near.index(x)), default=near[0])
    got = QUERIES["nearest_scene"](spark, sf).collect()
    assert len(got) == len(want)
    assert {(r.tile, r.step): (r.days, -r.coverage, r.scene_id) for r in got} == want


def test_whole_series_are_cleared_of_false_clouds(spark, sf):
    want = {}
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        f = [int(v > 0) for v in r.embedding]
        for i in range(1, len(f)):
            if f[i - 1] and f[i]:
                f[i - 1] = f[i] = 0
        want[r.vec_id] = "".join(map(str, f))
    assert {len(f) for f in want.values()} == {64}
    assert {r.vec_id: r.flags for r in QUERIES["false_clouds"](spark, sf).collect()} == want
