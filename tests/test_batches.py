"""Batches of geometries against the functions for one of them."""

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import batches, geometry, overlay


@pytest.fixture(scope="module")
def shapes():
    rng, out = np.random.default_rng(1), [None, b"", b"\x01", geometry.wkb_of([[np.zeros((0, 2))]])]
    for n in (3, 4, 5, 6, 8, 40):
        for i in range(60):
            ring = geometry.closed(list(rng.integers(0, 12, (n, 2)) if i % 2 else rng.uniform(-30, 30, (n, 2))))
            out.append(geometry.wkb_of([[ring[: len(ring) - (i % 9 == 0)]]]))
    for i in range(60):
        a, b = (geometry.closed(list(rng.uniform(0, 10, (k, 2)))) for k in (3, 4))
        out += [geometry.wkb_of([[a], [b]]), geometry.wkb_of([[b, a]]), geometry.wkb_of([[a], [b]])[: -3 - i % 5]]
    return out


def test_descriptions(shapes):
    for raw, got in zip(shapes, batches.described(shapes).to_pylist(), strict=True):
        status = geometry.diagnosis(raw)
        want = geometry.measures(raw) if status in geometry.MEASURED else (None,) * 7
        assert got.pop("status") == status
        assert list(got.values()) == (list(want) if want[0] is None else pytest.approx(want, rel=1e-9, abs=1e-9))


def test_cells_parts_and_areas_in_boxes(shapes):
    for raw, got in zip(shapes, batches.cells_met(shapes, 2.5).to_pylist(), strict=True):
        assert sorted((c["i"], c["j"]) for c in got) == sorted(map(tuple, geometry.cover(geometry.parts_of(raw), 2.5)[0].tolist()))
    assert batches.split_parts(shapes).to_pylist() == [[geometry.wkb_of([p]) for p in geometry.parts_of(raw)] for raw in shapes]
    rng = np.random.default_rng(2)
    boxes = np.column_stack([rng.uniform(-5, 5, (len(shapes), 2)), rng.uniform(5.5, 15, (len(shapes), 2))])
    np.testing.assert_allclose(batches.box_areas(shapes, boxes), [geometry.clip_area(geometry.parts_of(v), *b) for v, b in zip(shapes, boxes, strict=True)], atol=1e-9)


def test_repairs(shapes):
    area = lambda raw: raw and round(geometry.area_centre(geometry.parts_of(raw))[0], 6)
    got = batches.mended(shapes)
    assert [area(raw) for raw in got] == [area(geometry.repaired(raw)) for raw in shapes]
    assert [raw and geometry.diagnosis(raw) for raw in got] == [raw and geometry.diagnosis(geometry.repaired(raw)) for raw in got]


def test_lone_polygons_have_the_swept_area(shapes):
    areas, edges = overlay.lone(shapes)
    assert sum(a is not None for a in areas) > 50
    for raw, a, e in zip(shapes, areas, edges, strict=True):
        if a is not None:
            assert a == pytest.approx(overlay.swept(overlay.edges_of(geometry.parts_of(raw)))[0])
            assert a == pytest.approx(((e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]) / 2).sum())


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_runs_stay_together(size):
    keys = [None, None, 1, 1, 1, 1, 1, 2, 3, 3, 3, 4]
    rows = pa.table({"g": pa.array(keys, pa.int64()), "n": list(range(len(keys)))})
    found = list(overlay.runs(rows.to_batches(max_chunksize=size), ("g",)))
    assert pa.concat_tables(found).equals(rows)
    for a, b in zip(found[:-1], found[1:], strict=True):
        assert a.column("g")[-1].as_py() != b.column("g")[0].as_py()


def test_arrays_written():
    rows = [[[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 1.0]]]], None, [], [[[[5.0, 5.0], [6.0, 5.0], [5.0, 5.0]]], [[[7.0, 5.0], [8.0, 5.0], [7.0, 5.0]]]]]
    kind = pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
    want = [geometry.wkb_of([[np.array(r)[:, :2] for r in p] for p in v]) if v else None for v in rows]
    assert batches.polygons_written(pa.array(rows, kind)) == want
    assert batches.polygons_written(pa.array([rows[2], *rows], kind).slice(1)) == want
    high = [[[[[*p, 9.0] for p in r] for r in own] for own in v] if v else v for v in rows]
    assert batches.polygons_written(pa.array(high, kind)) == want


def test_parts_of_pixels(shapes):
    corners = np.column_stack([np.arange(len(shapes)) % 7 - 4, np.arange(len(shapes)) % 5 - 4])
    shifts = [(0.0, 0.0), (0.5, 0.0), (-0.5, 0.5)]
    for raw, at, got in zip(shapes, corners, batches.pixel_parts(shapes, corners, shifts, 11, 6).to_pylist(), strict=True):
        if any((p[0] != p[-1]).any() for rings in geometry.parts_of(raw) for p in rings if len(p)):
            continue  # open rings have no coverage that doesn't hang on the window
        want = np.stack([geometry.coverage([[p + s for p in rings if len(p)] for rings in geometry.parts_of(raw)], *at, 11, 6) for s in shifts], 2)
        found = np.zeros_like(want)
        for x in got:
            found[x["r"] - at[1], x["c"] - at[0]] = x["parts"]
        np.testing.assert_allclose(found, np.where(want.max(2, keepdims=True) > 1e-9, want, found), atol=1e-9)


def test_triangles_with_a_part_at_the_limit_go_by_the_area_under_their_slope():
    """A twentieth of a pixel exactly: whether it counts hangs on the last bits, which are those of the closed form."""
    for box, pixel, counts in (((176, 2416, 400, 2451), (80, 6), True), ((644, 204, 940, 478), (7, 23), False)):
        x0, y0 = box[0] * 45 / 1360.0, box[1] * 45 / 1360.0
        x1, y1 = x0 + (box[2] - box[0]) / 170.0, y0 + (box[3] - box[1]) / 170.0
        raw = geometry.wkb_of([[np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y0)])]])
        corner = np.array([[int(x0) // 64 * 64, int(y0) // 64 * 64]])
        part = {(p["r"], p["c"]): p["parts"][0] for p in batches.pixel_parts([raw], corner, [(0.0, 0.0)], 64, 64).to_pylist()[0]}[pixel]
        assert part == pytest.approx(0.05, abs=1e-12) and (part >= 0.05) is counts
