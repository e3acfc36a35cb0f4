"""Geometries of one layout taken together: measures, tests and cuts of a batch's polygons as arrays (polygons, points, 2).

What stands here gives what the functions of `geometry` and `overlay` give for one polygon; shapes that don't fit go to these.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

from . import geometry

#: Rings of up to so many edges have all their pairs of edges compared; larger ones are swept one by one.
MOST_SIDES = 24
#: So many numbers are held at once.
HELD = 1 << 20


def places(raw: bytes | None) -> list | None:
    """The parts of a plain (little-endian, flat) polygon or multipolygon: (from, to, rings as (from, points)) each; None for others."""
    try:
        if raw[0] != 1:
            return None
        kind, n = struct.unpack_from("<II", raw, 1)
        if kind not in (geometry.POLYGON, geometry.MULTIPOLYGON):
            return None
        at, parts = 0 if kind == geometry.POLYGON else 9, []
        for _ in range(1 if kind == geometry.POLYGON else n):
            start = at
            order, own, rings = struct.unpack_from("<BII", raw, at)
            if order != 1 or own != geometry.POLYGON or not rings:
                return None
            at, found = at + 9, []
            for _ in range(rings):
                (k,) = struct.unpack_from("<I", raw, at)
                found.append((at + 4, k))
                at += 4 + 16 * k
                if not k or at > len(raw):
                    return None
            parts.append((start, at, found))
    except (TypeError, IndexError, struct.error):
        return None
    return parts if parts and at == len(raw) else None


def layouts(values: list) -> tuple[list, list[int]]:
    """Groups of geometries of one layout: (indices, parts as lists of rings (polygons, points, 2), places); and the indices of the rest."""
    by_size: dict[int, list[int]] = {}
    rest, groups = [], []
    for k, v in enumerate(values):
        if v is None:
            rest.append(k)
        else:
            by_size.setdefault(len(v), []).append(k)
    for size, own in by_size.items():
        while own:
            found = places(values[own[0]])
            if found is None:
                rest.append(own.pop(0))
                continue
            at = np.array(own)
            raw = np.frombuffer(b"".join(values[k] for k in own), np.uint8).reshape(len(own), size)
            fixed = np.ones(size, bool)
            for _, _, rings in found:
                for start, k in rings:
                    fixed[start : start + 16 * k] = False
            same = (raw[:, fixed] == raw[0, fixed]).all(1)
            raw = raw[same]
            ring = lambda start, k: np.ascontiguousarray(raw[:, start : start + 16 * k]).view("<f8").reshape(len(raw), k, 2)  # noqa: B023, E731
            groups.append((at[same], [[ring(*r) for r in rings] for _, _, rings in found], found))
            own = at[~same].tolist()
    return groups, sorted(rest)


def shoelaces(rings: np.ndarray) -> np.ndarray:
    """Signed area and its first moments of each ring."""
    o = rings - rings[:, :1]
    cross = o[:, :-1, 0] * o[:, 1:, 1] - o[:, 1:, 0] * o[:, :-1, 1]
    area = cross.sum(1) / 2
    return np.column_stack([area, ((o[:, :-1] + o[:, 1:]) * cross[..., None]).sum(1) / 6 + area[:, None] * rings[:, 0]])


def area_centres(parts: list[list[np.ndarray]]) -> np.ndarray:
    total = sum(s * (np.sign(s[:, :1]) * (1 if i == 0 else -1)) for rings in parts for i, ring in enumerate(rings) for s in [shoelaces(ring)])
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(total[:, :1] != 0, np.column_stack([total[:, 0], total[:, 1:] / total[:, :1]]), [0.0, np.nan, np.nan])


def contacts(rings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of edges that aren't neighbours: how many pairs meet in each ring, how many of these cross within both, and the last that does."""
    n = rings.shape[1] - 1
    met, cross, pair = np.zeros(len(rings), int), np.zeros(len(rings), int), np.zeros((len(rings), 2), int)
    side = lambda p, q, r: np.sign((q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0]))
    low, high = np.minimum(rings[:, :-1], rings[:, 1:]), np.maximum(rings[:, :-1], rings[:, 1:])
    for i in range(n):
        for j in range(i + 2, n if i else n - 1):
            p, q, c, d = rings[:, i], rings[:, i + 1], rings[:, j], rings[:, j + 1]
            one, two = side(p, q, c) * side(p, q, d), side(c, d, p) * side(c, d, q)
            hit = (one <= 0) & (two <= 0) & ((low[:, i] <= high[:, j]) & (low[:, j] <= high[:, i])).all(1)
            proper = hit & (one < 0) & (two < 0)
            met += hit
            cross += proper
            pair[proper] = i, j
    return met, cross, pair


def crossing(rings: np.ndarray) -> np.ndarray:
    if rings.shape[1] - 1 > MOST_SIDES:
        return np.array([geometry.crosses_itself(r) for r in rings], bool)
    return contacts(rings)[0] > 0


def described(values: list) -> pa.StructArray:
    """status, hectares, cx, cy, w, s, e, n of geometries (see geometry.described)."""
    status, numbers = np.full(len(values), "", object), np.full((len(values), 7), np.nan)
    groups, rest = layouts(values)
    for at, parts, _ in groups:
        rings = [r for p in parts for r in p]
        bad = np.zeros(len(at), bool)
        for r in rings:
            bad |= (r[:, 0] != r[:, -1]).any(1) | (r.shape[1] < 4)
        centre = area_centres(parts)
        crossed = np.zeros(len(at), bool)
        for r in rings:
            if r.shape[1] > 3:
                crossed |= crossing(r)
        status[at] = np.select([bad, centre[:, 0] == 0, crossed], ["invalid_unrepairable", "zero_area", "invalid_but_repairable"], "ok")
        metres = area_centres([[geometry.mollweide(r.reshape(-1, 2)).reshape(r.shape) for r in p] for p in parts])
        every = np.concatenate(rings, 1)
        numbers[at] = np.column_stack([metres[:, 0] / 1e4, centre[:, 1:], every.min(1), every.max(1)])
    for k in rest:
        status[k] = geometry.diagnosis(values[k])
        if status[k] in geometry.MEASURED:
            numbers[k] = geometry.measures(values[k])
    none = ~np.isin(status.astype(str), geometry.MEASURED)
    columns = [pa.array(status, pa.string()), *[pa.array(c, pa.float64(), mask=none) for c in numbers.T]]
    return pa.StructArray.from_arrays(columns, ["status", "hectares", "cx", "cy", "w", "s", "e", "n"])


def split_parts(values: list) -> pa.ListArray:
    """Well-known binary of each part of geometries; none where they can't be read."""
    out: list = [None] * len(values)
    groups, rest = layouts(values)
    for at, _, found in groups:
        for k in at.tolist():
            out[k] = [values[k][start:end] for start, end, _ in found]
    for k in rest:
        out[k] = [geometry.wkb_of([p]) for p in geometry.parts_of(values[k])]
    return pa.array(out, pa.list_(pa.binary()))


def written(rings: np.ndarray) -> list[bytes]:
    """Well-known binary of polygons of one ring each."""
    head, size, raw = struct.pack("<BIII", 1, geometry.POLYGON, 1, rings.shape[1]), 16 * rings.shape[1], np.ascontiguousarray(rings, "<f8").tobytes()
    return [head + raw[k * size : (k + 1) * size] for k in range(len(rings))]


def sound(rings: np.ndarray) -> np.ndarray:
    """Which rings are closed, of finite points, without points repeated and without edges that go straight back."""
    d = np.diff(rings, axis=1)
    after = np.roll(d, -1, 1)
    with np.errstate(invalid="ignore", over="ignore"):
        cross, along = d[..., 0] * after[..., 1] - d[..., 1] * after[..., 0], (d * after).sum(2)
        back = (np.abs(cross) <= 1e-9 * np.abs(along)) & (along < 0)
    return np.isfinite(rings).all((1, 2)) & (rings[:, 0] == rings[:, -1]).all(1) & (d != 0).any(2).all(1) & ~back.any(1)


def mended(values: list) -> list:
    """`geometry.repaired` for each geometry. A ring with one crossing is two loops there, of which the larger is all or the larger
    part of what it winds around; of equal ones that further to the left, then below, is taken."""
    from .overlay import SNAP

    out: list = [None] * len(values)
    groups, rest = layouts(values)
    for at, parts, _ in groups:
        if len(parts) != 1 or len(parts[0]) != 1 or not 4 <= parts[0][0].shape[1] <= MOST_SIDES + 1:
            rest += at.tolist()
            continue
        rings = parts[0][0]
        met, cross, pair = contacts(rings)
        whole = sound(rings)
        good = (met == 0) & (rings[:, 0] == rings[:, -1]).all(1) & (np.diff(rings, axis=1) != 0).any(2).all(1)
        area = shoelaces(rings)[:, 0]
        for k in np.flatnonzero(good & (area != 0)).tolist():
            out[at[k]] = values[at[k]]
        once = whole & (met == 1) & (cross == 1)
        rest += at[~good & ~once].tolist()
        for i, j in np.unique(pair[once], axis=0).tolist() if once.any() else ():
            own = np.flatnonzero(once & (pair == [i, j]).all(1))
            r = rings[own]
            a, d, b, f = r[:, i], r[:, i + 1] - r[:, i], r[:, j], r[:, j + 1] - r[:, j]
            t = ((b - a)[:, 0] * f[:, 1] - (b - a)[:, 1] * f[:, 0]) / (d[:, 0] * f[:, 1] - d[:, 1] * f[:, 0])
            x = (a + d * t[:, None])[:, None]
            far = (np.abs(r - x).max(2) > 10 * SNAP).all(1)
            loops = [np.concatenate([x, r[:, i + 1 : j + 1], x], 1), np.concatenate([x, r[:, j + 1 : -1], r[:, : i + 1], x], 1)]
            one, two = (shoelaces(loop)[:, 0] for loop in loops)
            equal = np.abs(np.abs(one) - np.abs(two)) <= 1e-9 * np.abs(one)
            (ax, ay), (bx, by) = (loop.min(1).T for loop in loops)
            first = np.where(equal, (ax < bx) | ((ax == bx) & (ay <= by)), np.abs(one) > np.abs(two))
            rest += at[own[~far]].tolist()
            for loop, size, take in ((loops[0], one, first), (loops[1], two, ~first)):
                kept = np.flatnonzero(far & take)
                turned = np.where((size[kept] < 0)[:, None, None], loop[kept][:, ::-1], loop[kept])
                for k, raw in zip(at[own[kept]].tolist(), written(turned), strict=True):
                    out[k] = raw
    for k in rest:
        out[k] = geometry.repaired(values[k])
    return out


def chunks(sizes: np.ndarray):
    """Ranges (from, to) of rows whose sizes sum up to HELD or so."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HELD, "right")))
        yield at, to
        at = to


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner and (i, j) of all cells between low and high (rows, 2), both included."""
    n = high - low + 1
    every = n.prod(1)
    own = np.repeat(np.arange(len(low)), every)
    at = np.arange(every.sum()) - np.repeat(np.cumsum(every) - every, every)
    return own, np.column_stack([low[own, 0] + at // n[own, 1], low[own, 1] + at % n[own, 1]])


#: Polygons whose bounds meet up to so many cells are tested cell by cell, others by their quadtree.
MOST_CELLS = 64


def cells_met(values: list, side: float) -> pa.ListArray:
    """array of (i, j): see geometry.cells_met."""
    owners, cells = [np.zeros(0, int)], [np.zeros((0, 2), int)]
    groups, rest = layouts(values)
    for at, parts, _ in groups:
        every = np.concatenate([r for p in parts for r in p], 1)
        edges = np.concatenate([np.concatenate([r[:, :-1], r[:, 1:]], 2) for p in parts for r in p], 1)
        whole = np.all([(r[:, 0] == r[:, -1]).all(1) for p in parts for r in p], axis=0) & np.isfinite(every).all((1, 2))
        low, high = np.ceil(every.min(1) / side) - 1, np.floor(every.max(1) / side)
        few = whole & ((high - low + 1).prod(1) <= MOST_CELLS)
        rest += at[~few].tolist()
        at, edges, low, high = at[few], edges[few], low[few].astype(int), high[few].astype(int)
        for a, b in chunks((high - low + 1).prod(1) * edges.shape[1]):
            own, ij = spread(low[a:b], high[a:b])
            e = edges[a:b][own]
            w, s = (ij * side).T
            t, n = ((ij + 1) * side).T
            hit = geometry.entering(e.reshape(-1, 4), *(np.repeat(x, e.shape[1]) for x in (w, s, t, n))).reshape(e.shape[:2]).any(1)
            x, y = ((w + t) / 2)[:, None], ((s + n) / 2)[:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                right = x < (e[..., 2] - e[..., 0]) * (y - e[..., 1]) / (e[..., 3] - e[..., 1]) + e[..., 0]
            inside = (((e[..., 1] > y) != (e[..., 3] > y)) & right).sum(1) % 2 == 1
            owners.append(at[a:b][own[hit | inside]])
            cells.append(ij[hit | inside])
    for k in rest:
        found = geometry.cover(geometry.parts_of(values[k]), side)[0]
        owners.append(np.full(len(found), k))
        cells.append(found)
    own, ij = np.concatenate(owners), np.concatenate(cells)
    order = np.argsort(own, kind="stable")
    offsets = np.append(0, np.cumsum(np.bincount(own, minlength=len(values))))
    pair = pa.StructArray.from_arrays([pa.array(ij[order, k].astype(np.int32)) for k in (0, 1)], ["i", "j"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pair)


def box_areas(values: list, boxes: np.ndarray) -> np.ndarray:
    """The area of each geometry within its box (w, s, e, n): `geometry.clip_area`.

    With the points added in which edges cross the lines of a box's sides, a ring is moved to the nearest points of the box:
    what is outside falls on its sides, where it has no area.
    """
    out = np.zeros(len(values))
    groups, rest = layouts(values)
    for at, parts, _ in groups:
        whole = np.all([(r[:, 0] == r[:, -1]).all(1) for p in parts for r in p], axis=0)
        rest += at[~whole].tolist()
        at, parts = at[whole], [[r[whole] for r in p] for p in parts]
        for a, b in chunks(np.full(len(at), 10 * sum(r.shape[1] for p in parts for r in p))):
            box = boxes[at[a:b]]
            for rings in parts:
                for i, ring in enumerate(rings):
                    p, d = ring[a:b, :-1], np.diff(ring[a:b], axis=1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        t = np.concatenate([(box[:, None, k : k + 2] - p) / d for k in (0, 2)], 2)
                    t = np.sort(np.clip(np.nan_to_num(t, nan=0.0), 0, 1), 2)
                    t = np.concatenate([np.zeros((*t.shape[:2], 1)), t], 2)
                    points = (p[:, :, None] + d[:, :, None] * t[..., None]).reshape(len(p), -1, 2)
                    points = np.clip(np.concatenate([points, ring[a:b, -1:]], 1), box[:, None, :2], box[:, None, 2:])
                    out[at[a:b]] += np.abs(shoelaces(points)[:, 0]) * (1 if i == 0 else -1)
    for k in rest:
        out[k] = geometry.clip_area(geometry.parts_of(values[k]), *boxes[k])
    return out


#: Polygons of up to so many pixels in height, without edges flatter than that, have their pixels' parts from areas under edges.
TALLEST, FLATTEST = 64, 1 / 64


def bounds(values: list) -> np.ndarray:
    """w, s, e, n of each geometry; not a number where it can't be read or has no points."""
    out = np.full((len(values), 4), np.nan)
    groups, rest = layouts(values)
    for at, parts, _ in groups:
        every = np.concatenate([r for p in parts for r in p], 1)
        out[at] = np.hstack([every.min(1), every.max(1)])
    for k in rest:
        rings = [r for p in geometry.parts_of(values[k]) for r in p if len(r)]
        if rings:
            every = np.concatenate(rings)
            out[k] = *every.min(0), *every.max(0)
    return out


def edges_along(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (polygons, edges, 4) from left to right, and 1 where the inside is below them, -1 where it is above."""
    edges, signs = [], []
    for rings in parts:
        for i, ring in enumerate(rings):
            turn = np.where((shoelaces(ring)[:, 0] > 0) == (i == 0), 1, -1)[:, None]
            p, q = ring[:, :-1], ring[:, 1:]
            back = p[..., 0] > q[..., 0]
            edges.append(np.where(back[..., None], np.concatenate([q, p], 2), np.concatenate([p, q], 2)))
            signs.append(np.where(back, turn, -turn))
    return np.concatenate(edges, 1), np.concatenate(signs, 1)


def area_under(e: np.ndarray, a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The area under edges (x0, y0, x1, y1) from a to b, between two levels: a difference of squares of heights over twice the slope."""
    x, y, m = e[:, 0], e[:, 1], (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    square = lambda at, level: np.maximum(y + (at - x) * m - level, 0.0) ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        slanted = (square(b, low) - square(a, low) - square(b, high) + square(a, high)) / (2 * m)
    return np.where(m != 0, slanted, (b - a) * (np.maximum(y - low, 0.0) - np.maximum(y - high, 0.0)))


def pixel_parts(values: list, corners: np.ndarray, shifts: list[tuple[float, float]], width: int, height: int) -> pa.ListArray:
    """array of (r, c, parts) of geometries in windows of pixels from corners (c, r): see geometry.pixel_coverage.

    A pixel's part is the sum of what lies in it under each edge, above the polygon's lowest point.
    """
    moves, size_limit = np.array(shifts), (width, height)
    owners, pixels, found = [np.zeros(0, int)], [np.zeros((0, 2), int)], [np.zeros((0, len(shifts)))]
    groups, rest = layouts(values)
    for at, parts, _ in groups:
        every = np.concatenate([r for p in parts for r in p], 1)
        fits = np.all([(r[:, 0] == r[:, -1]).all(1) for p in parts for r in p], axis=0) & np.isfinite(every).all((1, 2))
        edges, signs = edges_along(parts)
        rise, run = np.abs(edges[..., 3] - edges[..., 1]), edges[..., 2] - edges[..., 0]
        fits &= (np.ptp(every[..., 1], axis=1) <= TALLEST) & ((rise == 0) | (rise >= run * FLATTEST)).all(1)
        if edges.shape[1] > MOST_SIDES:
            fits[:] = False
        rest += at[~fits].tolist()
        at, every, edges, signs = at[fits], every[fits], edges[fits], signs[fits]
        low = np.maximum(np.floor(every.min(1) + moves.min(0)), corners[at]).astype(int)
        size = np.maximum(np.minimum(np.ceil(every.max(1) + moves.max(0)), corners[at] + size_limit).astype(int) - low, 0)
        for i, j in chunks(size.prod(1) * (edges.shape[1] + len(shifts))):
            first = np.append(0, np.cumsum(size[i:j].prod(1)))
            out = np.zeros((first[-1], len(shifts)))
            for k, move in enumerate(moves):
                base, e = every[i:j, :, 1].min(1) + move[1], edges[i:j] + np.tile(move, 2)
                row, edge = np.nonzero((e[..., 2] > e[..., 0]) & (np.maximum(e[..., 1], e[..., 3]) > base[:, None]))
                e, sign, base = e[row, edge], signs[i:j][row, edge], base[row]
                start, stop = low[i:j][row], (low[i:j] + size[i:j])[row]
                start = np.maximum(start, np.floor(np.column_stack([e[:, 0], base])).astype(int))
                stop = np.minimum(stop, np.ceil(np.column_stack([e[:, 2], np.maximum(e[:, 1], e[:, 3])])).astype(int))
                some = (stop > start).all(1)
                row, e, sign, base, start, stop = (v[some] for v in (row, e, sign, base, start, stop))
                own, cr = spread(start, stop - 1)
                c, r = cr.T
                e, row = e[own], row[own]
                part = sign[own] * area_under(e, np.maximum(e[:, 0], c), np.minimum(e[:, 2], c + 1), np.maximum(base[own], r), r + 1)
                place = first[row] + (r - low[i:j][row, 1]) * size[i:j][row, 0] + c - low[i:j][row, 0]
                out[:, k] = np.bincount(place, part, len(out))
            seen = np.nonzero(out.max(1) > 1e-12)[0]
            row = np.searchsorted(first, seen, "right") - 1
            place = seen - first[row]
            owners.append(at[i:j][row])
            pixels.append(np.column_stack([low[i:j][row, 1] + place // size[i:j][row, 0], low[i:j][row, 0] + place % size[i:j][row, 0]]))
            found.append(out[seen])
    for k in rest:
        own = [[p for p in rings if len(p)] for rings in geometry.parts_of(values[k])]
        every = np.concatenate([np.zeros((0, 2)), *[p for rings in own for p in rings]])
        if not len(every):
            continue
        low = np.maximum(np.floor(every.min(0) + moves.min(0)), corners[k]).astype(int)
        size = np.maximum(np.minimum(np.ceil(every.max(0) + moves.max(0)), corners[k] + size_limit).astype(int) - low, 0)  # the part of the window that the envelope meets
        out = np.stack([geometry.coverage([[p + move for p in rings] for rings in own], *low, *size) for move in moves], 2)
        rc = np.argwhere(out.max(2) > 1e-12) if out.size else np.zeros((0, 2), int)
        owners.append(np.full(len(rc), k))
        pixels.append(rc + low[::-1])
        found.append(out[rc[:, 0], rc[:, 1]])
    own, rc, out = np.concatenate(owners), np.concatenate(pixels), np.concatenate(found)
    order = np.argsort(own, kind="stable")
    offsets = np.append(0, np.cumsum(np.bincount(own, minlength=len(values))))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * len(shifts)), pa.array(out[order].ravel()))
    rows = pa.StructArray.from_arrays([*(pa.array(rc[order, k].astype(np.int32)) for k in (0, 1)), lists], ["r", "c", "parts"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def polygons_written(values: pa.ListArray) -> list:
    """Well-known binary of arrays of polygons, rings and points; None for empty ones and nulls. The points' numbers are copied as they stand."""
    polygons = values.values
    rings = polygons.values
    points = rings.values
    at = [x.offsets.to_numpy() for x in (values, polygons, rings, points)]
    if any(x.null_count for x in (polygons, rings, points, points.values)) or (np.diff(at[3]) != 2).any():
        every = values.to_pylist()
        return [geometry.wkb_of([[np.array([p[:2] for p in ring], float) for ring in own] for own in v]) if v else None for v in every]
    raw = points.values.to_numpy(zero_copy_only=False).astype("<f8").tobytes()
    start, rings_at, polygons_at = (8 * at[3][at[2]]).tolist(), at[1].tolist(), at[0].tolist()
    count, one, head = struct.Struct("<I").pack, struct.Struct("<BII").pack, {}
    sizes = np.diff(at[2]).tolist()
    for n in {*sizes}:
        head[n] = count(n)
    body = [one(1, geometry.POLYGON, b - a) + b"".join([head[sizes[r]] + raw[start[r] : start[r + 1]] for r in range(a, b)]) for a, b in zip(rings_at[:-1], rings_at[1:], strict=True)]
    out = []
    for a, b, there in zip(polygons_at[:-1], polygons_at[1:], values.is_valid().to_pylist(), strict=True):
        out.append(None if not there or a == b else body[a] if b == a + 1 else one(1, geometry.MULTIPOLYGON, b - a) + b"".join(body[a:b]))
    return out
