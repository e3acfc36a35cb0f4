"""Polygons as well-known binary: small Arrow kernels for what envelopes can't express."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RADIUS = 6378137.0
POLYGON, MULTIPOLYGON = 3, 6


def rings_of(wkb: bytes) -> tuple[int, list[list[np.ndarray]]]:
    """The type and, for polygons, the rings of each part as arrays of points (further dimensions are dropped)."""

    def read(at: int):
        order = "<" if wkb[at] == 1 else ">"
        (raw,) = struct.unpack_from(order + "I", wkb, at + 1)
        kind, dims, at = raw % 1000 & 0xFF, 2 + bool(raw & 0x80000000 or raw // 1000 in (1, 3)) + bool(raw & 0x40000000 or raw // 1000 in (2, 3)), at + 5
        if raw & 0x20000000:
            at += 4
        if kind not in (POLYGON, MULTIPOLYGON):
            return kind, [], at
        (n,) = struct.unpack_from(order + "I", wkb, at)
        at, parts = at + 4, []
        for _ in range(n):
            if kind == MULTIPOLYGON:
                _, inner, at = read(at)
                parts += inner
                continue
            (k,) = struct.unpack_from(order + "I", wkb, at)
            points = np.frombuffer(wkb, order + "f8", k * dims, at + 4).reshape(k, dims)[:, :2].astype(float)
            parts.append(points)
            at += 4 + 8 * k * dims
        return kind, ([parts] if kind == POLYGON and parts else parts), at

    kind, parts, _ = read(0)
    return kind, parts


def closed(points: list) -> np.ndarray:
    """A ring of points, with the first again at its end."""
    return np.array([*points, points[0]], float)


def wkb_of(parts: list[list[np.ndarray]]) -> bytes:
    body = [struct.pack("<BII", 1, POLYGON, len(rings)) + b"".join(struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes() for r in rings) for rings in parts]
    return body[0] if len(body) == 1 else struct.pack("<BII", 1, MULTIPOLYGON, len(body)) + b"".join(body)


def shoelace(ring: np.ndarray) -> tuple[float, float, float]:
    """Signed area and its first moments."""
    o = ring - ring[0]
    cross = o[:-1, 0] * o[1:, 1] - o[1:, 0] * o[:-1, 1]
    area = cross.sum() / 2
    m = ((o[:-1] + o[1:]) * cross[:, None]).sum(0) / 6
    return area, m[0] + area * ring[0, 0], m[1] + area * ring[0, 1]


def area_centre(parts: list[list[np.ndarray]]) -> tuple[float, float, float]:
    total = np.zeros(3)
    for rings in parts:
        for i, ring in enumerate(rings):
            s = np.array(shoelace(ring))
            total += s * (np.sign(s[0]) * (1 if i == 0 else -1))
    return (total[0], total[1] / total[0], total[2] / total[0]) if total[0] else (0.0, np.nan, np.nan)


def mollweide(points: np.ndarray) -> np.ndarray:
    """Longitudes and latitudes to metres of the equal-area Mollweide projection (Newton's method for the angle)."""
    lon, lat = np.radians(points[:, 0]), np.radians(points[:, 1])
    theta = lat.copy()
    for _ in range(50):
        step = (2 * theta + np.sin(2 * theta) - np.pi * np.sin(lat)) / np.maximum(2 + 2 * np.cos(2 * theta), 1e-12)
        theta -= step
        if np.abs(step).max(initial=0) < 1e-13:
            break
    theta = np.where(np.abs(lat) >= np.pi / 2 - 1e-12, lat, theta)
    return RADIUS * np.stack([2 * np.sqrt(2) / np.pi * lon * np.cos(theta), np.sqrt(2) * np.sin(theta)], 1)


#: So many pairs of edges are compared at once.
PAIRS = 1 << 20


def near_pairs(edges: np.ndarray):
    """(i, j) of all pairs of edges (x0, y0, x1, y1) whose bounds meet: a sweep along x, PAIRS at a time."""
    low, high = np.minimum(edges[:, :2], edges[:, 2:]), np.maximum(edges[:, :2], edges[:, 2:])
    order = np.argsort(low[:, 0], kind="stable")
    after = np.searchsorted(low[order, 0], high[order, 0], "right") - np.arange(len(order)) - 1
    ends = np.cumsum(after)
    at = 0
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        n = after[at:to]
        first = np.repeat(np.arange(at, to), n)
        i, j = order[first], order[first + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        meet = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        yield i[meet], j[meet]
        at = to


def crosses_itself(ring: np.ndarray) -> bool:
    """Whether two edges that aren't neighbours meet."""
    edges, n = np.hstack([ring[:-1], ring[1:]]), len(ring) - 1
    side = lambda p, q, r: np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))
    for i, j in near_pairs(edges):
        apart = np.abs(i - j)
        i, j = i[(apart > 1) & (apart < n - 1)], j[(apart > 1) & (apart < n - 1)]
        p, q, c, d = edges[i, :2], edges[i, 2:], edges[j, :2], edges[j, 2:]
        if ((side(p, q, c) * side(p, q, d) <= 0) & (side(c, d, p) * side(c, d, q) <= 0)).any():
            return True
    return False


def diagnosis(wkb: bytes | None) -> str:
    try:
        kind, parts = rings_of(wkb)
    except Exception:  # any damage to the bytes
        return "wkb_parse_error"
    if kind not in (POLYGON, MULTIPOLYGON):
        return "wrong_geom_type"
    if not parts or not any(len(r) for p in parts for r in p):
        return "empty_geometry"
    rings = [r for p in parts for r in p]
    if any(len(r) < 4 or (r[0] != r[-1]).any() for r in rings):
        return "invalid_unrepairable"
    if area_centre(parts)[0] == 0:
        return "zero_area"
    return "invalid_but_repairable" if any(crosses_itself(r) for r in rings) else "ok"


def contains(parts: list[list[np.ndarray]], x: float, y: float) -> bool:
    """Even-odd rule over all rings."""
    inside = False
    for rings in parts:
        for ring in rings:
            a, b = ring[:-1], ring[1:]
            up = (a[:, 1] > y) != (b[:, 1] > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
            inside ^= bool((up & (x < at)).sum() % 2)
    return inside


def clipped(ring: np.ndarray, w: float, s: float, e: float, n: float) -> np.ndarray:
    """A ring cut to a rectangle, side after side."""
    for axis, limit, sign in ((0, w, 1), (0, e, -1), (1, s, 1), (1, n, -1)):
        if np.isinf(limit):
            continue
        if len(ring) < 2:
            return ring[:0]
        keep = sign * (ring[:, axis] - limit) >= 0
        out = []
        for p, q, kp, kq in zip(ring[:-1], ring[1:], keep[:-1], keep[1:], strict=True):
            if kp:
                out.append(p)
            if kp != kq:
                cut = p + (q - p) * (limit - p[axis]) / (q[axis] - p[axis])
                cut[axis] = limit  # not a hair beside it
                out.append(cut)
        ring = np.array([*out, out[0]]) if out else ring[:0]
    return ring


def cut_to(parts: list[list[np.ndarray]], w: float, s: float, e: float, n: float) -> list[list[np.ndarray]]:
    """Polygons cut to a rectangle, whose sides may be infinite; what has no area left is left out."""
    cut = [[clipped(r, w, s, e, n) for r in rings] for rings in parts]
    return [[r for r in rings if len(r) > 3] for rings in cut if len(rings[0]) > 3]


def clip_area(parts: list[list[np.ndarray]], w: float, s: float, e: float, n: float) -> float:
    total = 0.0
    for rings in parts:
        for i, ring in enumerate(rings):
            cut = clipped(ring, w, s, e, n)
            total += abs(shoelace(cut)[0]) * (1 if i == 0 else -1) if len(cut) else 0.0
    return total


def meets_box(parts: list[list[np.ndarray]], w: float, s: float, e: float, n: float) -> bool:
    """Whether polygons and a closed rectangle have a point in common: an edge enters it, or they hold its corner."""
    if any(entering(np.hstack([ring[:-1], ring[1:]]), w, s, e, n).any() for rings in parts for ring in rings):
        return True
    return contains(parts, w, s)


def repaired(wkb: bytes | None) -> bytes | None:
    """A polygon with its rings closed, repeated points dropped and crossing rings untangled (see overlay.untangled), of several parts
    the largest; None where nothing is left. Holes stay with their part."""
    from .overlay import untangled

    try:
        _, parts = rings_of(wkb)
    except Exception:  # any damage to the bytes
        return None
    sound = []
    for rings in parts:
        kept = []
        for ring in rings:
            new = np.append(True, (np.diff(ring, axis=0) != 0).any(1)) if len(ring) else np.zeros(0, bool)
            ring = ring[new]
            if len(ring) and (ring[0] != ring[-1]).any():
                ring = closed(ring)
            kept.append(ring if len(ring) > 3 else ring[:0])
        if kept and len(kept[0]):
            kept = [r for r in kept if len(r)]
            sound += untangled(kept) if any(crosses_itself(r) for r in kept) else [kept]
    best = max(sound, key=lambda p: abs(area_centre([p])[0]), default=None)
    return wkb_of([best]) if best and area_centre([best])[0] else None


def coverage(parts: list[list[np.ndarray]], c0: int, r0: int, width: int, height: int) -> np.ndarray:
    """The part of each pixel of a window (rows r0 and on, columns c0 and on) that polygons cover, exactly.

    Edges are cut at all pixel sides that they cross. A piece in a pixel takes its height times what lies right of it
    from that pixel, and its whole height from the pixels further right; holes count against their ring.
    """
    if not height or not width:
        return np.zeros((height, width))
    out = np.zeros((height, width + 1))
    edges = [np.zeros((0, 4))]
    for rings in parts:
        for i, ring in enumerate(rings):
            points = (ring if (shoelace(ring)[0] > 0) == (i == 0) else ring[::-1]) - [c0, r0]
            edges.append(np.hstack([points[:-1], points[1:]]))
    edges = np.concatenate(edges)
    edges = edges[edges[:, 1] != edges[:, 3]]
    a, d = edges[:, :2], edges[:, 2:] - edges[:, :2]
    every = np.arange(len(edges))
    owner, place = [every, every], [np.zeros(len(edges)), np.ones(len(edges))]
    for axis, most in ((0, width), (1, height)):
        low = np.maximum(np.ceil(np.minimum(a[:, axis], edges[:, 2 + axis])), 0)
        n = np.minimum(np.floor(np.maximum(a[:, axis], edges[:, 2 + axis])), most) - low + 1
        n = np.where(d[:, axis] != 0, np.maximum(n, 0), 0).astype(int)
        own = np.repeat(every, n)
        lines = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        owner.append(own)
        place.append((lines - a[own, axis]) / d[own, axis])
    own, t = np.concatenate(owner), np.clip(np.concatenate(place), 0, 1)
    order = np.lexsort((t, own))
    own, t = own[order], t[order]
    x, y = (a[own] + d[own] * t[:, None]).T
    piece = own[1:] == own[:-1]
    mx, my, dy = ((x[1:] + x[:-1]) / 2)[piece], ((y[1:] + y[:-1]) / 2)[piece], np.diff(y)[piece]
    row = np.floor(my).astype(int)
    seen = (row >= 0) & (row < height) & (mx < width)
    mx, row, dy = mx[seen], row[seen], dy[seen]
    col = np.clip(np.floor(mx), 0, None).astype(int)
    share = np.where(mx < 0, 1.0, col + 1 - mx)
    # An edge upwards has the inside to its left in y-up axes: what is right of it is taken away.
    np.add.at(out, (row, col), -dy * share)
    np.add.at(out, (row, col + 1), -dy * (1 - share))
    return np.cumsum(out, 1)[:, :width]


def entering(edges: np.ndarray, w: float | np.ndarray, s: float | np.ndarray, e: float | np.ndarray, n: float | np.ndarray) -> np.ndarray:
    """Which edges (x0, y0, x1, y1) have a point in a closed rectangle, one for all or one for each."""
    a, d, low, high = edges[:, :2], edges[:, 2:] - edges[:, :2], np.stack([w, s], -1), np.stack([e, n], -1)
    with np.errstate(divide="ignore", invalid="ignore"):
        near, far = (low - a) / d, (high - a) / d
    flat, inside = d == 0, (a >= low) & (a <= high)
    enter, leave = np.where(flat, np.where(inside, -np.inf, np.inf), np.minimum(near, far)), np.where(flat, np.where(inside, np.inf, -np.inf), np.maximum(near, far))
    return np.maximum(enter.max(1), 0) <= np.minimum(leave.min(1), 1)


def cover(parts: list[list[np.ndarray]], side: float) -> tuple[np.ndarray, np.ndarray]:
    """The cells (i, j) of side `side` that polygons meet, their closed edges included, and whether an edge enters each.

    Squares of cells are halved both ways as long as an edge enters them; one that no edge enters is inside or outside as a
    whole. So the work grows with the boundary, and only the result with the area. Each square looks at the edges that
    entered the one around it, and at those of its own rows to tell inside from outside.
    """
    rings = [r for rings in parts for r in rings if len(r) > 1]
    if not rings:
        return np.zeros((0, 2), np.int64), np.zeros(0, bool)
    edges = np.concatenate([np.hstack([r[:-1], r[1:]]) for r in rings])
    every = np.concatenate(rings)
    low, high = np.ceil(every.min(0) / side).astype(int) - 1, np.floor(every.max(0) / side).astype(int)
    cells, crossed = [np.zeros((0, 2), np.int64)], [np.zeros(0, bool)]
    stack = [(*low, 1 << int((high - low).max()).bit_length(), edges, edges)]
    while stack:
        i, j, n, near, rows = stack.pop()
        if i > high[0] or j > high[1]:
            continue
        w, s, e, t = i * side, j * side, (i + n) * side, (j + n) * side
        near = near[entering(near, w, s, e, t)]
        rows = rows[(np.minimum(rows[:, 1], rows[:, 3]) <= t) & (np.maximum(rows[:, 1], rows[:, 3]) >= s)]
        if len(near) and n > 1:
            h = n // 2
            stack += [(i + a * h, j + b * h, h, near, rows) for a in (0, 1) for b in (0, 1)]
        elif len(near) or odd_right(rows, (w + e) / 2, (s + t) / 2):
            at = np.stack(np.meshgrid(np.arange(i, i + n), np.arange(j, j + n), indexing="ij"), -1).reshape(-1, 2)
            cells.append(at)
            crossed.append(np.full(len(at), bool(len(near))))
    return np.concatenate(cells), np.concatenate(crossed)


def odd_right(edges: np.ndarray, x: float, y: float) -> bool:
    """Whether an odd number of edges is to the right of a point: it is inside, by the even-odd rule."""
    up = edges[(edges[:, 1] > y) != (edges[:, 3] > y)]
    return bool((x < (up[:, 2] - up[:, 0]) * (y - up[:, 1]) / (up[:, 3] - up[:, 1]) + up[:, 0]).sum() % 2)


def cells_met(geom: Column, side: float) -> Column:
    """array of (i, j): the cells of side `side` that a geometry meets or touches; empty where it can't be read."""

    @F.arrow_udf("array<struct<i: int, j: int>>")
    def met(values: pa.Array) -> pa.Array:
        from . import batches

        return batches.cells_met(values.to_pylist(), side)

    return met(geom)


def cell_pieces(geom: Column, side: float) -> Column:
    """array of (i, j, piece): the cells that a geometry has a part of; piece (well-known binary) is its part of a cell that an edge
    enters, null where it fills the cell. A point of the cell is in the geometry if it is in the piece."""

    @F.pandas_udf("array<struct<i: long, j: long, piece: binary>>")
    def split(values: pd.Series) -> pd.Series:
        out = []
        for v in values:
            parts, found = parts_of(v), []
            cells, crossed = cover(parts, side)
            strips: dict[int, list] = {}
            for (i, j), edge in zip(cells.tolist(), crossed.tolist(), strict=True):
                if not edge:
                    found.append({"i": i, "j": j, "piece": None})
                    continue
                if j not in strips:
                    strips[j] = cut_to(parts, -np.inf, j * side, np.inf, (j + 1) * side)
                own = cut_to(strips[j], i * side, -np.inf, (i + 1) * side, np.inf)
                if own:
                    found.append({"i": i, "j": j, "piece": wkb_of(own)})
            out.append(found)
        return pd.Series(out)

    return split(geom)


#: What a geometry may be that has measures.
MEASURED = ("ok", "invalid_but_repairable")


def measures(wkb: bytes) -> tuple:
    """Hectares, centre and bounds of a geometry that has them."""
    _, parts = rings_of(wkb)
    _, cx, cy = area_centre(parts)
    every = np.concatenate([r for p in parts for r in p])
    hectares = area_centre([[mollweide(r) for r in p] for p in parts])[0] / 1e4
    return hectares, cx, cy, *every.min(0), *every.max(0)


def described(df: DataFrame, geom: str = "geom") -> DataFrame:
    """df with status, hectares (Mollweide), cx, cy and the bounds w, s, e, n of each geometry, in place of columns of these
    names; nulls where it can't be read."""
    df = df.drop("status", "hectares", "cx", "cy", "w", "s", "e", "n")

    @F.arrow_udf("status string, hectares double, cx double, cy double, w double, s double, e double, n double")
    def describe(values: pa.Array) -> pa.Array:
        from . import batches

        return batches.described(values.to_pylist())

    return df.withColumn("_d", describe(geom)).select(*df.columns, "_d.*")


def envelope(geom: Column) -> Column:
    """struct(w, s, e, n) of a geometry's bounds, null where it can't be read or has no points."""

    @F.arrow_udf("w double, s double, e double, n double")
    def bounds(values: pa.Array) -> pa.Array:
        from . import batches

        found = batches.bounds(values.to_pylist())
        return pa.StructArray.from_arrays([pa.array(c, pa.float64(), from_pandas=True) for c in found.T], ["w", "s", "e", "n"])

    return bounds(geom)


def tile_overlap(geom: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """The area of a geometry within a rectangle, in its own units; 0 where they only touch or the geometry can't be read."""

    @F.arrow_udf("double")
    def overlap(g: pa.Array, w: pa.Array, s: pa.Array, e: pa.Array, n: pa.Array) -> pa.Array:
        from . import batches

        return pa.array(batches.box_areas(g.to_pylist(), np.column_stack([c.to_numpy(zero_copy_only=False) for c in (w, s, e, n)])))

    return overlap(geom, w, s, e, n)


def within(geom: Column, x: Column, y: Column) -> Column:
    """Whether a geometry holds a point; false where it can't be read."""

    @F.pandas_udf("boolean")
    def test(g: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([contains(parts_of(v), a, b) for v, a, b in zip(g, x, y, strict=True)], dtype=bool)

    return test(geom, x, y)


def meets(geom: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """Whether a geometry and a closed rectangle have a point in common; false where it can't be read."""

    @F.pandas_udf("boolean")
    def test(g: pd.Series, w: pd.Series, s: pd.Series, e: pd.Series, n: pd.Series) -> pd.Series:
        read = {}
        for v in g:
            if v not in read:
                read[v] = parts_of(v)
        return pd.Series([bool(read[v]) and meets_box(read[v], *box) for v, *box in zip(g, w, s, e, n, strict=True)], dtype=bool)

    return test(geom, w, s, e, n)


def parts_of(wkb: bytes | None) -> list[list[np.ndarray]]:
    """The polygons of a geometry, none where it can't be read."""
    try:
        return rings_of(wkb)[1]
    except Exception:  # any damage to the bytes
        return []


def repair(geom: Column) -> Column:
    @F.arrow_udf("binary")
    def mend(values: pa.Array) -> pa.Array:
        from . import batches

        return pa.array(batches.mended(values.to_pylist()), pa.binary())

    return mend(geom)


def pixel_coverage(geom: Column, c0: Column, r0: Column, shifts: list[tuple[float, float]], width: int, height: int) -> Column:
    """For a window of pixels from (c0, r0): an array of (r, c, parts), the part of each pixel that the geometry covers when
    moved by each of shifts. Pixels that none covers are left out."""

    @F.arrow_udf("array<struct<r: int, c: int, parts: array<double>>>")
    def cover(g: pa.Array, c0: pa.Array, r0: pa.Array) -> pa.Array:
        from . import batches

        corners = np.column_stack([c.to_numpy(zero_copy_only=False) for c in (c0, r0)])
        return batches.pixel_parts(g.to_pylist(), corners, shifts, width, height)

    return cover(geom, c0, r0)


def wkb(polygons: Column) -> Column:
    """Well-known binary of polygons given as an array of polygons, each an array of rings of [x, y] points, as GeoJSON has them."""

    @F.arrow_udf("binary")
    def written(values: pa.Array) -> pa.Array:
        from . import batches

        return pa.array(batches.polygons_written(values), pa.binary())

    return written(polygons)


def exploded(df: DataFrame, geom: str = "geom") -> DataFrame:
    """A row for each part of a multipolygon, with part_idx; none for a geometry that can't be read."""

    @F.arrow_udf("array<binary>")
    def split(values: pa.Array) -> pa.Array:
        from . import batches

        return batches.split_parts(values.to_pylist())

    return df.select("*", F.posexplode(split(geom)).alias("part_idx", "_part")).withColumn(geom, F.col("_part")).drop("_part")
