"""Union of polygons by squares of the plane: sweeps within squares, then the boundary of all of them traced to rings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import batches, geometry
from .shared import Saved

#: Points closer than this along an axis are one.
SNAP = 1e-7
#: A square with more edges is cut into four for its sweep, down to so many times.
MOST_EDGES, DEEPEST = 256, 12


def edges_of(parts: list[list[np.ndarray]]) -> np.ndarray:
    """The edges (x0, y0, x1, y1) of polygons, their inside to the left: outer rings turn left, holes right."""
    out = [np.zeros((0, 4))]
    for rings in parts:
        for i, ring in enumerate(rings):
            points = ring if (geometry.shoelace(ring)[0] > 0) == (i == 0) else ring[::-1]
            out.append(np.hstack([points[:-1], points[1:]]))
    edges = np.concatenate(out)
    return edges[(edges[:, :2] != edges[:, 2:]).any(1)]


def crossings(edges: np.ndarray) -> np.ndarray:
    """The x of all points in which two edges cross."""
    out = [np.zeros(0)]
    a, d = edges[:, :2], edges[:, 2:] - edges[:, :2]
    for i, j in geometry.near_pairs(edges):
        cross = d[i, 0] * d[j, 1] - d[i, 1] * d[j, 0]
        off = a[j] - a[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (off[:, 0] * d[j, 1] - off[:, 1] * d[j, 0]) / cross
            u = (off[:, 0] * d[i, 1] - off[:, 1] * d[i, 0]) / cross
        hit = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        out.append(a[i[hit], 0] + d[i[hit], 0] * t[hit])
    return np.concatenate(out)


def joined(values: np.ndarray) -> np.ndarray:
    """values in order, those within SNAP of the one before left out."""
    values = np.sort(values)
    return values[np.append(True, np.diff(values) > SNAP)] if len(values) else values


def intervals(weight: np.ndarray, either: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of edges in their order upwards: which begin and which end what is inside, where the sum of weights is positive, or with
    `either` not 0."""
    total = np.cumsum(weight)
    inside = total != 0 if either else total > 0
    before = np.append(False, inside[:-1])
    return np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)


def one_sided(a: list[tuple[float, float]], b: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The stretches of the line that one of a and b covers alone: positive (from, to) for a, turned round for b."""
    events = sorted([(x, k) for lo, hi in a for x, k in ((lo, 1), (hi, -1))] + [(x, -k) for lo, hi in b for x, k in ((lo, 1), (hi, -1))])
    out, level = [], 0
    for (x, k), (y, _) in zip(events[:-1], events[1:], strict=True):
        level += k
        if level and y - x > SNAP:
            out.append((x, y) if level > 0 else (y, x))
    return out


def swept(edges: np.ndarray, either: bool = False) -> tuple[float, np.ndarray]:
    """The area of the union of polygons with these edges, and its boundary (x0, y0, x1, y1), the inside to the left.

    Between two neighbouring x of ends and crossings, edges don't cross: going upwards, the union is where the sum of
    edges to the right (1) and to the left (-1) is positive (with `either`: not 0). Upright boundaries are where what stands left and right of an
    x differs. Edges in the same place are taken together, so what two polygons share is no boundary.
    """
    xs = joined(np.concatenate([edges[:, 0], edges[:, 2], crossings(edges)]))
    right = edges[:, 0] < edges[:, 2]
    e = np.where(right[:, None], edges, edges[:, [2, 3, 0, 1]])
    e, weight = e[e[:, 0] != e[:, 2]], np.where(right, 1, -1)[edges[:, 0] != edges[:, 2]]
    area, out, left = 0.0, [], []
    for x0, x1 in zip(xs, [*xs[1:], None], strict=True):
        if x1 is None:
            here, at_left = [], []
        else:
            on = (e[:, 0] <= x0 + SNAP) & (e[:, 2] >= x1 - SNAP)
            a, w = e[on], weight[on]
            slope = (a[:, 3] - a[:, 1]) / (a[:, 2] - a[:, 0])
            y0, y1 = a[:, 1] + slope * (x0 - a[:, 0]), a[:, 1] + slope * (x1 - a[:, 0])
            order = np.argsort(y0 + y1, kind="stable")
            y0, y1, w = y0[order], y1[order], w[order]
            # Edges in one place count as one.
            new = np.append(True, (np.abs(np.diff(y0)) > SNAP) | (np.abs(np.diff(y1)) > SNAP)) if len(w) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            y0, y1, w = y0[first], y1[first], np.add.reduceat(w, first) if len(first) else w
            low, high = intervals(w, either)
            area += float(((y0[high] - y0[low] + y1[high] - y1[low]) / 2).sum() * (x1 - x0))
            out += [(x0, y0[i], x1, y1[i]) for i in low] + [(x1, y1[i], x0, y0[i]) for i in high]
            at_left, here = list(zip(y0[low], y0[high], strict=True)), list(zip(y1[low], y1[high], strict=True))
        out += [(x0, y, x0, z) for y, z in one_sided(left, at_left)]
        left = here
    return area, np.array(out).reshape(-1, 4)


def united(parts: list[list[np.ndarray]], w: float, s: float, e: float, n: float, deep: int = 0, either: bool = False) -> tuple[float, np.ndarray]:
    """`swept` for polygons within a rectangle, which is cut into four while it has many edges and no polygon fills it. The
    boundaries of its quarters stay in the result."""
    whole = (e - w) * (n - s)
    if not either and any(geometry.area_centre([p])[0] >= whole * (1 - 1e-12) for p in parts):
        return whole, np.array([(w, s, e, s), (e, s, e, n), (e, n, w, n), (w, n, w, s)], float)
    edges = edges_of(parts)
    if len(edges) <= MOST_EDGES or deep == DEEPEST:
        return swept(edges, either) if len(edges) else (0.0, np.zeros((0, 4)))
    x, y = (w + e) / 2, (s + n) / 2
    found = [united(geometry.cut_to(parts, *box), *box, deep + 1, either) for box in ((w, s, x, y), (x, s, e, y), (w, y, x, n), (x, y, e, n))]
    return sum(a for a, _ in found), np.concatenate([b for _, b in found])


def cancelled(edges: np.ndarray) -> np.ndarray:
    """Edges without what upright or level ones on one line have in common in opposite directions."""
    out = [edges[(np.abs(edges[:, :2] - edges[:, 2:]) > SNAP).all(1)]]
    for axis in (0, 1):
        own = edges[np.abs(edges[:, axis] - edges[:, 2 + axis]) <= SNAP]
        for line in np.unique(np.round(own[:, axis] / SNAP)) if len(own) else ():
            here = own[np.round(own[:, axis] / SNAP) == line]
            p, q, at = here[:, 1 - axis], here[:, 3 - axis], here[0, axis]
            left = one_sided([x for x in zip(p, q, strict=True) if x[0] < x[1]], [x[::-1] for x in zip(p, q, strict=True) if x[1] < x[0]])
            ends = np.array(left).reshape(-1, 2)
            fixed = np.full(len(ends), at)
            out.append(np.stack([fixed, ends[:, 0], fixed, ends[:, 1]] if axis == 0 else [ends[:, 0], fixed, ends[:, 1], fixed], 1))
    return np.concatenate(out)


def region(parts: list[list[np.ndarray]], either: bool) -> list[list[np.ndarray]]:
    every = np.concatenate([r for p in parts for r in p])
    (w, s), (e, n) = every.min(0), every.max(0)
    return traced(cancelled(united(parts, w, s, e, n, either=either)[1]))


def untangled(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """The polygons that rings, an outer one and holes, enclose: all that an outer ring winds around, in whatever direction and how
    often, less what holes wind around. Rings of the result don't cross themselves; a bow tie gives two."""
    outer = region([[rings[0]]], either=True)
    holes = [r for hole in rings[1:] for p in region([[hole]], either=True) for r in p[:1]]
    return region([[p[0], *p[1:], *holes] for p in outer], either=False) if outer and holes else outer


def pieces(polygons: DataFrame, group: str, cell: float, geom: str = "geom") -> DataFrame:
    """(group, i, j, geom): each polygon's part in each square (i, j) of side `cell`, without equal parts of one group.

    A polygon's squares come from its rows of squares: those that an edge enters, and those between them that are
    inside. Geometries that can't be read have none.
    """
    def spread(rows):
        for batch in rows:
            keys, at_i, at_j, out = [], [], [], []
            values = batch.column(1).to_pylist()
            groups, rest = batches.layouts(values)
            for own, parts, _ in groups:
                points = np.concatenate([r for p in parts for r in p], 1)
                low, high = np.floor(points.min(1) / cell), np.floor(points.max(1) / cell)
                whole = (low == high).all(1)  # in one square as they are
                keys += own[whole].tolist()
                at_i += low[whole, 0].astype(int).tolist()
                at_j += low[whole, 1].astype(int).tolist()
                out += [values[k] for k in own[whole].tolist()]
                rest += own[~whole].tolist()
            for k in rest:
                parts = geometry.parts_of(values[k])
                if not parts or not any(len(r) for p in parts for r in p):
                    continue
                every = np.concatenate([r for p in parts for r in p])
                low, high = np.floor(every.min(0) / cell).astype(int), np.floor(every.max(0) / cell).astype(int)
                for j in range(low[1], high[1] + 1):
                    row = geometry.cut_to(parts, -np.inf, j * cell, np.inf, (j + 1) * cell) if high[1] > low[1] else parts
                    for i in range(low[0], high[0] + 1) if row else ():
                        own = geometry.cut_to(row, i * cell, -np.inf, (i + 1) * cell, np.inf) if high[0] > low[0] else row
                        if own:
                            keys.append(k)
                            at_i.append(i)
                            at_j.append(j)
                            out.append(geometry.wkb_of(own))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), pa.array(at_i, pa.int64()), pa.array(at_j, pa.int64()), pa.array(out, pa.binary())], names=["g", "i", "j", "geom"])

    kind = polygons.schema[group].dataType.simpleString()
    cut = polygons.select(group, geom).mapInArrow(spread, f"g {kind}, i long, j long, geom binary")
    return cut.distinct()


def square_unions(polygons: DataFrame, group: str, cell: float, geom: str = "geom") -> DataFrame:
    """(g, i, j, area, edges): the union of a group's polygons in each square, and its boundary, the square's sides included."""
    kind = polygons.schema[group].dataType.simpleString()
    names = ["g", "i", "j", "area", "edges"]

    def unite(batches_of_rows):
        for table in runs(batches_of_rows, ("g", "i", "j")):
            starts = run_starts(table, ("g", "i", "j"))
            ends = np.append(starts[1:], len(table))
            squares = table.select(["g", "i", "j"]).take(pa.array(starts))
            raw = table.column("geom").to_pylist()
            single = np.flatnonzero(ends - starts == 1)
            areas, edges = lone([raw[k] for k in starts[single].tolist()])
            found = dict(zip(single.tolist(), zip(areas, edges, strict=True), strict=True))
            i, j = squares.column("i").to_pylist(), squares.column("j").to_pylist()
            for k in range(len(starts)):
                if found.get(k, (None,))[0] is None:
                    parts = [p for v in raw[starts[k] : ends[k]] for p in geometry.parts_of(v)]
                    area, own = united(parts, i[k] * cell, j[k] * cell, (i[k] + 1) * cell, (j[k] + 1) * cell)
                    found[k] = area, own
            each = [found[k] for k in range(len(starts))]
            flat = np.concatenate([np.zeros((0, 4)), *[e for _, e in each]])
            points = pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(flat) + 1, 4), pa.int32()), pa.array(flat.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(e) for _, e in each])), pa.int32()), points)
            for batch in pa.Table.from_arrays([*squares.columns, pa.array([float(a) for a, _ in each], pa.float64()), lists], names=names).to_batches():
                yield batch

    dealt = pieces(polygons, group, cell, geom).repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return dealt.mapInArrow(unite, f"g {kind}, i long, j long, area double, edges array<array<double>>")


def run_starts(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Where rows with other keys than the row before begin, in a table sorted by keys."""
    new = np.zeros(max(len(table) - 1, 0), bool)
    for c in keys:
        code = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy(zero_copy_only=False)
        new |= np.diff(code) != 0
    return np.append(0, 1 + np.flatnonzero(new)) if len(table) else np.zeros(0, int)


def runs(rows, keys: tuple[str, ...]):
    """Tables that hold whole runs of rows with equal keys, of a sorted stream of batches."""
    held: list[pa.Table] = []
    for batch in rows:
        held.append(pa.Table.from_batches([batch]))
        edge = held if len(held) == 1 else [held[-2].slice(len(held[-2]) - 1), held[-1]]
        starts = run_starts(pa.concat_tables(edge), keys) - (len(edge) - 1)
        starts = starts[starts >= 0] if len(held) > 1 else starts[1:]
        if not len(batch):
            held.pop()
        elif len(starts):  # the last run may go on in the next batch
            table = pa.concat_tables([*held[:-1], held[-1].slice(0, starts[-1])])
            held = [held[-1].slice(starts[-1])]
            if len(table):
                yield table
    if held:
        yield pa.concat_tables(held)


def lone(values: list) -> tuple[list, list]:
    """Areas and boundaries (the inside to the left) of polygons of one sound ring each; None for others."""
    areas, edges = [None] * len(values), [None] * len(values)
    for at, parts, _ in batches.layouts(values)[0]:
        if len(parts) != 1 or len(parts[0]) != 1 or not 4 <= parts[0][0].shape[1] <= batches.MOST_SIDES + 1:
            continue
        rings = parts[0][0]
        size = batches.shoelaces(rings)[:, 0]
        good = np.flatnonzero(batches.sound(rings) & (batches.contacts(rings)[0] == 0) & (size != 0) & (np.abs(np.diff(rings, axis=1)).max(2).min(1) > 10 * SNAP))
        turned = np.where((size[good] < 0)[:, None, None], rings[good][:, ::-1], rings[good])
        sides = np.concatenate([turned[:, :-1], turned[:, 1:]], 2)
        for n, k in enumerate(at[good].tolist()):
            areas[k], edges[k] = abs(size[good[n]]), sides[n]
    return areas, edges


def union_areas(polygons: DataFrame, group: str, cell: float, geom: str = "geom") -> DataFrame:
    """(group, area) of the union of each group's polygons: what overlaps counts once, and no two polygons meet but in a square.

    cell is the side of the squares into which the plane is dealt, in the polygons' units; the result doesn't depend on it.
    A group whose geometries can't be read has no row.
    """
    squares = square_unions(polygons, group, cell, geom)
    return squares.groupBy(F.col("g").alias(group)).agg(F.sum("area").alias("area"))


def without_sides(squares: DataFrame) -> DataFrame:
    """(g, x0, y0, x1, y1): the edges of `square_unions` without what two squares share.

    Upright and level edges lie on lines; along each line, what one side's edges run up and the other's run down
    cancels. Other edges are inside squares and stay.
    """
    kind = squares.schema["g"].dataType.simpleString()
    each = squares.select("g", F.explode("edges").alias("e")).select("g", *[F.get("e", F.lit(k)).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))])
    on = lambda axis, c: F.struct(F.lit(axis).alias("axis"), F.round(F.col(c) / SNAP).alias("at"))
    line = F.when(F.abs(F.col("x0") - F.col("x1")) <= SNAP, on(0, "x0")).when(F.abs(F.col("y0") - F.col("y1")) <= SNAP, on(1, "y0"))
    each = each.withColumn("line", line)

    def cancel(table):
        e = np.stack([table.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")], 1)
        along = 1 - table.column("line")[0].as_py()["axis"]
        at = e[0, 1 - along]
        p, q = e[:, along], e[:, 2 + along]
        up = [(a, b) for a, b in zip(p, q, strict=True) if a < b]
        left = one_sided(up, [(b, a) for a, b in zip(p, q, strict=True) if b < a])
        ends = np.array(left).reshape(-1, 2)
        fixed = np.full(len(ends), at)
        columns = [fixed, ends[:, 0], fixed, ends[:, 1]] if along else [ends[:, 0], fixed, ends[:, 1], fixed]
        return pa.Table.from_arrays([pa.chunked_array([table.column("g").slice(0, 1).combine_chunks().take(pa.array([0] * len(ends), pa.int64()))]), *map(pa.array, columns)], names=["g", "x0", "y0", "x1", "y1"])

    schema = f"g {kind}, x0 double, y0 double, x1 double, y1 double"
    lines = each.where("line is not null").groupBy("g", "line").applyInArrow(cancel, schema)
    return lines.unionByName(each.where("line is null").drop("line"))


def places_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each value's run of values within SNAP of the next, and a value for each run."""
    order = np.argsort(values, kind="stable")
    run = np.append(0, np.cumsum(np.diff(values[order]) > SNAP))
    number = np.empty(len(values), int)
    number[order] = run
    return number, values[order][np.searchsorted(run, np.arange(run[-1] + 1))]


def traced(edges: np.ndarray) -> list[list[np.ndarray]]:
    """Polygons whose boundary is these edges, the inside to the left; where rings touch, they turn left."""
    if not len(edges):
        return []
    nx, xs = places_of(edges[:, [0, 2]].ravel())
    ny, ys = places_of(edges[:, [1, 3]].ravel())
    node = (nx * (len(ys) + 1) + ny).reshape(-1, 2)
    edges, node = edges[node[:, 0] != node[:, 1]], node[node[:, 0] != node[:, 1]]
    after: dict[int, list[int]] = {}
    for k, a in enumerate(node[:, 0].tolist()):
        after.setdefault(a, []).append(k)
    angle = np.arctan2(edges[:, 3] - edges[:, 1], edges[:, 2] - edges[:, 0])
    used, rings = np.zeros(len(edges), bool), []
    for start in range(len(edges)):
        if used[start]:
            continue
        path, k = [], start
        while not used[k]:
            used[k] = True
            path.append(k)
            left = [m for m in after.get(int(node[k, 1]), ()) if not used[m]]
            if not left:
                break
            k = max(left, key=lambda m: (angle[m] - angle[k] + np.pi) % (2 * np.pi))  # noqa: B023
        points = np.stack([xs[node[path, 0] // (len(ys) + 1)], ys[node[path, 0] % (len(ys) + 1)]], 1)
        ring = without_straight(points)
        if len(ring) > 2:
            rings.append(geometry.closed(list(ring)))
    outer = [r for r in rings if geometry.shoelace(r)[0] > 0]
    polygons = [[r] for r in sorted(outer, key=lambda r: abs(geometry.shoelace(r)[0]))]
    for hole in (r for r in rings if geometry.shoelace(r)[0] < 0):
        middle = (hole[0] + hole[1]) / 2
        step = np.array([hole[1, 1] - hole[0, 1], hole[0, 0] - hole[1, 0]])
        inner = middle + step / np.hypot(*step) * 10 * SNAP  # just to the right of the hole's edge, in the hole
        for p in polygons:  # the least that holds it
            if geometry.contains([[p[0]]], *inner):
                p.append(hole)
                break
    return polygons


def without_straight(points: np.ndarray) -> np.ndarray:
    """A ring's points less those on a straight line between their neighbours."""
    while len(points) > 2:
        a, b = points - np.roll(points, 1, 0), np.roll(points, -1, 0) - points
        size = np.hypot(*a.T) * np.hypot(*b.T)
        bent = np.abs(a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]) > 1e-9 * np.maximum(size, SNAP)
        if bent.all():
            break
        points = points[bent]
    return points


def dissolved(polygons: DataFrame, group: str, cell: float, geom: str = "geom") -> DataFrame:
    """(group, geom, area): the union of each group's polygons as one geometry (well-known binary), and its area.

    Squares of side `cell` are united each by itself and their common sides cancelled line by line; a group's
    boundary, which its geometry has to hold anyway, is then traced. A group whose geometries can't be read has no row.
    """
    squares = Saved(polygons.sparkSession, "dissolved").table(square_unions(polygons, group, cell, geom), "squares")
    kind = polygons.schema[group].dataType.simpleString()

    def trace(table):
        edges = np.stack([table.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")], 1)
        found = traced(edges)
        return pa.Table.from_arrays([table.column("g").slice(0, 1), pa.array([geometry.wkb_of(found) if found else None], pa.binary())], names=["g", "geom"])

    shapes = without_sides(squares).groupBy("g").applyInArrow(trace, f"g {kind}, geom binary")
    areas = squares.groupBy("g").agg(F.sum("area").alias("area"))
    return shapes.join(areas, shapes["g"].eqNullSafe(areas["g"])).select(shapes["g"].alias(group), "geom", "area")
