"""Queries over polygons' measures and parts, mosaics of images, and the order of reports, each with the SQL that gives the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixtures import view, with_views
from tessera.operators import clouds, components, coverage, detection, geometry, inventory, overlay, radar, tiles, zonal
from tessera.operators.shared import numbered
from tessera.sources import radar as scenes

from .control import SOURCES, THERE
from .ground import FLAGGED, HALVES, RASTER, SCENE, SIDE, crossed, diagonal_triangles, flagged_scene, scene, site_raster

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return add


def ring(*points):
    return F.array(*[F.array(*p) for p in (*points, points[0])])


def corners():
    """x0, y0, x1, y1 of the polygons in degrees, as doubles."""
    return [F.col(c).cast("double") / 3600 for c in ("x0", "y0", "x1", "y1")]


#: Shapes by key: crossing, without an area, unreadable, else triangles; their corners in degrees.
KIND = "case when k % 7 = 0 then 'crossing' when k % 11 = 0 then 'flat' when k % 13 = 0 then 'none' else 'plain' end"


@query("polygon_measures", f"""with recursive p as (select k, {KIND} as kind, x0 / 3600.0 as x0, y0 / 3600.0 as y0, x1 / 3600.0 as x1, y1 / 3600.0 as y1 from v_polys),
  v as (select k, kind, i, [x0, x1, x1, x0, x0][i] as x, case kind when 'crossing' then [y0, y1, y0, (y0 + y1) / 2, y0][i] when 'flat' then y0 else [y0, y0, y1, y0, y0][i] end as y from p, (select unnest(range(1, 6)) as i) where kind <> 'none'),
  l as (select distinct y as lat, radians(y) as phi from v), t(lat, phi, theta, n) as (select lat, phi, phi, 0 from l union all select lat, phi, theta - (2 * theta + sin(2 * theta) - pi() * sin(phi)) / (2 + 2 * cos(2 * theta)), n + 1 from t where n < 12),
  m as (select v.*, 6378137.0 * 2 * sqrt(2) / pi() * radians(x) * cos(theta) as mx, 6378137.0 * sqrt(2) * sin(theta) as my from v join t on t.lat = v.y and t.n = 12),
  e as (select *, x - first(x) over w as ox, y - first(y) over w as oy, lead(x) over w - first(x) over w as px, lead(y) over w - first(y) over w as py, mx - first(mx) over w as omx, my - first(my) over w as omy, lead(mx) over w - first(mx) over w as pmx, lead(my) over w - first(my) over w as pmy, first(x) over w as fx, first(y) over w as fy
    from m window w as (partition by k order by i)),
  s as (select k, any_value(kind) as kind, any_value(fx) as fx, any_value(fy) as fy, sum(ox * py - px * oy) / 2 as a, sum((ox + px) * (ox * py - px * oy)) / 6 as ax, sum((oy + py) * (ox * py - px * oy)) / 6 as ay, abs(sum(omx * pmy - pmx * omy) / 2) as metres from e where px is not null group by 1)
  select p.k, case p.kind when 'none' then 'wkb_parse_error' when 'flat' then 'zero_area' when 'crossing' then 'invalid_but_repairable' else 'ok' end as status, case when s.kind <> 'flat' then round(metres / 10000, 3) end as hectares,
    case when s.kind <> 'flat' then round(fx + ax / a, 7) end as cx, case when s.kind <> 'flat' then round(fy + ay / a, 7) end as cy from p left join s using (k)""")
def polygon_measures(spark, d):
    """What each geometry is, its hectares on the equal-area projection, and its centre; SQL projects the corners by Newton's method."""
    x0, y0, x1, y1 = corners()
    kind = F.expr(KIND)
    shape = F.when(kind == "crossing", F.array(ring((x0, y0), (x1, y1), (x1, y0), (x0, (y0 + y1) / 2)))).when(kind == "flat", F.array(ring((x0, y0), (x1, y0), (x1, y0)))).otherwise(F.array(ring((x0, y0), (x1, y0), (x1, y1))))
    polygons = view(spark, d, "v_polys").select("k", F.when(kind != "none", F.array(shape)).alias("shape")).repartition(spark.sparkContext.defaultParallelism, "k")
    found = geometry.described(polygons.select("k", geometry.wkb(F.col("shape")).alias("geom")))
    return found.select("k", "status", F.round("hectares", 3).alias("hectares"), F.round("cx", 7).alias("cx"), F.round("cy", 7).alias("cy"))


@query("tile_overlap", f"select k, cast(floor(i / 40) as int) as x_tile, cast(floor(j / 40) as int) as y_tile, round(count(*) / 2, 6) as area from {HALVES.replace('select framework_key, plantstart, x + i', 'select k, framework_key, plantstart, x + i').replace('from (select framework_key', 'from (select k, framework_key')} group by 1, 2, 3")
def tile_overlap(spark, d):
    """The area of each polygon in each tile that it has a part of; SQL counts half squares."""
    near = diagonal_triangles(spark, d).select("k", "geom", F.inline(geometry.cells_met(F.col("geom"), 40.0)))
    w, s = F.col("i") * 40.0, F.col("j") * 40.0
    area = geometry.tile_overlap(F.col("geom"), w, s, w + 40, s + 40)
    return near.select("k", F.col("i").alias("x_tile"), F.col("j").alias("y_tile"), F.round(area, 6).alias("area")).where("area > 0")


@query("polygon_parts", """select k, i as part_idx, case when i = 0 then 'ok' when k % 5 = 0 then 'zero_area' else 'ok' end as status, case when i = 0 then round((x0 + 2.0 * x1) / 3, 6) when k % 5 <> 0 then round((x0 + 2.0 * x1) / 3 + 400, 6) end as cx
  from (select k, cast(unnest(range(case when k % 3 = 0 then 1 else 2 end)) as int) as i, x0, x1 from v_polys)""")
def polygon_parts(spark, d):
    """The parts of multipolygons, each described by itself; some have no area."""
    x0, y0, x1, y1 = [F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]
    first = F.array(ring((x0, y0), (x1, y0), (x1, y1)))
    second = F.when(F.col("k") % 5 == 0, F.array(ring((x0, y0), (x1, y0), (x1, y0)))).otherwise(F.array(ring((x0 + 400, y0), (x1 + 400, y0), (x1 + 400, y1))))
    polygons = view(spark, d, "v_polys").select("k", "x0", "y0", "x1", "y1").repartition(spark.sparkContext.defaultParallelism, "k")  # the table is one file
    polygons = polygons.select("k", geometry.wkb(F.when(F.col("k") % 3 == 0, F.array(first)).otherwise(F.array(first, second))).alias("geom"))
    found = geometry.described(geometry.exploded(polygons))
    return found.select("k", "part_idx", "status", F.round("cx", 6).alias("cx"))


@query("untangled_areas", """select k, 'ok' as status, round(case when k % 2 = 0 then (x1 - x0) * (y1 - y0) / 4.0 else (x1 - x0) * (y1 - y0) / 2.0 end, 3) as area from v_polys""")
def untangled_areas(spark, d):
    """Bow ties, of which one of the two equal lobes is kept, and triangles as they are."""
    x0, y0, x1, y1 = [F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]
    shape = F.when(F.col("k") % 2 == 0, ring((x0, y0), (x1, y1), (x1, y0), (x0, y1))).otherwise(ring((x0, y0), (x1, y0), (x1, y1)))
    polygons = view(spark, d, "v_polys").select("k", shape.alias("shape")).repartition(spark.sparkContext.defaultParallelism, "k")
    polygons = polygons.select("k", geometry.wkb(F.array(F.array("shape"))).alias("geom"))
    mended = polygons.select("k", geometry.repair(F.col("geom")).alias("geom"))
    return overlay.union_areas(mended, "k", 100_000.0).join(geometry.described(mended), "k").select("k", "status", F.round("area", 3).alias("area"))


@query("aligned_mosaic", f"""with p as (select tile, t, r, c, b0 as v, case when b1 > 0.25 then 1.0 when b1 > 0.15 then 0.5 else 0.0 end as w from {SCENE}),
  o as (select *, case when w < 1 then v end as clear from p), q as (select *, (sum(clear) over x - coalesce(clear, 0)) / nullif(count(clear) over x - case when clear is null then 0 else 1 end, 0) as others from o window x as (partition by tile, r, c)),
  s as (select tile, t, median(others) as mr, stddev_pop(others) as sr, median(v) as mv, stddev_pop(v) as sv from q where w < 0.25 and others is not null group by 1, 2),
  f as (select p.*, v * coalesce(sr / nullif(sv, 0), 1.0) + coalesce(mr - mv * coalesce(sr / nullif(sv, 0), 1.0), 0.0) as fit from p left join s using (tile, t))
  select tile, r, c, round(least(greatest(coalesce(sum(fit * (1 - w)) / nullif(sum(1 - w), 0), quantile_cont(v, 0.1)), min(v)), max(v)), 6) as v from f group by 1, 2, 3""")
def aligned_mosaic(spark, d):
    """A mosaic of each tile's images, each first given the median and spread that the others have where it is clear."""
    weight = F.when(F.col("b1") > 0.25, 1.0).when(F.col("b1") > 0.15, 0.5).otherwise(0.0)
    p = scene(spark, d).select("tile", "t", "r", "c", F.col("b0").alias("v"), weight.alias("interp"))
    return clouds.aligned_mosaic(p).withColumn("v", F.round("v", 6))


@query("bright_surfaces", f"""with b as (select tile, 0 as t, r, c, not count(*) filter (coalesce(b3 / nullif(b8 + 0.01, 0) < 0.9 and (b0 + b1 + b2) / 3 > 0.12 and least(greatest(2.5 * (n - q) / nullif(n + 6 * q - 7.5 * l + 1, 0), -1.5), 1.5) < 0.3, false)) > 1 as no
    from (select *, least(greatest(b0, 0), 1) as l, least(greatest(b2, 0), 1) as q, least(greatest(b3, 0), 1) as n from {SCENE}) group by 1, 3, 4),
  q as (select tile, t, r, c, not lost as kept from {crossed('b', 'no', 2, 'lost')}), g as (select tile, r, c, bare from {crossed('q', 'kept', 1, 'bare')})
  select a.tile, a.r, a.c, round(least(coalesce(min(sqrt((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c))), 3), 3) / 3, 6) as kept from g a left join g b on a.tile = b.tile and b.bare group by 1, 2, 3""")
def bright_surfaces(spark, d):
    """What is kept near bright bare ground, which shows in two images at least."""
    return clouds.bright_surfaces(scene(spark, d), least=0.12).select("tile", "r", "c", F.round("kept", 6).alias("kept"))


MOSAIC = f"(select 0 as tile, 0 as t, r, c, u8 / 255.0 as b0, u8 * 7 % 101 / 255.0 as b1, u8 * 3 % 97 / 300.0 as b2, u8 % 4 as clear, (r * 31 + c * 17) % 997 = 0 as false_cloud from {RASTER})"


@query("mosaic_clouds", f"""with m as {MOSAIC}, n as (select * exclude far, clear < 2 or far as doubt, far from {crossed('m', 'false_cloud', 10, 'far')}), l as (select quantile_cont(b0, 0.99) as blue, quantile_cont(b2, 0.99) as red from n where not doubt),
  q as (select n.*, not coalesce(b0 > 0.3 * blue and b2 > 0.3 * red and doubt and b0 + b1 + b2 < 1 and not far, false) as lost from n, l), k as (select tile, t, r, c, not gone as kept from {crossed('q', 'lost', 3, 'gone')})
  select r, c, cloud from {crossed('k', 'kept', 8, 'cloud')}""")
def mosaic_clouds(spark, d):
    """Clouds left in a mosaic of all tiles, where few images were clear; limits are lower than in a run, so that some are left."""
    u = F.col("u8")
    mosaic = site_raster(spark, d).select(
        F.lit(0).alias("tile"), "r", "c", (u / 255).alias("b0"), (u * 7 % 101 / 255).alias("b1"), (u * 3 % 97 / 300).alias("b2"), (u % 4).alias("clear"), ((F.col("r") * 31 + F.col("c") * 17) % 997 == 0).alias("false_cloud")
    )
    return clouds.clouds_left(mosaic, 0.3).select("r", "c", "cloud")


@query("white_clouds", f"select tile, t, r, c, cloud and not coalesce((b0 + b1 + b2) / 3 < 0.4 and (greatest(b0, b1, b2) - least(b0, b1, b2)) / nullif((b0 + b1 + b2) / 3, 0) > 0.5, false) as cloud from {FLAGGED}")
def white_clouds(spark, d):
    return detection.white_only(flagged_scene(spark, d)).select("tile", "t", "r", "c", "cloud")


@query("cluster_order", """with recursive m as (select k, project_id, x_tile, y_tile from v_polys, v_grid where x0 <= x_tile * 200 + 200 and x1 >= x_tile * 200 and y0 <= y_tile * 200 + 200 and y1 >= y_tile * 200),
  e as (select distinct a.k as a, b.k as b from m a join m b using (project_id, x_tile, y_tile)), c(k, other) as (select distinct k, k from m union select c.k, e.b from c join e on c.other = e.a),
  l as (select k, min(other) as cluster from c group by k), n as (select cluster, count(*) as members from l group by 1) select cluster, members, row_number() over (order by members desc, cluster) - 1 as n from n""")
def cluster_order(spark, d):
    """Clusters numbered from the largest on, of equally large ones from the least label."""
    p, g = view(spark, d, "v_polys").select("k", "project_id", "x0", "y0", "x1", "y1"), view(spark, d, "v_grid")
    found = components.largest_first(components.clusters(tiles.boxes_on_grid(p, g), "k", "project_id", "x_tile", "y_tile"))
    return numbered(found.withColumn("less", -F.col("members")), "less", "cluster").select("cluster", "members", "n")


@query("coverage_order", """with c as (select coalesce(short_name, project_id) as label, count(*) filter (ttc is null or len(map_keys(ttc)) = 0) as missing from v_polys group by 1) select label, missing, row_number() over (order by missing desc, label) - 1 as n from c""")
def coverage_order(spark, d):
    found = coverage.coverage(view(spark, d, "v_polys")).withColumn("less", -F.col("missing"))
    return numbered(found, "less", "label").select("label", "missing", "n")


@query("existing_and_missing", THERE + "select year, x_tile, y_tile, s1 and dem as existing from k")
def existing_and_missing(spark, d):
    """All tiles, told apart by whether their sources are there: the two parts make up the whole."""
    whole, objects = view(spark, d, "v_tiles"), view(spark, d, "v_inventory")
    ready = inventory.ready(whole, objects, SOURCES).select("year", "x_tile", "y_tile")
    return ready.withColumn("existing", F.lit(True)).unionByName(whole.join(ready, ["year", "x_tile", "y_tile"], "left_anti").select("year", "x_tile", "y_tile").withColumn("existing", F.lit(False)))


@query("without_infinity", "select seq, case when seq % 5 = 0 then 0.0 when seq % 7 = 0 then 0.0 else v end as v from v_series")
def without_infinity(spark, d):
    """Infinite values of either sign become 0."""
    v = F.when(F.col("seq") % 5 == 0, F.lit(float("inf"))).when(F.col("seq") % 7 == 0, F.lit(float("-inf"))).otherwise(F.col("v"))
    return view(spark, d, "v_series").select("seq", zonal.no_infinity(v).alias("v"))


@query("scene_angles", """select scene_id, case when scene_id % 3 = 0 then 35.0 when scene_id % 3 = 1 then round(20 + cloud, 6) else 35.0 end as incidence, case when orbit = 'ascending' then round(pi() / 2, 9) else round(3 * pi() / 2, 9) end as look,
  case when scene_id % 2 = 0 then concat('https://data.s3.eu-central-1.amazonaws.com/', scene_id, '/vv.tiff?key=1') else concat('https://x.org/', scene_id, '?key=1') end as address from v_scenes""")
def scene_angles(spark, d):
    """Incidence from a scene's properties, where they say one that can be read, the look angle of its orbit, and a signed web address."""
    s, key = view(spark, d, "v_scenes"), F.lit("view:incidence_angle")
    said = F.when(F.col("scene_id") % 3 == 1, F.create_map(key, F.round(20 + F.col("cloud"), 6).cast("string"))).when(F.col("scene_id") % 3 == 2, F.create_map(key, F.lit("steep"))).otherwise(F.create_map(F.lit("other"), F.lit("1")))
    name = F.col("scene_id").cast("string")
    address = F.when(F.col("scene_id") % 2 == 0, F.concat(F.lit("s3://data/"), name, F.lit("/vv.tiff"))).otherwise(F.concat(F.lit("https://x.org/"), name, F.lit("?old=2")))
    return s.select("scene_id", F.round(scenes.incidence(said), 6).alias("incidence"), F.round(scenes.look_angle(F.col("orbit")), 9).alias("look"), scenes.signed(scenes.web_address(address), "?key=1").alias("address"))


#: Points of tables over the raster of all tiles, eight by eight of them; the raster has 8 * side pixels on a side.
STEPS = f"(select cast(ceil((8 * side - 1) / 7.0) as int) as step, side from {SIDE})"
LUT = f"(select r * step as line, c * step as pixel, avg(u8) as v from v_patch, {STEPS} group by 1, 2)"


@query("radar_band", f"""with p as {LUT}, i as (select s.*, step from {RASTER} s, {STEPS}),
  n as (select r, c, arg_min(v, [(r - line) * (r - line) + (c - pixel) * (c - pixel), pixel, line]) as v from i, p where line < 8 * (select side from {STEPS}) and pixel < 8 * (select side from {STEPS}) group by 1, 2),
  o as (select i.*, least(floor(r / step), 6) * step as l, least(floor(c / step), 6) * step as k from i),
  b as (select r, c, sum((20 + v / 10) * case when line = l then 1 - (r - l) / step::double else (r - l) / step::double end * case when pixel = k then 1 - (c - k) / step::double else (c - k) / step::double end) as degrees
    from o join p on line in (l, l + step) and pixel in (k, k + step) group by 1, 2),
  g as (select i.r, i.c, greatest(u8::double * u8 - v / 2, 0) / ((2 * v + 100) * (2 * v + 100)) * 9 as gamma, degrees, u8 / 400.0 as slope, u8 % 7 as aspect from i join n using (r, c) join b using (r, c)),
  f as (select *, cos(slope) * cos(radians(degrees)) + sin(slope) * sin(radians(degrees)) * cos(aspect - pi() / 2) as cosl from g)
  select r, c, cast(floor(round(least(greatest(case when cosl >= 0.2 then gamma * cos(radians(degrees)) / greatest(cosl, 0.1) else 0 end, 0), 1) * 65535, 6)) as int) as v from f""")
def radar_band(spark, d):
    """The raster of all tiles as a radar image: calibrated, freed of noise and terrain."""
    side = view(spark, d, "v_patch").agg(F.ceil(F.sqrt(F.max("tile") + 1)).cast("int")).first()[0]
    step = math.ceil((8 * side - 1) / 7)
    points = view(spark, d, "v_patch").groupBy((F.col("r") * step).alias("line"), (F.col("c") * step).alias("pixel")).agg(F.avg("u8").alias("v"))
    image = site_raster(spark, d)
    value = lambda x: points.select("line", "pixel", x.alias("value"))
    v = F.col("v")
    # The table of calibration is a third of the number that SQL divides by, hence the 9 there.
    terrain = image.select("r", "c", (F.col("u8") / 400).alias("slope"), (F.col("u8") % 7).alias("aspect"))
    return radar.terrain_corrected(
        image.withColumnRenamed("u8", "dn"), 8 * side, 8 * side, scenes.look_angle(F.lit("ascending")), value((2 * v + 100) / 3), value(v / 2), value(20 + v / 10), terrain
    )
