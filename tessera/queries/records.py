"""Queries over footprints, tables at pixels, boxes, regions and records, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixtures import view, with_views
from tessera.functions import scalars as S
from tessera.functions.scalars import ARD_SOURCES
from tessera.operators import geometry, patching, radar, scenes, tracking, zonal
from tessera.plans import runs

from .pixels import INTERVAL, centres

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return add


FOOTPRINT = "select tile, acquired, scene_id * 37 % 80 - 20 as w, scene_id * 53 % 80 - 20 as s, scene_id * 37 % 80 + 10 + scene_id % 30 as e, scene_id * 53 % 80 + 10 + scene_id % 25 as n from v_scenes"


@query("daily_coverage", f"""with f as ({FOOTPRINT}), x as (select *, unnest(range(greatest(w, 0), greatest(least(e, 60), greatest(w, 0)))) as x from f), y as (select *, unnest(range(greatest(s, 0), greatest(least(n, 60), greatest(s, 0)))) as y from x),
  u as (select tile, acquired, count(*) / 3600.0 as share from (select distinct tile, acquired, x, y from y) group by 1, 2)
  select distinct f.tile, cast(cast(f.acquired as date) as varchar) as day, round(coalesce(share, 0), 6) as share from f left join u on u.tile = f.tile and u.acquired = f.acquired""")
def daily_coverage(spark, d):
    """The part of a tile of 60 x 60 units that a day's footprints cover together; SQL counts the units."""
    s = F.col("scene_id")
    feet = view(spark, d, "v_scenes").select(
        "tile", F.col("acquired").cast("string").alias("day"), (s * 37 % 80 - 20).cast("double").alias("w"), (s * 53 % 80 - 20).cast("double").alias("s"),
        (s * 37 % 80 + 10 + s % 30).cast("double").alias("e"), (s * 53 % 80 + 10 + s % 25).cast("double").alias("n"),
    )
    tile = F.struct(*[F.lit(x).alias(name) for name, x in (("w", 0.0), ("s", 0.0), ("e", 60.0), ("n", 60.0))])
    return radar.covered_share(feet, ["tile", "day"], tile).withColumn("share", F.round("share", 6))


POINTS = "(select r * 3 as line, c * 5 as pixel, avg(u8) as v from v_patch group by 1, 2)"


def points(spark, d):
    return view(spark, d, "v_patch").groupBy((F.col("r") * 3).alias("line"), (F.col("c") * 5).alias("pixel")).agg(F.avg("u8").alias("v"))


@query("grid_interpolated", f"""with p as {POINTS}, o as (select r, c, least(floor(r / 3), 6) * 3 as l, least(floor(c / 5), 6) * 5 as k from (select unnest(range(24)) as r), (select unnest(range(40)) as c))
  select cast(r as int) as r, cast(c as int) as c, round(sum(v * case when line = l then 1 - (r - l) / 3.0 else (r - l) / 3.0 end * case when pixel = k then 1 - (c - k) / 5.0 else (c - k) / 5.0 end), 6) as v from o join p on line in (l, l + 3) and pixel in (k, k + 5) group by 1, 2""")
def grid_interpolated(spark, d):
    return radar.interpolated(points(spark, d), "v", 24, 40, 35.0).withColumn("v", F.round("v", 6))


@query("nearest_calibration", f"""with p as {POINTS}, o as (select r, c, v, row_number() over (partition by r, c order by (r - line) * (r - line) + (c - pixel) * (c - pixel), pixel, line) as k from (select unnest(range(24)) as r), (select unnest(range(40)) as c), p)
  select cast(r as int) as r, cast(c as int) as c, round(v, 6) as v from o where k = 1""")
def nearest_calibration(spark, d):
    return radar.nearest_values(points(spark, d), "v", 24, 40).withColumn("v", F.round("v", 6))


@query("grown_boxes", """with b as (select x_tile, y_tile, x_tile / 18.0 - 1 / 36.0 as w, y_tile / 18.0 - 1 / 36.0 as s, x_tile / 18.0 + 1 / 36.0 as e, y_tile / 18.0 + 1 / 36.0 as n from v_grid),
  m as (select *, 6378137.0 * radians(w) - 500 as mw, 6378137.0 * ln(tan(pi() / 4 + radians(s) / 2)) - 500 as ms, 6378137.0 * radians(e) + 500 as me, 6378137.0 * ln(tan(pi() / 4 + radians(n) / 2)) + 500 as mn from b)
  select x_tile, y_tile, round(w - 4 / 360.0, 8) as west, round(s - 4 / 360.0, 8) as south, round(e + 4 / 360.0, 8) as east, round(n + 4 / 360.0, 8) as north, round(degrees(mw / 6378137.0), 8) as metres_west, round(degrees(2 * atan(exp(ms / 6378137.0)) - pi() / 2), 8) as metres_south,
    round(degrees(me / 6378137.0), 8) as metres_east, round(degrees(2 * atan(exp(mn / 6378137.0)) - pi() / 2), 8) as metres_north, """ + ", ".join(f"round({c}, 8) as ring_{i}" for i, c in enumerate("w s e s e n w n w s".split())) + " from m")
def grown_boxes(spark, d):
    """All sides of grown boxes, and all corners of the rings around them."""
    box = S.tile_box(F.col("x_tile") / 18.0, F.col("y_tile") / 18.0)
    g = view(spark, d, "v_grid").select("x_tile", "y_tile", S.expanded(box, 4).alias("a"), S.buffered(box, 500.0).alias("b"), F.flatten(S.ring(box)).alias("ring"))
    sides = {"w": "west", "s": "south", "e": "east", "n": "north"}
    grown = [F.round(f"{x}.{c}", 8).alias(f"{prefix}{name}") for x, prefix in (("a", ""), ("b", "metres_")) for c, name in sides.items()]
    return g.select("x_tile", "y_tile", *grown, *[F.round(F.get("ring", F.lit(i)), 8).alias(f"ring_{i}") for i in range(10)])


#: Countries of sub-regions in the sites' units of degree; 'east' has two, 'lost' has no interval.
COUNTRIES = [("east", 5000.3, 0.3, 10500.3, 4000.3), ("east", 7000.3, 6000.3, 10500.3, 10500.3), ("west", 0.3, 0.3, 5500.3, 10500.3), ("lost", 5000.3, 4000.3, 10500.3, 6000.3)]
CONFIDENCE = [("east", 0.8, 0.97, 0.75, 0.96), ("west", 0.74, 0.98, 0.7, 0.95), ("nowhere", 0.9, 0.99, 0.88, 0.97)]


@query("sub_regions", f"""with c(region, w, s, e, n) as (values {', '.join(map(str, COUNTRIES))}), i(region, pl, pu, rl, ru) as (values {', '.join(map(str, CONFIDENCE))}),
  p as (select k, (x0 + x1) / 2.0 as x, (y0 + y1) / 2.0 as y from v_polys), f as (select k, min(c.region) as region from p join c on x between w and e and y between s and n join i using (region) group by 1)
  select k, f.region, round(cast(pu - rl as double), 6) as below from p left join f using (k) left join i on i.region = f.region""")
def sub_regions(spark, d):
    rows = [(name, geometry.wkb_of([[geometry.closed([(w, s), (e, s), (e, n), (w, n)])]])) for name, w, s, e, n in COUNTRIES]
    countries = spark.createDataFrame(rows, "subregion string, geom binary")
    found = zonal.first_region(centres(spark, d), zonal.sub_regions(countries, spark.createDataFrame(CONFIDENCE, f"category string, {INTERVAL}")), "k")
    return found.select("k", "region", F.round(F.col("p_upper_95") - F.col("r_lower_95"), 6).alias("below"))


@query("within_bounds", """with b as (select min(x_tile) / 18.0 as w, min(y_tile) / 18.0 as s, max(x_tile) / 36.0 as e, max(y_tile) / 36.0 as n from v_grid),
  m as (select degrees((6378137.0 * radians(w) - 9000) / 6378137.0) as w, degrees((6378137.0 * radians(e) + 9000) / 6378137.0) as e, degrees(2 * atan(exp((6378137.0 * ln(tan(pi() / 4 + radians(s) / 2)) - 9000) / 6378137.0)) - pi() / 2) as s,
    degrees(2 * atan(exp((6378137.0 * ln(tan(pi() / 4 + radians(n) / 2)) + 9000) / 6378137.0)) - pi() / 2) as n from b)
  select x_tile, y_tile from v_grid, m where x_tile / 18.0 between w and e and y_tile / 18.0 between s and n""")
def within_bounds(spark, d):
    g = view(spark, d, "v_grid").select("x_tile", "y_tile", (F.col("x_tile") / 18.0).alias("lon"), (F.col("y_tile") / 18.0).alias("lat"))
    boxes = g.agg(F.min("lon").alias("w"), F.min("lat").alias("s"), (F.max("lon") / 2).alias("e"), (F.max("lat") / 2).alias("n"))
    return zonal.within_bounds(g, boxes, 9000.0).select("x_tile", "y_tile")


@query("quarter_scenes", """with r as (select *, row_number() over (partition by tile, year(acquired), quarter(acquired) order by coverage desc, acquired, scene_id) as rank from v_scenes where orbit = 'ascending')
  select scene_id, cast(rank as int) as rank from r where rank = 1 or (rank <= 3 and coverage >= 0.95)""")
def quarter_scenes(spark, d):
    return scenes.quarter_scenes(scenes.of_orbit(view(spark, d, "v_scenes"), "ASC"), 3).select("scene_id", "rank")


@query("drop_reasons", """select case when plantstart is null then 'no date' when ttc is null then 'no value' else 'other' end as reason, count(*) as n from v_polys where k % 7 <> 0 group by 1""")
def drop_reasons(spark, d):
    """Why polygons have no result, where every seventh has one."""
    p = view(spark, d, "v_polys")
    reason = F.when(F.col("plantstart").isNull(), "no date").when(F.col("ttc").isNull(), "no value").otherwise("other")
    return patching.drop_reasons(p, p.where("k % 7 = 0"), reason)


@query("scene_units", """select scene_id, case when year(acquired) = 1997 then cast(dayofyear(acquired) as int) end as day, least(greatest(scene_id % 13000 / 10000.0, 0), 1) as reflectance, case when cloud * 255 <= 100 then round(cloud * 255, 6) end as cloud from v_scenes""")
def scene_units(spark, d):
    return view(spark, d, "v_scenes").select("scene_id", S.day_in(F.col("acquired"), 1997).alias("day"), S.reflectance(F.col("scene_id") % 13000).alias("reflectance"), F.round(S.cloud_byte(F.col("cloud")), 6).alias("cloud"))


#: Errors and the names of their kinds, from the jobs' numbers.
ERRORS = ["", "HTTP 408", "Read timed out", "socket closed", "EOF", "Too many requests", "bad value", "code 404", "SSL handshake", "Slow down"]
KINDS = ["ValueError", "HTTPError", "ReadTimeout", "KeyError"]


@query("retry_classes", f"""with e as (select seq, [{', '.join(repr(e) for e in ERRORS)}][seq % 10 + 1] as error, [{', '.join(repr(k) for k in KINDS)}][cast(floor(seq / 10) as bigint) % 4 + 1] as kind from v_jobs)
  select seq, seq % 10 in (1, 2, 3, 4, 5, 8) or kind in ('HTTPError', 'ReadTimeout') as again from e""")
def retry_classes(spark, d):
    pick = lambda values, i: F.get(F.array(*map(F.lit, values)), i.cast("int"))
    seq = F.col("seq")
    return view(spark, d, "v_jobs").select("seq", tracking.retryable(pick(ERRORS, seq % 10), pick(KINDS, F.floor(seq / 10) % 4)).alias("again"))


#: A tile's key of each source, as the report shows it.
TILE_KEY = {"dem": "concat(year, '/raw/', x_tile, '/', y_tile, '/raw/misc/dem_', x_tile, 'X', y_tile, 'Y.hkl')", "s1": "concat(year, '/raw/', x_tile, '/', y_tile, '/raw/s1/', x_tile, 'X', y_tile, 'Y.hkl')"}
TEXT_LINES = ", chr(10), ".join(f"'  {s:<3}  ', rpad(case when {s} then 'present' else 'MISSING' end, 8, ' '), '  ', {TILE_KEY[s]}" for s in ARD_SOURCES if s in TILE_KEY)


@query("availability_text", f"""with t as (select *, (x_tile + y_tile) % 2 = 0 as dem, x_tile % 3 = 0 as s1, concat('Tile ', x_tile, 'X', y_tile, 'Y  |  year ', year, '  |  store') as head from v_tiles),
  r as (select *, repeat('-', greatest(48, length(head))) as rule from t)
  select year, x_tile, y_tile, concat(head, chr(10), rule, chr(10), {TEXT_LINES}, chr(10), rule, chr(10), 'Raw ARD:    ', dem::int + s1::int, '/2 sources present') as text from r""")
def availability_text(spark, d):
    """The whole report of each tile."""
    t = view(spark, d, "v_tiles").select("year", "x_tile", "y_tile", ((F.col("x_tile") + F.col("y_tile")) % 2 == 0).alias("dem"), (F.col("x_tile") % 3 == 0).alias("s1"))
    return runs.availability_text(t, "store")


@query("run_summary", """select 'r1' as run_id, (select lower(task_type) from v_jobs group by task_type order by count(*) desc, task_type limit 1) as step, count(*) as n_jobs, count(*) filter (status = 'success') as n_success, count(*) filter (status = 'partial') as n_partial,
  count(*) filter (status not in ('success', 'partial')) as n_failed, (select count(*) from (select distinct year, x_tile, y_tile from v_jobs where status not in ('success', 'partial'))) as n_failed_tiles from v_jobs""")
def run_summary(spark, d):
    return runs.run_summary(view(spark, d, "v_jobs"), "r1")
