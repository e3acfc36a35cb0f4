"""Queries over elevation, cloud masks, radar rasters, feature stacks and polygons, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.fixtures import view, with_views
from tessera.operators import clouds, components, detection, geometry, overlay, radar, raster, regression, stack, terrain, tiles, tracking, zonal

from tessera.plans import report

from .pixels import CATEGORY, INTERVAL, INTERVALS, RASTER, REGION, SIDE, centres, region_table, site_raster, tile_side

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return add


def patch(spark, d):
    return view(spark, d, "v_patch").select("tile", "r", "c", F.col("u8").cast("double").alias("v"))


def seen(n: int) -> str:
    """SQL of all (pixel, neighbour) pairs within n rows and columns, edges mirrored: tile, r, c, i, j, v."""
    fold = lambda x: f"case when {x} < 0 then -1 - ({x}) when {x} > 7 then 15 - ({x}) else {x} end"
    return f"""(select a.tile, a.r, a.c, a.i, a.j, cast(b.u8 as double) as v from (select tile, r, c, i, j, {fold('r + i')} as rr, {fold('c + j')} as cc from v_patch,
      (select unnest(range({-n}, {n + 1})) as i), (select unnest(range({-n}, {n + 1})) as j)) a join v_patch b on a.tile = b.tile and a.rr = b.r and a.cc = b.c)"""


@query("median_filter", f"select tile, r, c, median(v) as v from {seen(2)} group by 1, 2, 3")
def median_filter(spark, d):
    return terrain.median_filtered(patch(spark, d), "v").select("tile", "r", "c", "v")


@query("gaussian_filter", f"select tile, r, c, round(sum(v * exp(-2.0 * (i * i + j * j))) / sum(exp(-2.0 * (i * i + j * j))), 6) as v from {seen(2)} group by 1, 2, 3")
def gaussian_filter(spark, d):
    return terrain.smoothed(patch(spark, d), "v").select("tile", "r", "c", F.round("v", 6).alias("v"))


@query("local_variance", f"select tile, r, c, round(var_pop(v), 6) as variance from {seen(3)} group by 1, 2, 3")
def local_variance(spark, d):
    return terrain.local_variance(patch(spark, d), "v", "variance").select("tile", "r", "c", F.round("variance", 6).alias("variance"))


WINDOWS = "window x as (partition by tile, r order by c), y as (partition by tile, c order by r)"


@query("normal_slope", f"""with g as (select tile, r, c, (lead(u8) over x - lag(u8) over x) / 60.0 as dx, (lead(u8) over y - lag(u8) over y) / 40.0 as dy from v_patch {WINDOWS}),
  s as (select tile, r, c, coalesce(degrees(acos(1 / sqrt(1 + dx * dx + dy * dy))), 0) as s from g) select tile, r, c, round(case when s > 0 and s < 5 then 5 else s end, 6) as slope from s""")
def normal_slope(spark, d):
    return terrain.normal_slopes(patch(spark, d), "v", 30.0, 20.0, 5.0).select("tile", "r", "c", F.round("slope", 6).alias("slope"))


@query("plane_slope", """with w as (select a.tile, a.r, a.c, count(*) as n, regr_slope(b.u8, b.c * 30.0) as dx, regr_slope(b.u8, b.r * 20.0) as dy from v_patch a join v_patch b on a.tile = b.tile and abs(a.r - b.r) <= 2 and abs(a.c - b.c) <= 2 group by 1, 2, 3)
  select tile, r, c, round(case when n = 25 then degrees(atan(sqrt(dx * dx + dy * dy))) end, 6) as slope from w""")
def plane_slope(spark, d):
    return terrain.plane_slopes(patch(spark, d), "v", 30.0, 20.0, 2).select("tile", "r", "c", F.round("slope", 6).alias("slope"))


@query("slope_aspect", f"""with g as (select tile, r, c, (coalesce(lead(u8) over x, u8) - coalesce(lag(u8) over x, u8)) / case when lead(u8) over x is null or lag(u8) over x is null then 30.0 else 60.0 end as dx,
  (coalesce(lead(u8) over y, u8) - coalesce(lag(u8) over y, u8)) / case when lead(u8) over y is null or lag(u8) over y is null then 20.0 else 40.0 end as dy from v_patch {WINDOWS}),
  a as (select *, atan2(-dx, dy) as a from g) select tile, r, c, round(atan(sqrt(dx * dx + dy * dy)), 6) as slope, round(case when a < 0 then a + 2 * pi() else a end, 6) + 0.0 as aspect from a""")
def slope_aspect(spark, d):
    return terrain.slope_and_aspect(patch(spark, d), "v", 30.0, 20.0).select("tile", "r", "c", F.round("slope", 6).alias("slope"), (F.round("aspect", 6) + 0.0).alias("aspect"))


def bilinear(source: str, n: int, to: int) -> str:
    """SQL of tile, r, c, v: a raster (tile, r, c, v) of n x n pixels at `to` x `to`."""
    at = lambda o: f"least(greatest(({o} + 0.5) * {n} / {to}.0 - 0.5, 0), {n - 1})"
    return f"""(select tile, cast(o.r as int) as r, cast(p.c as int) as c, sum(v * greatest(1 - abs({at('o.r')} - s.r), 0) * greatest(1 - abs({at('p.c')} - s.c), 0)) as v
      from {source} s, (select unnest(range({to})) as r) o, (select unnest(range({to})) as c) p where abs({at('o.r')} - s.r) < 1 and abs({at('p.c')} - s.c) < 1 group by 1, 2, 3)"""


@query("bilinear_triple", f"select tile, r, c, round(v, 6) as v from {bilinear('(select tile, r, c, u8 as v from v_patch)', 8, 24)}")
def bilinear_triple(spark, d):
    return stack.zoomed(patch(spark, d), "v", 3).withColumn("v", F.round("v", 6))


BLOCKS = "(select tile, cast(floor(r / 2) as int) as r, cast(floor(c / 2) as int) as c, avg(u8) as v from v_patch group by 1, 2, 3)"


@query("short_wave_doubled", f"select tile, r, c, round(v, 6) as v from {bilinear(BLOCKS, 4, 16)}")
def short_wave_doubled(spark, d):
    return stack.short_wave_doubled(patch(spark, d), "v").withColumn("v", F.round("v", 6))


@query("radar_unsaturated", """with s as (select tile, r, c, least(u8 / 60.0, 1) as v from v_patch), m as (select tile, median(v) filter (v <> 1) as m from s group by 1)
  select tile, r, c, round(case when v = 1 then m else v end, 8) as v from s join m using (tile)""")
def radar_unsaturated(spark, d):
    p = patch(spark, d).withColumn("v", F.least(F.col("v") / 60.0, F.lit(1.0)))
    return stack.unsaturated(p, "v", ["tile"]).select("tile", "r", "c", F.round("v", 8).alias("v"))


@query("zeros_filled", """with s as (select label, tile as t, r, c, cast(case when u8 < 45 then 0 else u8 end as double) as v from v_patch), m as (select label, r, c, median(nullif(v, 0)) as m from s group by 1, 2, 3)
  select label, t, s.r, s.c, round(case when v = 0 then coalesce(m, 0) else v end, 6) as v from s join m using (label, r, c)""")
def zeros_filled(spark, d):
    p = view(spark, d, "v_patch").select("label", F.col("tile").alias("t"), "r", "c", F.when(F.col("u8") < 45, 0.0).otherwise(F.col("u8")).alias("v"))
    return stack.zeros_filled(p, ["label", "r", "c"], "v").select("label", "t", "r", "c", F.round("v", 6).alias("v"))


@query("radar_aligned", """with o as (select tile, rr, cc, case when rr = 0 then 0 when rr = 9 then 7 else rr - 1 end as r, cc + 1 as c from (select distinct tile from v_patch), (select unnest(range(10)) as rr), (select unnest(range(6)) as cc))
  select o.tile, cast(rr as int) as r, cast(cc as int) as c, cast(u8 as double) as v from o join v_patch p on p.tile = o.tile and p.r = o.r and p.c = o.c""")
def radar_aligned(spark, d):
    """10 rows of 8, the first and last again; 6 columns of 8, one cut off on either side."""
    return stack.aligned(patch(spark, d), "v", (8, 8), (10, 6))


def band_sql(name: str, steps: str, at: str) -> str:
    return f"(select vec_id as pixel, cast(t as int) as {name}, " + ", ".join(f"abs(cast(embedding[(t * {at} + {b} * 7) % 64 + 1] as double)) as b{b}" for b in range(10)) + f" from embeddings, (select unnest(range({steps})) as t))"


CL = lambda x: f"least(greatest({x}, 0), 1)"
INDEX = f"""select *, least(greatest(2.5 * (n - r) / nullif(n + 6 * r - 7.5 * b + 1, 0), -1.5), 1.5) as evi, least(greatest(((s + r) - (n + b)) / ((s + r) + (n + b) + 1e-5), -1), 1) as bi,
  least(greatest((2 * n + 1 - sqrt(greatest((2 * n + 1) * (2 * n + 1) - 8 * (n - r), 0))) / 2, -1), 1) as msavi2, (n - (g + r)) / (n + g + r + 1e-5) as grndvi
  from (select *, {CL('b0')} as b, {CL('b1')} as g, {CL('b2')} as r, {CL('b3')} as n, {CL('b8')} as s from {{}})"""
MEDIANS = ", ".join(f"round(median({c}), 6) as {c}" for c in [*stack.BANDS, *stack.INDICES])
RADAR = "(select vec_id as pixel, t as month, abs(cast(embedding[t * 3 % 64 + 1] as double)) as vv, abs(cast(embedding[(t * 3 + 1) % 64 + 1] as double)) as vh from embeddings, (select unnest(range(12)) as t))"


def bands(spark, d, name, steps, at):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("pixel"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias(name))
    return e.select("pixel", name, *[F.abs(F.get("embedding", (F.col(name) * at + b * 7) % 64).cast("double")).alias(f"b{b}") for b in range(10)])


@query("feature_stack", f"""with q as (select pixel, cast(floor(month / 3) as int) as frame, {MEDIANS} from ({INDEX.format(band_sql('month', '12', '5'))}) group by 1, 2 union all select pixel, 4, {MEDIANS} from ({INDEX.format(band_sql('image', '9', '11'))}) group by 1),
  s as (select pixel, cast(floor(month / 3) as int) as frame, round(median(vv), 6) as vv, round(median(vh), 6) as vh from {RADAR} group by 1, 2 union all select pixel, 4, round(median(vv), 6), round(median(vh), 6) from {RADAR} group by 1),
  e as (select vec_id as pixel, cast(label as double) as dem from embeddings) select q.pixel, q.frame, {', '.join(stack.CHANNELS)} from q join s on s.pixel = q.pixel and s.frame = q.frame join e on e.pixel = q.pixel""")
def feature_stack(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    months = e.select(F.col("vec_id").alias("pixel"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("month"))
    value = lambda i: F.abs(F.get("embedding", (F.col("month") * 3 + i) % 64).cast("double"))
    radar = months.select("pixel", "month", value(0).alias("vv"), value(1).alias("vh"))
    dem = e.select(F.col("vec_id").alias("pixel"), F.col("label").cast("double").alias("dem"))
    out = stack.feature_stack(bands(spark, d, "month", 12, 5), bands(spark, d, "image", 9, 11), radar, dem, ["pixel"])
    return out.select("pixel", "frame", *[c if c == "dem" else F.round(c, 6).alias(c) for c in stack.CHANNELS])


#: Images of 8 x 8 pixels with ten bands: a label's vectors are the images of a tile.
SCENE = "(select label as tile, vec_id as t, cast(floor(k / 8) as int) as r, cast(k % 8 as int) as c, " + ", ".join(f"abs(cast(embedding[(k + {b} * 6) % 64 + 1] as double)) as b{b}" for b in range(10)) + " from embeddings, (select unnest(range(64)) as k))"


def scene(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("label").alias("tile"), F.col("vec_id").alias("t"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k"))
    at = [F.floor(F.col("k") / 8).cast("int").alias("r"), (F.col("k") % 8).alias("c")]
    return e.select("tile", "t", *at, *[F.abs(F.get("embedding", (F.col("k") + b * 6) % 64).cast("double")).alias(f"b{b}") for b in range(10)])


RISE = lambda b, by: f"b{b} - min(b{b}) over (partition by tile, r, c order by t rows between 2 preceding and 2 following) > {by}"


@query("cloud_brightening", f"select tile, t, r, c, {RISE(0, 0.08)} and {RISE(1, 0.08)} and {RISE(2, 0.07)} as cloud from {SCENE}")
def cloud_brightening(spark, d):
    return clouds.brightening(scene(spark, d)).select("tile", "t", "r", "c", "cloud")


BELOW = lambda b, by: f"b{b} - median(b{b}) over (partition by tile, r, c order by t rows between 4 preceding and 2 following) < -{by}"


@query("cloud_shadows", f"""with w as (select *, median((b1 - b3) / nullif(b1 + b3, 0)) over (partition by tile, r, c) > 0 as water from {SCENE})
  select tile, t, r, c, {BELOW(7, 0.04)} and {BELOW(8, 0.04)} and {BELOW(0, 0.02)} and b0 < 0.09 and b7 < 0.17 and not coalesce(water, false) as shadow from w""")
def cloud_shadows(spark, d):
    return clouds.darkening(scene(spark, d)).select("tile", "t", "r", "c", "shadow")


def crossed(source: str, flag: str, n: int, out: str) -> str:
    """SQL of source with `out`: whether a flagged pixel of the image (tile, t) is within n steps."""
    return f"""(select a.*, exists (select 1 from {source} b where b.tile = a.tile and b.t = a.t and b.{flag} and abs(b.r - a.r) + abs(b.c - a.c) <= {n}) as {out} from {source} a)"""


@query("bright_clouds", f"""with p as (select tile, t, r, c, not coalesce(b7 > 0.166 and b1 > 0.05 and b5 / nullif(b8, 0) < 4.292, false) as no from {SCENE}), q as (select tile, t, r, c, not lost as kept from {crossed('p', 'no', 2, 'lost')})
  select tile, t, r, c, cloud from {crossed('q', 'kept', 10, 'cloud')}""")
def bright_clouds(spark, d):
    return clouds.bright_clouds(scene(spark, d), green=0.05).select("tile", "t", "r", "c", "cloud")


@query("cloud_nearness", f"""with p as (select tile, t, r, c, b0 > 0.28 as f from {SCENE})
  select a.tile, a.t, a.r, a.c, round(1 - least(coalesce(min(sqrt((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c))), 4), 4) / 4, 6) as near from p a left join p b on a.tile = b.tile and a.t = b.t and b.f group by 1, 2, 3, 4""")
def cloud_nearness(spark, d):
    flagged = scene(spark, d).select("tile", "t", "r", "c", (F.col("b0") > 0.28).alias("f"))
    return clouds.nearness(flagged, "f", 4, "near").select("tile", "t", "r", "c", F.round("near", 6).alias("near"))


@query("interpolation_weights", f"""with p as (select tile, t, r, c, b0 > 0.3 as f from {SCENE}),
  s as (select a.tile, a.t, a.r, a.c, 1 - least(coalesce(min(sqrt((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c))), 12), 12) / 12 as s from p a left join p b on a.tile = b.tile and a.t = b.t and b.f group by 1, 2, 3, 4),
  z as (select tile, t, r, c, case when s < 0.2 then 0 else s end as s from s), m as (select a.tile, a.t, a.r, a.c, max(b.s) as m from z a join z b on a.tile = b.tile and a.t = b.t and abs(a.r - b.r) <= 7 and abs(a.c - b.c) <= 7 group by 1, 2, 3, 4)
  select a.tile, a.t, a.r, a.c, round(min(b.m), 6) as interp from m a join m b on a.tile = b.tile and a.t = b.t and abs(a.r - b.r) <= 7 and abs(a.c - b.c) <= 7 group by 1, 2, 3, 4""")
def interpolation_weights(spark, d):
    flagged = scene(spark, d).select("tile", "t", "r", "c", (F.col("b0") > 0.3).alias("cloud"))
    return clouds.interpolation_weights(flagged).select("tile", "t", "r", "c", F.round("interp", 6).alias("interp"))


@query("cloud_levels", f"""with p as (select tile, t, r, c, b0 > 0.35 as far, b1 - 0.04 as score from {SCENE}), i as (select tile, t, count(*) as n, avg(far::int) as far from p group by 1, 2),
  s as (select tile, t, k, count(*) filter (score > k * 0.0025) as above from p, (select unnest(range(600)) as k) group by 1, 2, 3), l as (select tile, t, min(k) as k from s join i using (tile, t) where above / n - far <= 0.075 group by 1, 2)
  select tile, t, r, c, score > k * 0.0025 as near from p join l using (tile, t)""")
def cloud_levels(spark, d):
    """Pixels above the level at which the share of near clouds comes down to that of far ones."""
    scored = scene(spark, d).select("tile", "t", "r", "c", (F.col("b0") > 0.35).alias("far"), (F.col("b1") - 0.04).alias("score"))
    return detection.levelled(scored).select("tile", "t", "r", "c", "near")


FLAGGED = f"(select *, b0 > 0.25 as cloud, b1 < 0.01 as shadow, median((b1 - b3) / nullif(b1 + b3, 0)) over (partition by tile, r, c) as water, b0 + b1 + b2 as vis from {SCENE})"


def flagged_scene(spark, d):
    water = F.median(F.try_divide(F.col("b1") - F.col("b3"), F.col("b1") + F.col("b3"))).over(W.partitionBy("tile", "r", "c"))
    return scene(spark, d).withColumns({"cloud": F.col("b0") > 0.25, "shadow": F.col("b1") < 0.01, "water": water})


@query("cloud_outliers", f"""with p as {FLAGGED}, m as (select tile, t, median(vis) filter (not cloud and not shadow) as m from p group by 1, 2), q as (select p.*, case when water > 0 then 1 else vis / nullif(m, 0) end as ratio from p join m using (tile, t)),
  s as (select tile, t, case when bool_and(cloud) then avg(ratio) else avg(ratio) filter (not cloud) end as mean, case when bool_and(cloud) then stddev_pop(ratio) else stddev_pop(ratio) filter (not cloud) end as sd from q group by 1, 2),
  z as (select q.*, coalesce((ratio - mean) / nullif(sd, 0) > 3.5 and water < 0 and not cloud, false) as new from q join s using (tile, t))
  select tile, t, r, c, cloud or (new and count(*) filter (new) over (partition by tile, r, c) = 1) as cloud from z""")
def cloud_outliers(spark, d):
    return detection.outliers(flagged_scene(spark, d)).select("tile", "t", "r", "c", "cloud")


VEILED = "case when t % 9 = 0 then {0} * 0.4 + 0.3 else {0} end as {0}"


@query("hazy_images", f"""with p as (select tile, t, cloud, {', '.join(VEILED.format(f'b{i}') for i in range(3))} from {FLAGGED}),
  i as (select tile, t, avg((b0 + b1 + b2) / 3) as mean, stddev_pop((b0 + b1 + b2) / 3) as spread, stddev_pop(greatest(b0, b1, b2) - least(b0, b1, b2)) as colour from p where not cloud group by 1, 2),
  o as (select tile, t, mean / nullif(median(mean) over x, 0) as m, spread / nullif(median(spread) over x, 0) as s, colour / nullif(median(colour) over x, 0) as c from i window x as (partition by tile))
  select tile, t from o where (m >= 1.5 and s <= 0.67 and c < 1) or (m >= 1.3 and s <= 0.5)""")
def hazy_images(spark, d):
    """Every ninth image under a veil: brighter, with less contrast."""
    veiled = flagged_scene(spark, d).withColumns({f"b{i}": F.when(F.col("t") % 9 == 0, F.col(f"b{i}") * 0.4 + 0.3).otherwise(F.col(f"b{i}")) for i in range(3)})
    return detection.hazy(veiled)


#: Features of a band in SQL: the mosaic's, those of lower bands clipped, and snow.
FEATURES_SQL = ", ".join(f"case when band > {j} then least(greatest(m{j}, 0.005), 1.0) else m{j} end" for j in range(10))


@query("regression_sums", f"""with p as (select *, case when b0 > 0.3 then 0.5 else 0 end as interp, (r * 31 + c * 17 + t * 13) % 101 as o from {SCENE}),
  g as (select tile, r, c, coalesce((median(b1) - median(b3)) / nullif(median(b1) + median(b3), 0) > 0, false) as water,
    avg(case when coalesce((b1 - b8) / nullif(b1 + b8, 0) > 0.1 and b3 >= 0.1 and b0 >= 0.1 and coalesce(b0 / nullif(b2, 0) >= 0.75, true), false) then 1.0 else 0.0 end) as snow,
    {', '.join(f'(min(b{i}) + max(b{i})) / 2 as m{i}' for i in range(10))} from p group by 1, 2, 3),
  i as (select *, row_number() over (partition by tile order by t) as k, count(*) over (partition by tile) as n from (select tile, t, count(*) filter (interp = 0) as clear, count(*) filter (interp > 0) as gap from p group by 1, 2)),
  d as (select a.tile, a.t as date, b.t from i a join i b on a.tile = b.tile and b.k between a.k - case when a.k = a.n then 2 else 1 end and a.k + 1 where a.clear > 0 and a.gap > 0),
  e as (select date, p.*, g.* exclude (tile, r, c), least(greatest(2.5 * (nir - red) / nullif(nir + 6 * red - 7.5 * blue + 1, 0), -1.5), 1.5) as evi from (select *, {CL('b0')} as blue, {CL('b2')} as red, {CL('b3')} as nir from p) p join d using (tile, t) join g using (tile, r, c) where interp = 0 and not water),
  q as (select tile, date, count(*) as n, {', '.join(f'quantile_cont(evi, {x}) as q{int(100 * x)}' for x in (0.02, 0.2, 0.4, 0.6, 0.8, 0.98))} from e group by 1, 2),
  f as (select e.*, q.* exclude (tile, date), case when evi >= q80 then 4 when evi >= q60 then 3 when evi >= q40 then 2 when evi >= q20 then 1 else 0 end as fifth from e join q using (tile, date) where evi is not null),
  s as (select *, case when row_number() over (partition by tile, date, fifth order by o, t, r, c) <= floor(n / 5) then 1 else 0 end + 10 * (evi < q2)::int + 10 * (evi >= q98)::int as w from f),
  x as (select tile, date, band, w, [{FEATURES_SQL}, snow] as xs, [{', '.join(f'b{i}' for i in range(10))}][band + 1] as y from s, (select unnest(range(10)) as band) where w > 0)
  select tile, date, cast(band as int) as band, cast(i as int) as i, {', '.join(f'round(sum(w * xs[i + 1] * xs[{j + 1}]), 9) as s{j}' for j in range(11))}, round(sum(w * xs[i + 1] * y), 9) as y from x, (select unnest(range(11)) as i) group by 1, 2, 3, 4""")
def regression_sums(spark, d):
    """The normal equations by which each cloudy image's gaps are fitted to a mosaic, for all bands."""
    p = scene(spark, d).withColumn("interp", F.when(F.col("b0") > 0.3, 0.5).otherwise(0.0))
    mosaic = p.groupBy("tile", "r", "c").agg(*[((F.min(f"b{i}") + F.max(f"b{i}")) / 2).alias(f"m{i}") for i in range(10)])
    ground = mosaic.join(regression.places(p), ["tile", "r", "c"])
    order = (F.col("r") * 31 + F.col("c") * 17 + F.col("t") * 13) % 101
    sums = regression.band_sums(regression.product_sums(regression.samples(p, ground, order)))
    return sums.select("tile", "date", "band", "i", *[F.round(c, 9).alias(c) for c in (*[f"s{j}" for j in range(11)], "y")])


@query("noise_clouds", f"""with p as (select tile, t, r, c, (b0 > 0.01) and ((r + c) % 2 = 0 or b1 > 0.3) as f from {SCENE}),
  n as (select a.tile, a.t, a.r, a.c, a.f, a.f and count(*) = 9 and count(*) filter (b.f) <= 1 as alone from p a join p b on a.tile = b.tile and a.t = b.t and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 group by 1, 2, 3, 4, 5),
  m as (select *, bool_and(f) over (partition by tile, r, c) as always from n), o as (select *, min(t) filter (alone and always) over (partition by tile, r, c) as first from m)
  select tile, t, r, c, f and not coalesce(alone and always and t = first, false) as cloud from o""")
def noise_clouds(spark, d):
    flagged = scene(spark, d).select("tile", "t", "r", "c", ((F.col("b0") > 0.01) & (((F.col("r") + F.col("c")) % 2 == 0) | (F.col("b1") > 0.3))).alias("cloud"))
    return clouds.without_noise(flagged).select("tile", "t", "r", "c", "cloud")


@query("no_data_pixels", f"""with p as (select tile, t, r, c, case when b0 < 0.2 then 0 else b0 end as b0, case when b1 < 0.2 then 0 else b1 end as b1, case when b2 < 0.2 then 0 else b2 end as b2, case when b3 > 0.4 then null when b3 < 0.2 then 0 else b3 end as b3 from {SCENE}),
  q as (select tile, 0 as t, r, c, bool_and(coalesce(b0 + b1 + b2 + b3 = 0, false)) or bool_or(b0 is null or b1 is null or b2 is null or b3 is null) as f from p group by 1, 3, 4) select tile, r, c, nodata from {crossed('q', 'f', 1, 'nodata')}""")
def no_data_pixels(spark, d):
    cut = lambda i: F.when(F.col(f"b{i}") < 0.2, 0.0).otherwise(F.col(f"b{i}"))
    p = scene(spark, d).withColumns({**{f"b{i}": cut(i) for i in range(3)}, "b3": F.when(F.col("b3") > 0.4, None).otherwise(cut(3))})
    return clouds.no_data(p, 1)


#: Sites as right triangles over the raster of all tiles, and as the rectangles that hold them.
CORNERS = f"""(select k, px as x0, py as y0, px + (x1 - x0) / 170.0 as x1, py + (y1 - y0) / 170.0 as y1 from (select *, x0 * side / 1360.0 as px, y0 * side / 1360.0 as py from v_polys, {SIDE}))"""


def triangle_wkb(x0, y0, x1, y1):
    return geometry.wkb(F.array(F.array(F.array(*[F.array(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y0))]))))


def triangles(spark, d):
    p = view(spark, d, "v_polys").select("k", "x0", "y0", "x1", "y1").repartition(spark.sparkContext.defaultParallelism, "k").crossJoin(tile_side(spark, d))
    low = lambda c: F.col(c) * F.col("side") / 1360.0
    high = lambda c: low(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) / 170.0
    return p.select("k", triangle_wkb(low("x0"), low("y0"), high("x"), high("y")).alias("geom"))


UNDER = lambda x, level: f"pow(greatest(y0 + (({x}) - x0) * m - ({level}), 0), 2)"
TRIANGLE_PART = f"""({UNDER('b', 'greatest(r, y0)')} - {UNDER('a', 'greatest(r, y0)')} - {UNDER('b', 'r + 1')} + {UNDER('a', 'r + 1')}) / (2 * m)"""


@query("polygon_mean", f"""with t as (select *, (y1 - y0) / (x1 - x0) as m from {CORNERS}), c as (select *, unnest(range(cast(floor(x0) as bigint), cast(ceil(x1) as bigint))) as c from t), g as (select *, unnest(range(cast(floor(y0) as bigint), cast(ceil(y1) as bigint))) as r from c),
  p as (select k, r, c, {TRIANGLE_PART} as part from (select *, greatest(x0, c) as a, least(x1, c + 1) as b from g)) select k, round(sum(u8 * part) / sum(part), 3) as ttc from p join {RASTER} s using (r, c) where u8 <> 255 and part >= 0.05 group by 1""")
def polygon_mean(spark, d):
    """Means of triangles by the exact part of each pixel; SQL has that part in closed form, a difference of squares that
    leaves about nine digits, hence three decimals."""
    parts = zonal.polygon_parts(triangles(spark, d), "k", [(0.0, 0.0)])
    means = zonal.means_of_parts(parts, site_raster(spark, d), "k", 1)
    return means.select("k", F.round(F.get("means", F.lit(0)), 3).alias("ttc")).where("ttc is not null")


PLAN = "(values (0, 0.0, 0.0), (1, 0.5, 0.0), (2, -0.5, 0.0), (3, 0.0, 0.5), (4, 0.0, -0.5), (5, 0.5, 0.5), (6, 0.5, -0.5), (7, -0.5, 0.5), (8, -0.5, -0.5)) s(i, dx, dy)"


@query("polygon_statistics", f"""with t as (select k, i, x0 + dx as x0, y0 + dy as y0, x1 + dx as x1, y1 + dy as y1, (y1 - y0) / (x1 - x0) as m from {CORNERS}, {PLAN}), c as (select *, unnest(range(cast(floor(x0) as bigint), cast(ceil(x1) as bigint))) as c from t),
  g as (select *, unnest(range(cast(floor(y0) as bigint), cast(ceil(y1) as bigint))) as r from c), p as (select k, i, r, c, {TRIANGLE_PART} as part from (select *, greatest(x0, c) as a, least(x1, c + 1) as b from g)),
  m as (select k, i, sum(v * part) / sum(part) as ttc from (select p.*, (u8 + 40 * (k % 2)) % 101 as v from p join {RASTER} s using (r, c) where u8 <> 255 and part >= 0.05) group by 1, 2),
  b as (select k, ttc from m where i = 0), s as (select b.k, b.ttc, case when b.ttc = 0 then 0 else sqrt(coalesce(sum(pow((m.ttc - b.ttc) / nullif(b.ttc, 0), 2)), 0) / 8) end as shift_error from b left join m on m.k = b.k and m.i > 0 group by 1, 2),
  d as (select k - k % 3 as uuid, arg_min(calc_area, k) as area, arg_min({CATEGORY}, k) as category from v_polys group by 1),
  j as (select s.*, d.*, (x0 + x1) / 2.0 as x, (y0 + y1) / 2.0 as y from s join v_polys p on p.k = s.k join d on d.uuid = s.k - s.k % 3),
  w(name, pl, pu, rl, ru) as (values ('forest', 0.92, 0.95, 0.9, 0.96), ('urban', 0.7, 0.93, 0.68, 0.94), ('cropland', 0.91, 0.95, 0.9, 0.97)),
  v(place, gpl, gpu, grl, gru) as (values (1, 0.8, 0.97, 0.75, 0.96), (2, 0.74, 0.98, 0.7, 0.95), (3, 0.9, 0.99, 0.88, 0.97)),
  e as (select *, case when ttc = 0 then 0 else (pu - rl) / ttc end as lo, case when ttc = 0 then 0 else (ru - pl) / ttc end as hi, case when ttc = 0 then 0 else coalesce((gpu - grl) / ttc, 0) end as sub_lo, case when ttc = 0 then 0 else coalesce((gru - gpl) / ttc, 0) end as sub_hi,
    case when ttc = 0 or area > 0.5 then 0 else (case when round(ttc, 7) <= 10 then 3.6386 when round(ttc, 7) <= 40 then 16.68 when round(ttc, 7) <= 100 then 23.468 else 0 end) / ttc end as small
    from j join w on w.name = case when lower(category) in (select name from w) then lower(category) else 'forest' end left join v on v.place = {REGION})
  select k, uuid, 1995 + k % 2 as year, round(ttc, 3) as ttc, round(ttc * sqrt(hi * hi + sub_hi * sub_hi + shift_error * shift_error / 4 + small * small / 4), 3) as error_plus, round(ttc * sqrt(lo * lo + sub_lo * sub_lo + shift_error * shift_error / 4 + small * small / 4), 3) as error_minus from e""")
def polygon_statistics(spark, d):
    """Means and errors of triangles by year, three of them under one key."""
    polygons = triangles(spark, d).join(view(spark, d, "v_polys").select("k", "calc_area"), "k").join(centres(spark, d), "k")
    polygons = polygons.select((F.col("k") - F.col("k") % 3).alias("uuid"), (1995 + F.col("k") % 2).alias("year"), F.col("k").alias("place"), "geom", F.col("calc_area").alias("area"), F.expr(CATEGORY).alias("category"), "x", "y")
    years = site_raster(spark, d).select("r", "c", "u8", F.explode(F.array(F.lit(1995).cast("long"), F.lit(1996).cast("long"))).alias("year"))
    pixels = years.withColumn("u8", F.when(F.col("u8") != 255, (F.col("u8") + 40 * (F.col("year") - 1995)) % 101).otherwise(255))
    out = report.polygon_statistics(polygons, pixels, spark.createDataFrame(INTERVALS, f"category string, {INTERVAL}"), region_table(spark), 0.5, "uuid").where("ttc is not null")
    return out.select(F.col("place").alias("k"), "uuid", "year", *[F.round(c, 3).alias(c) for c in ("ttc", "error_plus", "error_minus")])


#: The polygons' boxes as triangles in units of 1/3600 degree; a tile meets the triangle where its upper right corner does.
@query("polygon_tiles", """select k, x_tile, y_tile from v_polys, v_grid where x0 <= x_tile * 200 + 200 and x1 >= x_tile * 200 and y0 <= y_tile * 200 + 200 and y1 >= y_tile * 200
  and (greatest(y_tile * 200, y0) - y0) * (x1 - x0) <= (least(x_tile * 200 + 200, x1) - x0) * (y1 - y0)""")
def polygon_tiles(spark, d):
    corners = [F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")]
    p = view(spark, d, "v_polys").select("k", "x0", "y0", "x1", "y1").repartition(spark.sparkContext.defaultParallelism, "k")  # the table is one file
    p = p.select("*", triangle_wkb(*corners).alias("geom"))
    return tiles.polygons_on_grid(p, view(spark, d, "v_grid")).select("k", "x_tile", "y_tile")


#: Polygons as triangles with a long side along a diagonal, on one side of it or the other, and the half squares that they hold.
HALVES = """(select framework_key, plantstart, x + i as i, y + j as j, h from (select framework_key, plantstart, k % 2 as up, 1 + k % 30 as n, cast(floor(x0 / 10) as int) as x, cast(floor(y0 / 10) as int) as y from v_polys),
  lateral (select unnest(range(n)) as i), lateral (select unnest(range(n)) as j), (select unnest([0, 1]) as h) where case when up = 1 then j > i or (i = j and h = 1) else j < i or (i = j and h = 0) end)"""


def diagonal_triangles(spark, d):
    x, y, n = F.floor(F.col("x0") / 10).cast("double"), F.floor(F.col("y0") / 10).cast("double"), (1 + F.col("k") % 30).cast("double")
    ring = lambda *points: F.array(F.array(F.array(*[F.array(*p) for p in (*points, points[0])])))
    up, low = ring((x, y), (x + n, y + n), (x, y + n)), ring((x, y), (x + n, y), (x + n, y + n))
    p = view(spark, d, "v_polys").select("k", "framework_key", "plantstart", "x0", "y0").repartition(spark.sparkContext.defaultParallelism, "k")  # the table is one file
    return p.select("k", "framework_key", F.year("plantstart").alias("year"), geometry.wkb(F.when(F.col("k") % 2 == 1, up).otherwise(low)).alias("geom"))


@query("union_areas", f"select framework_key, round(count(*) / 2, 6) as area from (select distinct framework_key, i, j, h from {HALVES}) group by 1")
def union_areas(spark, d):
    """The area that each framework's polygons cover together, overlaps once."""
    return overlay.union_areas(diagonal_triangles(spark, d), "framework_key", 64.0).withColumn("area", F.round("area", 6))


@query("footprint_coverage", f"select year, cast(floor(i / 40) as bigint) as x_tile, cast(floor(j / 40) as bigint) as y_tile, round(count(*) / 3200, 8) as share from (select distinct cast(year(plantstart) as int) as year, i, j, h from {HALVES}) group by 1, 2, 3")
def footprint_coverage(spark, d):
    return radar.footprint_coverage(diagonal_triangles(spark, d), "year", 40.0).withColumn("share", F.round("share", 8))


@query("largest_clusters", """with recursive m as (select k, project_id, x_tile, y_tile from v_polys, v_grid where x0 <= x_tile * 200 + 200 and x1 >= x_tile * 200 and y0 <= y_tile * 200 + 200 and y1 >= y_tile * 200),
  e as (select distinct a.k as a, b.k as b from m a join m b using (project_id, x_tile, y_tile)), c(k, other) as (select distinct k, k from m union select c.k, e.b from c join e on c.other = e.a),
  l as (select k, min(other) as cluster from c group by k) select cluster, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, count(*) as n from l join v_polys using (k) group by 1""")
def largest_clusters(spark, d):
    p, g = view(spark, d, "v_polys").select("k", "project_id", "x0", "y0", "x1", "y1"), view(spark, d, "v_grid")
    found = components.clusters(tiles.boxes_on_grid(p, g), "k", "project_id", "x_tile", "y_tile")
    return components.cluster_bounds(found.join(p, "k"))


CALLS = "(select seq, status in ('success', 'partial') as ok, coalesce(duration_sec, 0) as seconds, seq + coalesce(duration_sec, 0) as done_at from v_jobs)"


@query("benchmark_summary", f"""with o as (select list(seconds order by seconds) as s, count(*) as n, avg(seconds) as mean, stddev_samp(seconds) as deviation, max(done_at) as elapsed from {CALLS} where ok)
  select n as good, (select count(*) from v_jobs) as calls, round(mean, 6) as mean, round(deviation, 6) as deviation, round(elapsed, 6) as elapsed, s[round_even(0.5 * (n - 1), 0)::bigint + 1] as p50, s[round_even(0.95 * (n - 1), 0)::bigint + 1] as p95,
    s[round_even(0.99 * (n - 1), 0)::bigint + 1] as p99, round(list_median(s[1:30]), 6) as quick_median, round(list_median(s[31:]), 6) as slow_median, round(n / (elapsed / 60), 6) as per_minute from o""")
def benchmark_summary(spark, d):
    calls = view(spark, d, "v_jobs").select("seq", F.col("status").isin("success", "partial").alias("ok"), F.coalesce("duration_sec", F.lit(0.0)).alias("seconds"), (F.col("seq") + F.coalesce("duration_sec", F.lit(0.0))).alias("done_at"))
    out = tracking.benchmark_summary(calls, 30)
    return out.select(*[F.round(c, 6).alias(c) if c in ("mean", "deviation", "elapsed", "quick_median", "slow_median", "per_minute") else c for c in out.columns])


@query("failed_tiles", "select distinct year, x_tile, y_tile from v_jobs where status not in ('success', 'partial')")
def failed_tiles(spark, d):
    return tracking.failed_tiles(view(spark, d, "v_jobs"))


@query("first_failures", "select seq, job_id, task_type, region, status, year, x_tile, y_tile, substr(coalesce(error, 'Unknown'), 1, 200) as error from v_jobs where status not in ('success', 'partial') order by seq limit 20")
def first_failures(spark, d):
    return tracking.first_failures(view(spark, d, "v_jobs"))


@query("billed_cost", "select seq, 3072 / 1024.0 * duration_sec as gb_sec, round(3072 / 1024.0 * duration_sec * 0.0000166667, 12) as compute_usd, round(3072 / 1024.0 * duration_sec * 0.0000166667 + 0.0000002, 12) as total_usd from v_jobs")
def billed_cost(spark, d):
    cost = tracking.billed_cost(F.lit(3072), F.col("duration_sec"))
    return view(spark, d, "v_jobs").select("seq", cost.alias("x")).select("seq", "x.gb_sec", F.round("x.compute_usd", 12).alias("compute_usd"), F.round("x.total_usd", 12).alias("total_usd"))


@query("finite_range", "select label, coalesce(min(v), 0) as low, case when min(v) = max(v) then max(v) + 1e-9 else coalesce(max(v), 1) end as high from v_pixels where not isnan(v) and not isinf(v) group by 1")
def finite_range(spark, d):
    return raster.finite_range(view(spark, d, "v_pixels"), "v", ["label"])


@query("flattened_array", "select r, c, round(avg(u8), 9) as u8 from v_patch group by 1, 2")
def flattened_array(spark, d):
    """Images of 8 x 8 pixels by label: the label's axis is a long one only with more than 8 of them, so it is cut to two."""
    cells = view(spark, d, "v_patch").withColumn("k", F.col("label") % 2)
    return raster.flattened(cells, ["k", "r", "c"], "u8").withColumn("u8", F.round("u8", 9))
