"""Queries over scenes, series, rasters and polygons' statistics, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixtures import view, with_views
from tessera.functions import scalars as S
from tessera.functions import spectral as P
from tessera.operators import geometry, raster, scenes, temporal, zonal
from tessera.plans import report

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return add


SCORE = "case when cloud > 0.3 then 0.25 * cloud + 0.75 * local_cloud else cloud end"
CLEAR = f"""c as (select *, {SCORE} as score from (select *, min(local_cloud) over (partition by tile, year(acquired), month(acquired)) as least from v_scenes)
  where cloud <= 0.5 and {SCORE} <= 0.4 and not least < local_cloud - 0.2)"""


@query("scene_filter", f"with {CLEAR} select scene_id, round(score, 9) as score from c")
def scene_filter(spark, d):
    return scenes.clear(view(spark, d, "v_scenes")).select("scene_id", F.round("score", 9).alias("score"))


@query("scene_selection", f"""with {CLEAR}, m as (select *, case when row_number() over (partition by tile, year(acquired), month(acquired) order by score, scene_id) > 2 then 1 else 0 end as later from c),
  p as (select *, row_number() over (partition by tile, year(acquired) order by later, score, scene_id) as place from m) select scene_id, cast(place as int) as place from p where place <= 24""")
def scene_selection(spark, d):
    return scenes.chosen(scenes.clear(view(spark, d, "v_scenes"))).select("scene_id", "place")


STEPS = "(select distinct tile, acquired + cast(scene_id % 5 as int) as step from v_scenes)"


@query("nearest_scene", f"""with n as (select s.tile, s.step, v.scene_id, v.coverage, cast(abs(date_diff('day', v.acquired, cast(s.step as date))) as int) as days from {STEPS} s join v_scenes v
    on v.tile = s.tile and v.acquired between s.step - interval 2 day and s.step + interval 2 day),
  f as (select *, row_number() over (partition by tile, step order by days, coverage desc, scene_id) as rank from n),
  g as (select *, max(case when rank = 1 then coverage end) over (partition by tile, step) as first_cov from f),
  h as (select *, first_cov < 0.95 and days <= 1 and coverage >= 0.95 as swap from g),
  o as (select *, row_number() over (partition by tile, step order by swap desc, case when swap then -coverage end, rank) as place from h)
  select tile, cast(cast(step as date) as varchar) as step, scene_id, days, coverage from o where place = 1""")
def nearest_scene(spark, d):
    s = view(spark, d, "v_scenes")
    steps = s.select("tile", F.date_add("acquired", (F.col("scene_id") % 5).cast("int")).alias("step")).distinct()
    return scenes.nearest(steps, s).withColumn("step", F.col("step").cast("string"))


@query("alternative_scene", """select scene_id, min(cloud) over (partition by tile order by acquired range between interval 30 day preceding and interval 30 day following) < cloud - 0.2 as alternative from v_scenes""")
def alternative_scene(spark, d):
    return scenes.better_within(view(spark, d, "v_scenes")).select("scene_id", "alternative")


@query("quarter_days", """with d as (select tile, cast(year(acquired) as int) as year, cast(quarter(acquired) as int) as quarter, acquired, max(coverage) as coverage from v_scenes group by all),
  r as (select *, cast(row_number() over (partition by tile, year, quarter order by coverage desc, acquired) as int) as rank from d) select * replace (cast(acquired as varchar) as acquired) from r where rank <= 2 and (coverage >= 0.95 or rank = 1)""")
def quarter_days(spark, d):
    return scenes.quarter_days(view(spark, d, "v_scenes")).withColumn("acquired", F.col("acquired").cast("string"))


@query("orbit_selection", """with q as (select tile, cast(year(acquired) as int) as year, orbit, quarter(acquired) as q, count(distinct case when coverage >= 0.95 then acquired end) as days, count(*) as n from v_scenes group by all),
  w as (select tile, year, orbit, cast(sum(least(days, 2)) as bigint) as qualifying, cast(sum(n) as bigint) as raw from q group by all)
  select * exclude rank from (select *, row_number() over (partition by tile, year order by qualifying desc, raw desc, orbit) as rank from w) where rank = 1""")
def orbit_selection(spark, d):
    return scenes.orbit_of(view(spark, d, "v_scenes"))


@query("class_shares", """with n as (select tile, cast(u8 % 12 as int) as scl, count(*) as n from v_patch group by all),
  s as (select *, round(n / sum(n) over (partition by tile), 6) as share, cast(row_number() over (partition by tile order by n desc, scl) as int) as rank from n) select * from s where rank <= 4""")
def class_shares(spark, d):
    return scenes.class_shares(view(spark, d, "v_patch").withColumn("scl", F.col("u8") % 12), "tile", "scl")


@query("cloud_fractions", """select tile, round(avg(case when u8 % 12 in (0, 1, 2, 3, 7, 8, 9, 10, 11) then 1.0 else 0 end), 6) as whole,
  round(avg(case when u8 % 12 in (0, 1, 2, 3, 7, 8, 9, 10, 11) then 1.0 else 0 end) filter (r between 2 and 5 and c between 2 and 5), 6) as centre from v_patch group by 1""")
def cloud_fractions(spark, d):
    cloudy = (F.col("u8") % 12).isin(*P.CLOUDY).cast("double")
    centre = F.col("r").between(2, 5) & F.col("c").between(2, 5)
    return view(spark, d, "v_patch").groupBy("tile").agg(F.round(F.avg(cloudy), 6).alias("whole"), F.round(F.avg(F.when(centre, cloudy)), 6).alias("centre"))


WIDE = "w as (select pixel, t, " + ", ".join(f"max(v) filter (band = {b}) as b{b}" for b in range(10)) + " from v_bands group by 1, 2)"
CL = lambda x: f"least(greatest({x}, 0), 1)"


def wide(spark, d):
    return view(spark, d, "v_bands").groupBy("pixel", "t").pivot("band", list(range(10))).agg(F.max("v")).withColumnsRenamed({str(b): f"b{b}" for b in range(10)})


@query("spectral_indices", f"""with {WIDE}, u as (select pixel, t, {CL('b0')} as b, {CL('b1')} as g, {CL('b2')} as r, {CL('b3')} as n, {CL('b8')} as s from w)
  select pixel, t, round(least(greatest(2.5 * (n - r) / nullif(n + 6 * r - 7.5 * b + 1, 0), -1.5), 1.5), 6) as evi, round(least(greatest(((s + r) - (n + b)) / ((s + r) + (n + b) + 1e-5), -1), 1), 6) as bi,
  round(least(greatest((2 * n + 1 - sqrt(greatest((2 * n + 1) * (2 * n + 1) - 8 * (n - r), 0))) / 2, -1), 1), 6) as msavi2, round((n - (g + r)) / (n + g + r + 1e-5), 6) as grndvi from u""")
def spectral_indices(spark, d):
    b, g, r, n, s = (F.col(f"b{i}") for i in (0, 1, 2, 3, 8))
    x = lambda c, name: F.round(c, 6).alias(name)
    return wide(spark, d).select("pixel", "t", x(P.evi(b, r, n), "evi"), x(P.brightness(b, r, n, s), "bi"), x(P.msavi2(r, n), "msavi2"), x(P.grndvi(g, r, n), "grndvi"))


@query("normalised_differences", f"""with {WIDE} select pixel, t, round((b1 - b3) / nullif(b1 + b3, 0), 6) as ndwi, round((b8 - b3) / nullif(b8 + b3, 0), 6) as ndbi, round((b3 - b2) / nullif(b3 + b2, 0), 6) as ndvi from w""")
def normalised_differences(spark, d):
    c = lambda i, j, name: F.round(P.normalised_difference(F.col(f"b{i}"), F.col(f"b{j}")), 6).alias(name)
    return wide(spark, d).select("pixel", "t", c(1, 3, "ndwi"), c(8, 3, "ndbi"), c(3, 2, "ndvi"))


@query("snow_mask", f"""with {WIDE}, a as (select *, (b1 - b8) / nullif(b1 + b8, 0) as d, b0 / nullif(b2, 0) as q from w)
  select pixel, t, coalesce(d > 0.1 and b3 >= 0.1 and b0 >= 0.1 and coalesce(q >= 0.75, true), false) as snow from a""")
def snow_mask(spark, d):
    return wide(spark, d).select("pixel", "t", P.snow(*[F.col(f"b{i}") for i in (0, 1, 2, 3, 8)]).alias("snow"))


@query("normalise", "select pixel, t, band, round((least(greatest(v, lo[band + 1]), hi[band + 1]) - (hi[band + 1] + lo[band + 1]) / 2) / ((hi[band + 1] - lo[band + 1]) / 2), 8) as v "
       f"from v_bands, (select {P.MIN_ALL} as lo, {P.MAX_ALL} as hi)")
def normalise(spark, d):
    return view(spark, d, "v_bands").select("pixel", "t", "band", F.round(P.normalised(F.col("v"), F.col("band")), 8).alias("v"))


@query("radar_db", """select pixel, t, band, round(least(greatest((greatest(10 * log10(v + 1 / 65535.0), -22) + 22) / 22, 0), 1), 6) as db, cast(round_even(least(greatest(v * 65535, 0), 65535), 0) as int) as u16,
  least(greatest(cast(floor(v * 20000) as int) / 10000.0, 0), 1) as reflectance from v_bands""")
def radar_db(spark, d):
    v = F.col("v")
    return view(spark, d, "v_bands").select("pixel", "t", "band", F.round(S.radar_db(v), 6).alias("db"), S.quantise(v).alias("u16"), S.clip(F.floor(v * 20000) / 10000.0, 0, 1).alias("reflectance"))


@query("radar_calibration", """select pixel, t, band, round(greatest(dn * dn - 900, 0) / nullif(lut * lut, 0), 9) as gamma, round(case when cosl >= 0.2 then dn * 0.8 / greatest(cosl, 0.1) end, 6) as flat
  from (select *, floor(v * 1000) as dn, 300 + band as lut, v as cosl from v_bands)""")
def radar_calibration(spark, d):
    dn = F.floor(F.col("v") * 1000).cast("double")
    return view(spark, d, "v_bands").select(
        "pixel", "t", "band", F.round(P.calibrated(dn, F.lit(900.0), F.col("band") + 300.0), 9).alias("gamma"), F.round(P.flattened(dn, F.lit(0.8), F.col("v")), 6).alias("flat")
    )


W_ROWS = ", ".join(f"({i}, {j}, {x!r})" for (i, j), x in __import__("numpy").ndenumerate(temporal.whittaker_matrix()) for x in [float(x)])


@query("whittaker", f"""with s as (select pixel, t, avg(v) as v from v_series group by 1, 2), g as (select p.pixel, t.t, coalesce(s.v, 0) as v from (select distinct pixel from v_series) p, (select unnest(range(24)) as t) t left join s on s.pixel = p.pixel and s.t = t.t)
  select pixel, cast(month as int) as month, round(sum(w * v), 6) as v from g join (values {W_ROWS}) m(month, t, w) using (t) group by 1, 2""")
def whittaker(spark, d):
    return temporal.smoothed(spark, dense(spark, d), ["pixel"]).withColumn("v", F.round("v", 6))


def dense(spark, d):
    s = view(spark, d, "v_series")
    grid = s.select("pixel").distinct().withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return grid.join(s.groupBy("pixel", "t").agg(F.avg("v").alias("v")), ["pixel", "t"], "left").withColumn("v", F.coalesce("v", F.lit(0.0)))


@query("resample_weights_sum", """with s as (select pixel, doy, avg(v) as v from v_series group by 1, 2), g as (select pixel, list(doy order by doy) as days from s group by 1),
  t as (select pixel, days, k, 15 * k as t, list_reverse(list_filter(days, lambda x: x < 15 * k + 5))[1:2] as b, list_filter(days, lambda x: x >= 15 * k - 5)[1:2] as a from g, (select unnest(range(24)) as k)),
  r as (select pixel, days, k, t, list_filter(b, lambda x: x > b[1] - 100) as b, list_filter(a, lambda x: x < a[1] + 100) as a from t),
  n as (select *, len(b) = 0 and days[1] >= 90 as tb, len(a) = 0 and days[-1] <= 270 as ta from r),
  w as (select pixel, k, t, case when tb then -365 else 0 end as sb, case when ta then 365 else 0 end as sa, case when len(b) > 0 then b when tb then [days[-1]] else list_reverse(a) end as b, case when len(a) > 0 then a when ta then [days[1]] else list_reverse(b) end as a from n),
  d as (select pixel, k, b, a, list_transform(b, lambda x: greatest(abs(x - t + sb), 1)) as db, list_transform(a, lambda x: greatest(abs(x - t + sa), 1)) as da from w),
  m as (select pixel, k, unnest(list_concat(b, a)) as doy, unnest(list_concat(list_transform(db, lambda x: db[1] / x * abs(1 - db[1] / greatest(db[1] + da[1], 2))), list_transform(da, lambda x: da[1] / x * abs(1 - da[1] / greatest(db[1] + da[1], 2))))) as m from d),
  p as (select *, sum(m) over (partition by pixel, k) as whole, count(*) over (partition by pixel, k) as n from m)
  select p.pixel, cast(k as int) as target, round(sum(case when whole > 0 then m / whole else 1.0 / n end * v) + 1e-9, 6) as v from p join s on s.pixel = p.pixel and s.doy = p.doy group by 1, 2""")
def resample_weights_sum(spark, d):
    s = view(spark, d, "v_series").groupBy("pixel", "doy").agg(F.avg("v").alias("v"))
    return temporal.resampled(s, "pixel", "doy", ["pixel"]).withColumn("v", F.round(F.col("v") + 1e-9, 6))


@query("quarter_medians", "select pixel, cast(floor(t / 6) as int) as quarter, round(median(v), 8) as v from v_series group by 1, 2")
def quarter_medians(spark, d):
    s = view(spark, d, "v_series").withColumn("month", F.floor(F.col("t") / 2))
    return temporal.quarter_medians(s, ["pixel"]).withColumn("v", F.round("v", 8))


@query("quarter_composite", "select label, r, c, cast(coalesce(floor(median(nullif(u8, 0))), 0) as int) as dn from v_patch group by 1, 2, 3")
def quarter_composite(spark, d):
    return temporal.composites(view(spark, d, "v_patch").withColumnRenamed("u8", "dn"), ["label", "r", "c"])


@query("temporal_median", "select pixel, band, round(median(v), 8) as v from v_bands group by 1, 2")
def temporal_median(spark, d):
    return view(spark, d, "v_bands").groupBy("pixel", "band").agg(F.round(F.median("v"), 8).alias("v"))


@query("gaps_filled", """with m as (select pixel, median(v) filter (v > 0.02 and v < 0.3) as m from v_series group by 1)
  select seq, round(case when v > 0.02 and v < 0.3 then v else coalesce(m, 0) end, 8) as v from v_series join m using (pixel)""")
def gaps_filled(spark, d):
    s = view(spark, d, "v_series").withColumn("v", F.when((F.col("v") > 0.02) & (F.col("v") < 0.3), F.col("v")))
    return temporal.gaps_filled(s, ["pixel"]).select("seq", F.round("v", 8).alias("v"))


@query("gaps_cascaded", """with recursive s as (select pixel, band, list(case when v < 0.05 then 0 when v > 0.28 then 1 else v end order by t) as vs, list(t order by t) as ts from v_bands group by 1, 2),
  f(pixel, band, bad, k, vs) as (select pixel, band, 0, 0, vs from s
    union all select pixel, band, case when k = len(vs) then 1 else bad end, case when k = len(vs) then 0 else k + 1 end,
      case when k < len(vs) and vs[k + 1] = bad then list_concat(vs[1:k], [list_aggregate(vs, 'median')], vs[k + 2:]) else vs end from f where bad = 0 or k < len(vs))
  select pixel, band, unnest(ts) as t, round(unnest(f.vs), 12) as v from f join s using (pixel, band) where bad = 1 and k = len(f.vs)""")
def gaps_cascaded(spark, d):
    cut = view(spark, d, "v_bands").withColumn("v", F.when(F.col("v") < 0.05, 0.0).when(F.col("v") > 0.28, 1.0).otherwise(F.col("v")))
    return temporal.cascading_filled(cut, ["pixel", "band"]).withColumn("v", F.round("v", 12))


@query("bad_steps", """with p as (select pixel, t, case when count(*) filter (v < 0.02 or v >= 0.25) > 1 then 1 else 0 end as bad from v_bands group by 1, 2)
  select t, cast(sum(bad) as bigint) as bad, count(*) as n from p group by 1 having sum(bad) * 11 >= count(*)""")
def bad_steps(spark, d):
    v = F.when(F.col("v") < 0.02, 0.0).when(F.col("v") >= 0.25, 1.0).otherwise(F.col("v"))
    return temporal.bad_steps(view(spark, d, "v_bands").withColumn("v", v), "t", "pixel")


@query("false_clouds", """with recursive s as (select vec_id, list(case when v > 0 then 1 else 0 end order by i) as f from v_pixels group by 1),
  w(vec_id, f, i, last, kept) as (select vec_id, f, 1, 0, cast([] as int[]) from s
    union all select vec_id, f, i + 1, case when last = 1 and f[i] = 1 then 0 else f[i] end,
      case when last = 1 and f[i] = 1 then list_concat(kept[1:len(kept) - 1], [0, 0]) else list_append(kept, f[i]) end from w where i <= len(f))
  select vec_id, array_to_string(kept, '') as flags from w where i = len(f) + 1""")
def false_clouds(spark, d):
    flags = F.transform(F.array_sort(F.collect_list(F.struct("i", (F.col("v") > 0).cast("int").alias("f")))), lambda x: x["f"])
    return view(spark, d, "v_pixels").groupBy("vec_id").agg(flags.alias("f")).select("vec_id", F.array_join(temporal.without_false_clouds(F.col("f")).cast("array<string>"), "").alias("flags"))


U8 = "(select tile, label, r, c, case when u8 % 17 = 0 then 255 else u8 end as u8 from v_patch)"


def holed(spark, d):
    return view(spark, d, "v_patch").withColumn("u8", F.when(F.col("u8") % 17 == 0, 255).otherwise(F.col("u8")))


@query("mosaic_first_valid", f"select r, c, coalesce(arg_min(u8, tile) filter (u8 <> 255), 255) as u8 from {U8} group by 1, 2")
def mosaic_first_valid(spark, d):
    return raster.mosaic(holed(spark, d), "tile")


@query("mosaic_denoised", f"""select a.tile, a.r, a.c, case when max(b.u8) < 30 or any_value(a.u8) < 20 then 0 else any_value(a.u8) end as u8 from {U8} a join {U8} b
  on a.tile = b.tile and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 group by 1, 2, 3""")
def mosaic_denoised(spark, d):
    return raster.denoised(holed(spark, d)).select("tile", "r", "c", "u8")


@query("window_majority", """with p as (select tile, r, c, case when u8 > 50 then 1 else 0 end as f from v_patch), o as (select unnest([-1, 0, 1]) as o),
  n as (select a.tile, a.r, a.c, x.o as dr, y.o as dc, abs(case when a.r + x.o > 7 then 14 - a.r - x.o else a.r + x.o end) as rr, abs(case when a.c + y.o > 7 then 14 - a.c - y.o else a.c + y.o end) as cc from p a, o x, o y)
  select n.tile, n.r, n.c, cast(sum(p.f) as bigint) as total, sum(p.f) >= 5 as kept from n join p on p.tile = n.tile and p.r = n.rr and p.c = n.cc group by 1, 2, 3""")
def window_majority(spark, d):
    p = view(spark, d, "v_patch").withColumn("f", (F.col("u8") > 50).cast("long"))
    return raster.window_sum(p, "f", "total").select("tile", "r", "c", "total", (F.col("total") >= 5).alias("kept"))


@query("square_dilation", "select a.tile, a.r, a.c, max(b.u8) >= 55 as hit, min(b.u8) as low from v_patch a join v_patch b on a.tile = b.tile and abs(a.r - b.r) <= 2 and abs(a.c - b.c) <= 2 group by 1, 2, 3")
def square_dilation(spark, d):
    p = raster.window_extreme(view(spark, d, "v_patch"), 2, "u8", "top")
    return raster.window_extreme(p, 2, "u8", "low", least=True).select("tile", "r", "c", (F.col("top") >= 55).alias("hit"), "low")


@query("cross_dilation", "select a.tile, a.r, a.c, bool_or(b.u8 >= 57 and abs(a.r - b.r) + abs(a.c - b.c) <= 2) as dilated from v_patch a join v_patch b on a.tile = b.tile group by 1, 2, 3")
def cross_dilation(spark, d):
    return raster.cross_dilated(view(spark, d, "v_patch").withColumn("f", F.col("u8") >= 57), "f", 2).select("tile", "r", "c", "dilated")


@query("grey_closing", """with t as (select a.tile, a.r, a.c, max(b.u8) as m from v_patch a join v_patch b on a.tile = b.tile and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 group by 1, 2, 3)
  select a.tile, a.r, a.c, min(b.m) as closed from t a join t b on a.tile = b.tile and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 group by 1, 2, 3""")
def grey_closing(spark, d):
    return raster.closed(view(spark, d, "v_patch"), 1, "u8", "closed").select("tile", "r", "c", "closed")


@query("block_means", "select tile, cast(floor(r / 2) as int) as br, cast(floor(c / 2) as int) as bc, avg(u8) as mean from v_patch group by 1, 2, 3")
def block_means(spark, d):
    return raster.block_means(view(spark, d, "v_patch"), 2, "u8")


@query("bad_blocks", f"select tile, cast(floor(r / 4) as int) as br, cast(floor(c / 4) as int) as bc, count(*) filter (u8 = 255) > 0.05 * count(*) as bad from {U8} group by 1, 2, 3")
def bad_blocks(spark, d):
    return raster.bad_blocks(holed(spark, d), 4, "u8", share=0.05)


#: Predictions of windows that overlap: each tile of a label is moved by its number.
PRED = "(select label, tile as w, r + tile % 5 as r, c + tile % 3 as c, r as i, c as j, case when u8 % 19 = 0 then 2.55 else u8 / 100.0 end as p from v_patch)"


def predictions(spark, d):
    p = F.when(F.col("u8") % 19 == 0, 2.55).otherwise(F.col("u8") / 100.0)
    return view(spark, d, "v_patch").select("label", F.col("tile").alias("w"), (F.col("r") + F.col("tile") % 5).alias("r"), (F.col("c") + F.col("tile") % 3).alias("c"), F.col("r").alias("i"), F.col("c").alias("j"), p.alias("p"))


@query("gaussian_blend", f"""with p as (select *, case when p <= 1 then exp(-((i - 3.5) * (i - 3.5) + (j - 3.5) * (j - 3.5)) / (2.0 * 9.0)) else 0 end as g from {PRED}),
  m as (select label, r, c, case when sum(g) > 0 then sum(p * 100 * g) / sum(g) end as m from p group by 1, 2, 3)
  select label, r, c, cast(case when m is null or m > 100 then 255 when m <= 15 then 0 else floor(m) end as int) as u8 from m""")
def gaussian_blend(spark, d):
    return raster.blended(predictions(spark, d), raster.gauss(8, 3.0, F.col("i"), F.col("j")), "p", ["label", "r", "c"])


@query("window_agreement", f"""with p as (select label, w, r, c, p from {PRED}), o as (select *, (sum(p) over (partition by label, r, c) - p) / nullif(count(*) over (partition by label, r, c) - 1, 0) as o from p),
  d as (select label, w, avg(abs(o - p)) as ratio from o group by 1, 2), m as (select label, min(ratio) as least, median(ratio) as middle from d group by 1)
  select label, w, round(case when least > 0 and ratio is not null then least(middle / ratio, 1.5) else 1 end, 6) as multiplier from d join m using (label)""")
def window_agreement(spark, d):
    return raster.agreement(predictions(spark, d), "w", "p", ["label"]).withColumn("multiplier", F.round("multiplier", 6))


@query("raster_parity", f"""with a as {U8}, b as (select tile, r, c, least(u8 + tile % 7, 254) as b from v_patch), j as (select label, u8, b, abs(u8 - b) as off from a join b using (tile, r, c) where u8 <> 255)
  select label, round(case when count(*) filter (off <= 30) > 100 then corr(u8, b) filter (off <= 30) end, 6) as corr_close, round(100.0 * count(*) filter (off > 30) / count(*), 6) as far, count(*) as n, round(avg(off), 6) as mae, max(off) as max_off, round(sqrt(avg(off * off)), 6) as rmse, round(100.0 * count(*) filter (off <= 1) / count(*), 6) as within_1, round(100.0 * count(*) filter (off <= 5) / count(*), 6) as within_5,
  round(100.0 * count(*) filter (off <= 10) / count(*), 6) as within_10, round(corr(u8, b), 6) as corr, round(avg(u8), 6) as mean_a, round(avg(b), 6) as mean_b from j group by 1""")
def raster_parity(spark, d):
    b = view(spark, d, "v_patch").select("tile", "r", "c", F.least(F.col("u8") + F.col("tile") % 7, F.lit(254)).alias("u8"))
    return raster.compared(holed(spark, d), b, "u8", ["tile", "r", "c"], ["label"])


@query("band_stats", """select band, min(v) filter (v > 0) as min, max(v) filter (v > 0) as max, round(avg(v) filter (v > 0), 6) as mean, round(stddev_pop(v) filter (v > 0), 6) as std, round(quantile_cont(v, 0.05) filter (v > 0), 6) as p5,
  round(quantile_cont(v, 0.5) filter (v > 0), 6) as p50, round(quantile_cont(v, 0.95) filter (v > 0), 6) as p95, round(count(*) filter (v > 0) / count(*), 6) as valid, round(count(*) filter (isnan(v)) / count(*), 6) as nan from v_bands group by 1""")
def band_stats(spark, d):
    return raster.band_stats(view(spark, d, "v_bands"), "band", "v")


@query("terrain_slope", """with g as (select tile, r, c, (coalesce(lead(u8) over x, u8) - coalesce(lag(u8) over x, u8)) / case when lead(u8) over x is null or lag(u8) over x is null then 10.0 else 20.0 end as dx,
  (coalesce(lead(u8) over y, u8) - coalesce(lag(u8) over y, u8)) / case when lead(u8) over y is null or lag(u8) over y is null then 10.0 else 20.0 end as dy from v_patch
  window x as (partition by tile, r order by c), y as (partition by tile, c order by r)) select tile, r, c, round(degrees(atan(sqrt(dx * dx + dy * dy))), 6) as slope from g""")
def terrain_slope(spark, d):
    return raster.slopes(view(spark, d, "v_patch"), "u8", 10.0).select("tile", "r", "c", F.round("slope", 6).alias("slope"))


#: All tiles of the patches, row by row in a square that holds them; sites of some pixels anywhere on it.
SIDE = "(select cast(ceil(sqrt(max(tile) + 1)) as int) as side from v_patch)"
RASTER = f"(select cast(floor(tile / side) * 8 + r as int) as r, cast(tile % side * 8 + c as int) as c, case when u8 % 17 = 0 then 255 else u8 end as u8 from v_patch, {SIDE})"
BOXES = f"""(select k, calc_area, px as x0, py as y0, px + (x1 - x0) / 170.0 as x1, py + (y1 - y0) / 170.0 as y1
  from (select *, x0 * side / 1360.0 as px, y0 * side / 1360.0 as py from v_polys, {SIDE}))"""


def tile_side(spark, d):
    return F.broadcast(view(spark, d, "v_patch").agg(F.ceil(F.sqrt(F.max("tile") + 1)).cast("int").alias("side")))


def site_raster(spark, d):
    p = holed(spark, d).crossJoin(tile_side(spark, d))
    return p.select((F.floor(F.col("tile") / F.col("side")) * 8 + F.col("r")).cast("int").alias("r"), (F.col("tile") % F.col("side") * 8 + F.col("c")).cast("int").alias("c"), "u8")


def site_boxes(spark, d):
    p = view(spark, d, "v_polys").crossJoin(tile_side(spark, d))
    low = lambda c: F.col(c) * F.col("side") / 1360.0
    high = lambda c: low(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) / 170.0
    return p.select("k", "calc_area", low("x0").alias("x0"), low("y0").alias("y0"), high("x").alias("x1"), high("y").alias("y1"))


def means_sql(boxes: str, keys: str) -> str:
    part = "greatest(least(x1, p.c + 1) - greatest(x0, p.c), 0) * greatest(least(y1, p.r + 1) - greatest(y0, p.r), 0)"
    cells = lambda a, b: f"unnest(range(cast(floor({a}) as bigint), cast(ceil({b}) as bigint)))"
    return f"""select {keys}, sum(u8 * part) / sum(part) as ttc from (select b.*, p.u8, {part} as part from (select *, {cells('y0', 'y1')} as r from (select *, {cells('x0', 'x1')} as c from {boxes})) b
      join (select * from {RASTER} where u8 <> 255) p on p.r = b.r and p.c = b.c) where part >= 0.05 group by {keys}"""


@query("zonal_mean", f"with m as ({means_sql(BOXES, 'k')}) select k, round(ttc, 6) as ttc from m")
def zonal_mean(spark, d):
    return zonal.zonal_means(site_boxes(spark, d), site_raster(spark, d), ["k"]).where("ttc is not null").withColumn("ttc", F.round("ttc", 6))


MOVED = f"""(select k, i, x0 + dx as x0, y0 + dy as y0, x1 + dx as x1, y1 + dy as y1 from {BOXES}, (values (0, 0.0, 0.0), (1, 0.5, 0.0), (2, -0.5, 0.0), (3, 0.0, 0.5), (4, 0.0, -0.5), (5, 0.5, 0.5), (6, 0.5, -0.5), (7, -0.5, 0.5), (8, -0.5, -0.5)) s(i, dx, dy))"""
SHIFTED = f"""m as ({means_sql(MOVED, 'k, i')}), b as (select k, ttc from m where i = 0 and ttc is not null),
  s as (select b.k, b.ttc, case when b.ttc = 0 then 0 else sqrt(coalesce(sum(pow((m.ttc - b.ttc) / nullif(b.ttc, 0), 2)), 0) / 8) end as shift_error from b left join m on m.k = b.k and m.i > 0 and m.ttc is not null group by 1, 2)"""


@query("shift_error", f"with {SHIFTED} select k, round(ttc, 6) as ttc, round(shift_error, 6) as shift_error from s")
def shift_error(spark, d):
    found = zonal.shift_errors(site_boxes(spark, d), site_raster(spark, d), "k", 0.5).where("ttc is not null")
    return found.select("k", F.round("ttc", 6).alias("ttc"), F.round("shift_error", 6).alias("shift_error"))


#: Confidence intervals for these queries; a real run reads them from its own tables (zonal.interval_table).
INTERVAL = "p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double"
INTERVALS = [("Forest", 0.92, 0.95, 0.9, 0.96), ("Urban", 0.7, 0.93, 0.68, 0.94), ("Cropland", 0.91, 0.95, 0.9, 0.97)]
CATEGORY = "case k % 4 when 0 then 'URBAN' when 1 then 'cropland' when 2 then 'Forest' else 'swamp' end"
#: Sub-regions in the sites' units of degree: a triangle and two rectangles, which overlap; the first in order counts.
REGIONS = [
    (1, "east", [(3000.3, 0.3), (10500.3, 0.3), (10500.3, 8000.3)], 0.8, 0.97, 0.75, 0.96), (2, "west", [(0.3, 0.3), (5000.3, 0.3), (5000.3, 7000.3), (0.3, 7000.3)], 0.74, 0.98, 0.7, 0.95),
    (3, "north", [(2000.3, 5000.3), (10500.3, 5000.3), (10500.3, 9000.3), (2000.3, 9000.3)], 0.9, 0.99, 0.88, 0.97),
]
REGION = """case when x >= 3000.3 and x <= 10500.3 and y >= 0.3 and (y - 0.3) * 7500 <= (x - 3000.3) * 8000 then 1
  when x >= 0.3 and x <= 5000.3 and y >= 0.3 and y <= 7000.3 then 2 when x >= 2000.3 and x <= 10500.3 and y >= 5000.3 and y <= 9000.3 then 3 end"""


def region_table(spark):
    rows = [(i, name, geometry.wkb_of([[geometry.closed(points)]]), *interval) for i, name, points, *interval in REGIONS]
    return spark.createDataFrame(rows, f"place int, region string, geom binary, {INTERVAL}")


@query("first_region", f"""with c as (select k, (x0 + x1) / 2.0 as x, (y0 + y1) / 2.0 as y from v_polys), r as (select k, {REGION} as place from c)
  select k, case place when 1 then 'east' when 2 then 'west' when 3 then 'north' end as region from r""")
def first_region(spark, d):
    return zonal.first_region(centres(spark, d), region_table(spark), "k").select("k", "region")


def centres(spark, d):
    return view(spark, d, "v_polys").select("k", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))


@query("error_propagation", f"""with {SHIFTED}, j as (select s.k, s.ttc, s.shift_error, p.calc_area as area, {CATEGORY.replace('k %', 's.k %')} as category, (x0 + x1) / 2.0 as x, (y0 + y1) / 2.0 as y from s join v_polys p on p.k = s.k),
  t(name, pl, pu, rl, ru) as (values ('forest', 0.92, 0.95, 0.9, 0.96), ('urban', 0.7, 0.93, 0.68, 0.94), ('cropland', 0.91, 0.95, 0.9, 0.97)),
  g(place, gpl, gpu, grl, gru) as (values (1, 0.8, 0.97, 0.75, 0.96), (2, 0.74, 0.98, 0.7, 0.95), (3, 0.9, 0.99, 0.88, 0.97)),
  e as (select *, case when ttc = 0 then 0 else (pu - rl) / ttc end as lo, case when ttc = 0 then 0 else (ru - pl) / ttc end as hi,
    case when ttc = 0 then 0 else coalesce((gpu - grl) / ttc, 0) end as sub_lo, case when ttc = 0 then 0 else coalesce((gru - gpl) / ttc, 0) end as sub_hi,
    case when ttc = 0 or area > 0.5 then 0 else (case when round(ttc, 7) <= 10 then 3.6386 when round(ttc, 7) <= 40 then 16.68 when round(ttc, 7) <= 100 then 23.468 else 0 end) / ttc end as small
    from j join t on t.name = case when lower(category) in (select name from t) then lower(category) else 'forest' end left join g on g.place = {REGION}),
  f as (select k, ttc, ttc * sqrt(lo * lo + sub_lo * sub_lo + shift_error * shift_error / 4 + small * small / 4) as minus, ttc * sqrt(hi * hi + sub_hi * sub_hi + shift_error * shift_error / 4 + small * small / 4) as plus from e)
  select k, round(ttc, 6) as ttc, round(plus, 6) as error_plus, round(minus, 6) as error_minus, round((plus + minus) / 2, 6) as plus_minus_average from f""")
def error_propagation(spark, d):
    boxes = site_boxes(spark, d)
    details = boxes.select("k", F.col("calc_area").alias("area")).join(centres(spark, d), "k").withColumn("category", F.expr(CATEGORY))
    out = report.statistics(boxes, site_raster(spark, d), "k", details, spark.createDataFrame(INTERVALS, f"category string, {INTERVAL}"), region_table(spark), 0.5)
    return out.where("ttc is not null").select("k", *[F.round(c, 6).alias(c) for c in ("ttc", "error_plus", "error_minus", "plus_minus_average")])


@query("majority_land_cover", """with n as (select tile, u8 * 10 % 230 as code, count(*) as n from v_patch group by 1, 2), r as (select *, row_number() over (partition by tile order by n desc, code) as k from n)
  select tile, code, n, case when code = 190 then 'urban' when code = 130 then 'grassland' when code in (10, 11, 12, 20) then 'cropland' when code in (30, 40, 100, 110) then 'mosaic vegetation'
  when code in (120, 121, 122, 140, 150, 151, 152, 153, 200, 201, 202, 0, 220) then 'shrub/scrub/otherland' else 'forest' end as category from r where k = 1""")
def majority_land_cover(spark, d):
    found = zonal.majority(view(spark, d, "v_patch").withColumn("code", F.col("u8") * 10 % 230), "tile", "code")
    return found.withColumn("category", zonal.land_category(F.col("code")))


NEIGHBOUR = "(select tile, r, c, u8, max(r) over (partition by tile) + 1 as h, max(c) over (partition by tile) + 1 as w from v_patch)"


@query("bilinear_double", f"""with n as {NEIGHBOUR}, o as (select distinct tile, h, w, unnest([2 * r, 2 * r + 1]) as r, 2 * c as c2 from n), q as (select tile, h, w, r, unnest([c2, c2 + 1]) as c from o),
  k as (select *, (r + 0.5) / 2 - 0.5 as y, (c + 0.5) / 2 - 0.5 as x from q), e as (select k.*, unnest([{{'dr': 0, 'dc': 0}}, {{'dr': 0, 'dc': 1}}, {{'dr': 1, 'dc': 0}}, {{'dr': 1, 'dc': 1}}]) as d from k),
  g as (select tile, r, c, least(greatest(floor(y) + d.dr, 0), h - 1) as sr, least(greatest(floor(x) + d.dc, 0), w - 1) as sc, (case when d.dr = 1 then y - floor(y) else 1 - (y - floor(y)) end) * (case when d.dc = 1 then x - floor(x) else 1 - (x - floor(x)) end) as wt from e)
  select g.tile, cast(g.r as int) as r, cast(g.c as int) as c, round(sum(wt * n.u8), 6) as v from g join n on n.tile = g.tile and n.r = g.sr and n.c = g.sc group by 1, 2, 3""")
def bilinear_double(spark, d):
    return raster.doubled(view(spark, d, "v_patch").withColumnRenamed("u8", "v"), "v").withColumn("v", F.round("v", 6))


@query("parity_rollup", f"""with a as {U8}, b as (select tile, r, c, least(u8 + tile % 7, 254) as b from v_patch), j as (select label, round(avg(abs(u8 - b)), 6) as mae from a join b using (tile, r, c) where u8 <> 255 group by 1)
  select round(avg(mae), 6) as mean, min(mae) as least, (select label from j order by mae, label limit 1) as worst from j""")
def parity_rollup(spark, d):
    return raster.rolled_up(raster_parity(spark, d), "label", "mae")


@query("difference_percentiles", """with o as (select abs(u8 - least(u8 + tile % 7, 254)) as off from v_patch) select round(quantile_cont(off, 0.5), 6) as p50, round(quantile_cont(off, 0.9), 6) as p90, round(quantile_cont(off, 0.95), 6) as p95,
  round(quantile_cont(off, 0.99), 6) as p99, round(stddev_pop(off), 6) as std, count(*) filter (off = 0) as equal, count(*) filter (off <= 1e-6) as near, count(*) filter (off > 5) as far, max(off) as most from o""")
def difference_percentiles(spark, d):
    p = view(spark, d, "v_patch").select("tile", "r", "c", "u8")
    return raster.differences(p, p.withColumn("u8", F.least(F.col("u8") + F.col("tile") % 7, F.lit(254))), "u8", ["tile", "r", "c"])


@query("quality_filter", """select tile, round(avg(case when u8 % 12 in (0, 1, 2, 3, 7, 8, 9, 10, 11) then 1.0 else 0 end), 6) as bad from v_patch group by 1 having avg(case when u8 % 12 in (0, 1, 2, 3, 7, 8, 9, 10, 11) then 1.0 else 0 end) <= 0.75""")
def quality_filter(spark, d):
    found = scenes.usable(view(spark, d, "v_patch"), "tile", (F.col("u8") % 12).isin(*P.CLOUDY), 0.75)
    return found.withColumn("bad", F.round("bad", 6))


@query("quarter_frames", "select pixel, cast(floor(t / 6) * 3 + m as int) as frame, round(median(v), 8) as v from v_series, (select unnest([0, 1, 2]) as m) group by 1, 2")
def quarter_frames(spark, d):
    return quarter_medians(spark, d).select("pixel", F.explode(F.sequence(F.col("quarter") * 3, F.col("quarter") * 3 + 2)).alias("frame"), "v")
