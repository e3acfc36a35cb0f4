"""Queries over requests, polygons, objects and jobs, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixtures import view, with_views
from tessera.functions import scalars as S
from tessera.operators import components, coverage, inventory, patching, tiles, tracking

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return add


def v(spark, d, *names):
    out = [view(spark, d, n) for n in names]
    return out if len(out) > 1 else out[0]


TOKENS = """select event_id, case event_id % 7 when 0 then concat('  ', cast(user_id as {s}), 'X', cast(event_id % 1000 as {s}), 'Y ') when 1 then 'bad' when 2 then concat('-', cast(user_id as {s}), 'X3Y')
  when 3 then '12X' else concat(cast(user_id as {s}), 'X', cast(event_id % 1000 as {s}), 'Y') end as token from {events}"""


@query("tile_decode", f"""with t as ({TOKENS.format(s="varchar", events="events")}),
  m as (select *, regexp_extract(token, '^\\s*(-?\\d+)X(-?\\d+)Y\\s*$', 1) as a, regexp_extract(token, '^\\s*(-?\\d+)X(-?\\d+)Y\\s*$', 2) as b from t)
  select event_id, try_cast(a as int) as x_tile, try_cast(b as int) as y_tile, case when a <> '' then concat(cast(try_cast(a as int) as varchar), 'X', cast(try_cast(b as int) as varchar), 'Y') end as tag from m""")
def tile_decode(spark, d):
    tokens = spark.sql(TOKENS.format(s="string", events="{events}"), events=spark.read.parquet(f"{d}/events.parquet"))
    return tiles.decoded(tokens).select("event_id", "x_tile", "y_tile", S.tile_tag(F.col("x_tile"), F.col("y_tile")).alias("tag"))


@query("tile_keys", """select t.*, s.source, concat(year::varchar, '/raw/', x_tile::varchar, '/', y_tile::varchar, '/raw/', replace(s.p, '#', concat(x_tile::varchar, 'X', y_tile::varchar, 'Y'))) as object_key
  from v_tiles t, (values ('dem', 'misc/dem_#.hkl'), ('s1', 's1/#.hkl'), ('s2_10', 's2_10/#.hkl'), ('s2_20', 's2_20/#.hkl'), ('s2_dates', 'misc/s2_dates_#.hkl'), ('clouds', 'clouds/clouds_#.hkl')) s(source, p)""")
def tile_keys(spark, d):
    return inventory.expected_keys(v(spark, d, "v_tiles"), tuple(S.ARD_SOURCES))


@query("prediction_keys", """select year, x_tile, y_tile, concat(year::varchar, '/tiles/', x_tile::varchar, '/', y_tile::varchar, '/', x_tile::varchar, 'X', y_tile::varchar, 'Y_FINAL.tif') as raster,
  concat(year::varchar, '/tiles/', x_tile::varchar, '/', y_tile::varchar, '/', x_tile::varchar, 'X', y_tile::varchar, 'Y_FINAL.json') as sidecar from v_tiles""")
def prediction_keys(spark, d):
    c = [F.col(x) for x in ("year", "x_tile", "y_tile")]
    return v(spark, d, "v_tiles").select(*c, S.prediction_key(*c).alias("raster"), S.prediction_key(*c, "json").alias("sidecar"))


@query("json_request_tiles", """with a as (select event_id as e, user_id as u from events)
  select distinct 2020 + cast(e % 3 as int) as year, concat(cast(u as varchar), 'X', cast(e % 50 as varchar), 'Y') as token from a
  union select distinct 2020 + cast(e % 3 as int) as year, 'junk' as token from a""")
def json_request_tiles(spark, d):
    text = """select concat('{{"p', cast(user_id as string), '": {{"', cast(2020 + event_id % 3 as string), '": {{"missing_tiles": [" ', cast(user_id as string), 'X', cast(event_id % 50 as string),
      'Y ", "junk"]}}, "soon": {{"missing_tiles": ["1X1Y"]}}}}}}') as document from {events}"""
    return tiles.request_tiles(spark.sql(text, events=spark.read.parquet(f"{d}/events.parquet")))


@query("tile_equi_join", "select year, x_tile, y_tile, x_tile / 18.0 as lon, y_tile / 18.0 as lat from v_tiles join v_grid using (x_tile, y_tile)")
def tile_equi_join(spark, d):
    t, g = v(spark, d, "v_tiles", "v_grid")
    return tiles.on_grid(t, g.withColumns({"lon": F.col("x_tile") / 18.0, "lat": F.col("y_tile") / 18.0})).select("year", "x_tile", "y_tile", "lon", "lat")


MEETS = "x1 >= x_tile * 200 and x0 <= x_tile * 200 + 200 and y1 >= y_tile * 200 and y0 <= y_tile * 200 + 200"


@query("needed_tiles", f"""select distinct cast(year(plantstart) - 1 as int) as year, x_tile, y_tile from v_polys, v_grid
  where (ttc is null or cardinality(ttc) = 0) and valid and plantstart is not null and {MEETS} order by 1, 2, 3""")
def needed_tiles(spark, d):
    return tiles.needed_tiles(*v(spark, d, "v_polys", "v_grid")).orderBy("year", "x_tile", "y_tile")


@query("needed_tiles_all", f"select distinct cast(year(plantstart) - 1 as int) as year, x_tile, y_tile from v_polys, v_grid where valid and plantstart is not null and {MEETS}")
def needed_tiles_all(spark, d):
    return tiles.needed_tiles(*v(spark, d, "v_polys", "v_grid"), only_missing=False)


@query("polygon_tile_pairs", f"select poly_uuid, x_tile, y_tile from v_polys, v_grid where {MEETS}")
def polygon_tile_pairs(spark, d):
    p, g = v(spark, d, "v_polys", "v_grid")
    return tiles.boxes_on_grid(p.select("poly_uuid", "x0", "y0", "x1", "y1"), g).select("poly_uuid", "x_tile", "y_tile")


@query("project_clusters", f"""with recursive m as (select k, project_id, x_tile, y_tile from v_polys, v_grid where {MEETS}),
  e as (select distinct a.k as a, b.k as b from m a join m b using (project_id, x_tile, y_tile)),
  c(k, other) as (select distinct k, k from m union select c.k, e.b from c join e on c.other = e.a)
  select k, min(other) as cluster from c group by k""")
def project_clusters(spark, d):
    p, g = v(spark, d, "v_polys", "v_grid")
    return components.clusters(tiles.boxes_on_grid(p.select("k", "project_id", "x0", "y0", "x1", "y1"), g), "k", "project_id", "x_tile", "y_tile")


@query("request_semi_join", """select poly_uuid from v_polys p where exists (select 1 from v_request r where r.project_id = p.project_id and (r.plantstart_year is null or r.plantstart_year = year(p.plantstart)))""")
def request_semi_join(spark, d):
    return tiles.requested_any_year(*v(spark, d, "v_polys", "v_request")).select("poly_uuid")


@query("request_tuple_filter", "select poly_uuid from v_polys where (project_id, year(plantstart)) in (select (project_id, plantstart_year) from v_request where plantstart_year is not null)")
def request_tuple_filter(spark, d):
    return tiles.requested_pairs(*v(spark, d, "v_polys", "v_request")).select("poly_uuid")


@query("polygon_filter", """select poly_uuid from v_polys where project_id in ('1', '2', '3', '5', '8', '13', '21', '34') and framework_key in ('ASIA', 'EUROPE', 'AFRICA')
  and (list_contains(cohort, 'BUILDING') or list_contains(cohort, 'ASIA')) and calc_area > 0.5""")
def polygon_filter(spark, d):
    found = tiles.filtered(v(spark, d, "v_polys"), projects=("1", "2", "3", "5", "8", "13", "21", "34"), frameworks=("ASIA", "EUROPE", "AFRICA"), cohorts=("BUILDING", "ASIA"), where="calc_area > 0.5")
    return found.select("poly_uuid")


@query("scope_summary", """select project_id, short_name, framework_key, count(*) as n_polys, cast(min(year(plantstart)) as int) as min_year, cast(max(year(plantstart)) as int) as max_year,
  round(sum(calc_area), 1) as area from v_polys group by 1, 2, 3""")
def scope_summary(spark, d):
    return coverage.scope(v(spark, d, "v_polys"))


HAS = "list_contains(map_keys(ttc), cast(year(plantstart) - 1 as int))"


@query("ttc_coverage", f"""select coalesce(short_name, project_id) as label, count(*) as total,
  count(*) filter (ttc is not null and cardinality(ttc) > 0 and {HAS}) as correct_yr, count(*) filter (ttc is not null and cardinality(ttc) > 0 and not {HAS}) as wrong_yr,
  count(*) filter (ttc is null or cardinality(ttc) = 0) as missing from v_polys group by 1""")
def ttc_coverage(spark, d):
    return coverage.coverage(v(spark, d, "v_polys"))


@query("coverage_script", f"""select framework_key, count(*) as total, count(*) filter (coalesce({HAS}, false)) as covered, round(100.0 * count(*) filter (coalesce({HAS}, false)) / count(*), 1) as pct,
  cast(min(year(plantstart) - 1) as int) as min_pred, cast(max(year(plantstart) - 1) as int) as max_pred from v_polys group by 1""")
def coverage_script(spark, d):
    return coverage.framework_coverage(v(spark, d, "v_polys"))


@query("missing_summary", """select framework_key, short_name, count(*) as cnt, cast(grouping(framework_key) * 2 + grouping(short_name) as bigint) as level from v_polys
  where ttc is null or cardinality(ttc) = 0 group by grouping sets ((framework_key), (short_name, framework_key), ())""")
def missing_summary(spark, d):
    return coverage.missing_summary(v(spark, d, "v_polys"))


@query("missing_only", f"select poly_uuid from v_polys where not coalesce({HAS}, false)")
def missing_only(spark, d):
    return tiles.without_year(v(spark, d, "v_polys")).select("poly_uuid")


@query("year_histogram", "select cast(year(plantstart) - 1 as int) as pred_year, count(*) as n from v_polys where plantstart is not null group by 1")
def year_histogram(spark, d):
    return coverage.year_histogram(v(spark, d, "v_polys"))


SOURCES = ("s1", "dem")
THERE = """with k as (select year, x_tile, y_tile, concat(year::varchar, '/raw/', x_tile::varchar, '/', y_tile::varchar, '/raw/s1/', x_tile::varchar, 'X', y_tile::varchar, 'Y.hkl') in (select object_key from v_inventory) as s1,
  concat(year::varchar, '/raw/', x_tile::varchar, '/', y_tile::varchar, '/raw/misc/dem_', x_tile::varchar, 'X', y_tile::varchar, 'Y.hkl') in (select object_key from v_inventory) as dem from v_tiles) """


@query("availability", THERE + "select year, x_tile, y_tile, s1 and dem as available from k")
def availability(spark, d):
    return inventory.availability(*v(spark, d, "v_tiles", "v_inventory"), SOURCES)


@query("availability_matrix", THERE + "select * from k")
def availability_matrix(spark, d):
    return inventory.matrix(*v(spark, d, "v_tiles", "v_inventory"), SOURCES)


@query("availability_by_year", THERE + "select year, count(*) as needed, count(*) filter (s1 and dem) as existing, count(*) filter (not (s1 and dem)) as missing from k group by year")
def availability_by_year(spark, d):
    return inventory.by_year(*v(spark, d, "v_tiles", "v_inventory"), SOURCES)


@query("ready_for_predict", THERE + "select year, x_tile, y_tile from k where s1 and dem")
def ready_for_predict(spark, d):
    return inventory.ready(*v(spark, d, "v_tiles", "v_inventory"), SOURCES)


@query("chunk_ladder", """with n as (select *, row_number() over (order by year, x_tile, y_tile) - 1 as n from v_tiles)
  select year, x_tile, y_tile, cast(case when n < 100 then 1 when n < 300 then 2 when n < 700 then 3 when n < 1500 then 4 else floor((n - 1500) / 1600) + 5 end as int) as chunk from n""")
def chunk_ladder(spark, d):
    return tiles.numbered(v(spark, d, "v_tiles"), "year", "x_tile", "y_tile").select("year", "x_tile", "y_tile", tiles.chunk_of(F.col("n")).alias("chunk"))


@query("tile_upsert", """with o as (select k, calc_area as a from v_polys where k % 3 <> 0), n as (select k, calc_area * 2 as a from v_polys where k % 2 = 0)
  select coalesce(o.k, n.k) as k, coalesce(n.a, o.a) as a, case when n.k is null then 'untouched' when o.k is null then 'added' else 'replaced' end as outcome from o full join n on o.k = n.k""")
def tile_upsert(spark, d):
    p = v(spark, d, "v_polys")
    return tiles.upserted(p.where("k % 3 <> 0").select("k", F.col("calc_area").alias("a")), p.where("k % 2 = 0").select("k", (F.col("calc_area") * 2).alias("a")), "k")


STATES = ", ".join(f"count(*) filter (status = '{s}') as {s}" for s in tracking.STATES)


@query("job_status_by_task", f"select task_type, count(*) as total, {STATES}, round(100.0 * count(*) filter (status = 'success') / count(*), 1) as pct from v_jobs group by 1")
def job_status_by_task(spark, d):
    return tracking.status_by(v(spark, d, "v_jobs"), "task_type")


@query("job_status_by_region", f"select task_type, region, count(*) as total, {STATES}, round(100.0 * count(*) filter (status = 'success') / count(*), 1) as pct from v_jobs group by 1, 2")
def job_status_by_region(spark, d):
    return tracking.status_by(v(spark, d, "v_jobs"), "task_type", "region")


@query("job_overall", """select count(*) as n_jobs, count(*) filter (status = 'success') as n_success, count(*) filter (status = 'partial') as n_partial,
  count(*) filter (status not in ('success', 'partial')) as n_failed, count(*) filter (status = 'failed') as n_status_failed from v_jobs""")
def job_overall(spark, d):
    return tracking.overall(v(spark, d, "v_jobs"))


@query("dominant_task", "select task_type, count(*) as n from v_jobs group by 1 order by n desc, task_type limit 1")
def dominant_task(spark, d):
    return tracking.dominant_task(v(spark, d, "v_jobs"))


@query("job_durations", """select task_type, count(*) as n, round(avg(duration_sec), 6) as avg_sec, min(duration_sec) as min_sec, max(duration_sec) as max_sec
  from v_jobs where duration_sec is not null and duration_sec <> 0 group by 1""")
def job_durations(spark, d):
    return tracking.durations(v(spark, d, "v_jobs"))


@query("phase_percentiles", """with a as (select task_type, list(duration_sec order by duration_sec) as s, count(*) as n, avg(duration_sec) as m from v_jobs where duration_sec is not null group by 1)
  select task_type, n, round(m, 4) as mean, round(s[round_even(0.5 * (n - 1), 0)::bigint + 1], 4) as p50, round(s[round_even(0.95 * (n - 1), 0)::bigint + 1], 4) as p95, round(s[round_even(0.99 * (n - 1), 0)::bigint + 1], 4) as p99 from a""")
def phase_percentiles(spark, d):
    return tracking.phase_percentiles(v(spark, d, "v_jobs"))


PHASES = ["DEM", "S1_RTC", "S2", "predict"]


@query("phase_pivot", "select year, x_tile, y_tile, " + ", ".join(f"round(sum(duration_sec) filter (task_type = '{p}'), 4) as \"{p}\"" for p in PHASES) + " from v_jobs group by 1, 2, 3")
def phase_pivot(spark, d):
    return tracking.phases_wide(v(spark, d, "v_jobs"), PHASES)


@query("tile_verdicts", """select year, x_tile, y_tile, case when bool_or(status not in ('success', 'partial')) then 'failed' else 'success' end as verdict,
  round(sum(coalesce(duration_sec, 0)), 4) as seconds, arg_min(error, seq) filter (error is not null) as first_error from v_jobs group by 1, 2, 3""")
def tile_verdicts(spark, d):
    return tracking.tile_verdicts(v(spark, d, "v_jobs"))


@query("failed_jobs", "select seq, task_type, region, status, error from v_jobs where status not in ('success', 'partial')")
def failed_jobs(spark, d):
    return v(spark, d, "v_jobs").where(~F.col("status").isin(*tracking.GOOD)).select("seq", "task_type", "region", "status", "error")


@query("run_exit_code", """with b as (select count(*) filter (status not in ('success', 'partial')) as bad, count(*) as n from v_jobs)
  select case when bad = n and bad > 0 then 2 when bad > 0 then 1 else 0 end as exit_code from b""")
def run_exit_code(spark, d):
    return tracking.exit_code(v(spark, d, "v_jobs"))


@query("retry_rollup", """select task_type, count(*) filter (error like 'HTTP 503%' or error like '%timeout%') as retryable, count(*) filter (error = 'bad geometry') as permanent,
  cast(sum(greatest(attempts - 1, 0)) as bigint) as retries from v_jobs group by 1""")
def retry_rollup(spark, d):
    return tracking.retries(v(spark, d, "v_jobs"))


@query("pending_tiles", """select * from v_tiles t where not exists (select 1 from v_jobs j where j.task_type = 'S2' and j.status in ('success', 'partial') and j.year = t.year + 24 and j.x_tile = t.x_tile and j.y_tile = t.y_tile)""")
def pending_tiles(spark, d):
    t, j = v(spark, d, "v_tiles", "v_jobs")
    return tracking.pending(t, j.withColumn("year", F.col("year") - 24), "S2")


@query("audit_drops", "select poly_uuid, project_id from v_polys where poly_uuid not in (select cast(l_orderkey as varchar) from lineitem where l_linenumber = 3)")
def audit_drops(spark, d):
    done = spark.read.parquet(f"{d}/lineitem.parquet").where("l_linenumber = 3").select(F.col("l_orderkey").alias("poly_uuid"))
    return patching.dropped(v(spark, d, "v_polys"), done).select("poly_uuid", "project_id")


RESULTS = """select case when l_orderkey % 31 = 0 then null when l_orderkey % 37 = 0 then 'p' else cast(l_orderkey as {s}) end as poly_uuid, l_linenumber as part,
  case when l_orderkey % 7 = 0 then 'n/a' else cast(l_quantity as {s}) end as ttc, case when l_orderkey % 2 = 0 then cast(year(l_shipdate) as {s}) end as year, l_tax as shift_error from {lineitem}"""


def results(spark, d):
    return spark.sql(RESULTS.format(s="string", lineitem="{lineitem}"), lineitem=spark.read.parquet(f"{d}/lineitem.parquet"))


PATCHED = f"""with r as ({RESULTS.format(s="varchar", lineitem="lineitem")}), o as (select coalesce(r.poly_uuid, '') as poly_uuid, part, try_cast(r.ttc as double) as value, coalesce(try_cast(r.year as int), 2024) as y,
  case when coalesce(r.poly_uuid, '') = '' then 'error' when p.poly_uuid is null then 'unmatched' when try_cast(r.ttc as double) is null then 'error' else 'dryrun' end as status
  from r left join (select poly_uuid from v_polys where k % 2 = 1 or k % 4 = 0) p on r.poly_uuid = p.poly_uuid) """


@query("patch_outcomes", PATCHED + "select poly_uuid, part, status, case when value is not null then value end as value, case when value is not null then y end as year from o")
def patch_outcomes(spark, d):
    known = v(spark, d, "v_polys").where("k % 2 = 1 or k % 4 = 0")
    found = patching.outcomes(results(spark, d), known, patching.indicator("ttc", "year", 2024, "shift_error"))
    return found.select("poly_uuid", "part", "status", F.col("payload.value").alias("value"), F.col("payload.year").alias("year"))


@query("patch_summary", PATCHED + "select s.status, count(o.status) as n from (values ('sent'), ('dryrun'), ('unmatched'), ('error')) s(status) left join o using (status) group by 1")
def patch_summary(spark, d):
    known = v(spark, d, "v_polys").where("k % 2 = 1 or k % 4 = 0")
    return patching.outcome_counts(patching.outcomes(results(spark, d), known, patching.indicator("ttc", "year", 2024)))


@query("cost_estimate", """with t(source, sec, mb) as (values ('DEM', 9, 4096), ('S1', 14, 2048), ('S2', 62, 4096), ('predict', 180, 6144))
  select year, source, n, round(n * sec * (mb / 1024.0) * 0.00001667, 6) as usd from (select year, count(*) as n from v_tiles group by 1), t""")
def cost_estimate(spark, d):
    tasks = spark.createDataFrame([("DEM", 9, 4096), ("S1", 14, 2048), ("S2", 62, 4096), ("predict", 180, 6144)], "source string, sec int, mb int")
    n = v(spark, d, "v_tiles").groupBy("year").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(tasks)).select("year", "source", "n", F.round(S.invocation_cost(F.col("n"), F.col("sec"), F.col("mb")), 6).alias("usd"))


@query("legacy_ordinal", """select scene_id, cast((year(acquired) - 1996) * 365 + [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334][month(acquired)] + day(acquired) as int) as ordinal,
  case when year(acquired) = 1996 then cast(dayofyear(acquired) as int) end as doy from v_scenes""")
def legacy_ordinal(spark, d):
    s = v(spark, d, "v_scenes")
    return s.select("scene_id", S.legacy_ordinal(F.col("acquired"), 1996).alias("ordinal"), F.when(F.year("acquired") == 1996, F.dayofyear("acquired")).alias("doy"))


@query("tile_boxes", """select x_tile, y_tile, round(x_tile / 18.0 - 1 / 36.0, 9) as west, round(y_tile / 18.0 - 1 / 36.0, 9) as south, round(x_tile / 18.0 + 1 / 36.0, 9) as east,
  round(y_tile / 18.0 + 1 / 36.0, 9) as north, round(6378137.0 * radians(x_tile / 18.0), 3) as mx, round(6378137.0 * ln(tan(pi() / 4 + radians(y_tile / 18.0) / 2)), 3) + 0.0 as my from v_grid""")
def tile_boxes(spark, d):
    lon, lat = F.col("x_tile") / 18.0, F.col("y_tile") / 18.0
    r = lambda c: F.round(c, 9)
    return v(spark, d, "v_grid").select(
        "x_tile", "y_tile", r(lon - 1 / 36).alias("west"), r(lat - 1 / 36).alias("south"), r(lon + 1 / 36).alias("east"), r(lat + 1 / 36).alias("north"),
        F.round(S.mercator_x(lon), 3).alias("mx"), (F.round(S.mercator_y(lat), 3) + 0.0).alias("my"),
    )


K2 = "concat(year::varchar, '/raw/', x_tile::varchar, '/', y_tile::varchar, '/raw/', '{p}', x_tile::varchar, 'X', y_tile::varchar, 'Y.hkl')"


@query("first_existing_key", f"""with k as (select year, x_tile, y_tile, {K2.format(p="misc/dem_")} as a, {K2.format(p="s1/")} as b from v_tiles)
  select year, x_tile, y_tile, case when a in (select object_key from v_inventory) then a when b in (select object_key from v_inventory) then b end as object_key,
  case when a in (select object_key from v_inventory) then 0 when b in (select object_key from v_inventory) then 1 end as place from k""")
def first_existing_key(spark, d):
    t, i = v(spark, d, "v_tiles", "v_inventory")
    c = [F.col(x) for x in ("year", "x_tile", "y_tile")]
    return inventory.first_there(t, [S.source_key("dem", *c), S.source_key("s1", *c)], i, "year", "x_tile", "y_tile")


@query("tile_ids", "select distinct regexp_extract(object_key, '(\\d+X\\d+Y)[^/]*$', 1) as tag from v_inventory")
def tile_ids(spark, d):
    return inventory.tile_ids(v(spark, d, "v_inventory"))
