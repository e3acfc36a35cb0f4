"""Operators that SQL can't check: kernels, files, streams and edge cases."""

import json
import math
import struct
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import clouds, geometry, patching, raster, temporal, tiles, zonal
from tessera.plans import report
from tessera.sources import files
from tessera.streaming import jobs as stream


def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


SQUARE = np.array([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], float)
HOLE = np.array([(0.5, 0.5), (0.5, 1), (1, 1), (1, 0.5), (0.5, 0.5)])
BOW = np.array([(0, 0), (2, 2), (2, 0), (0, 1.5), (0, 0)], float)


def test_polygons_are_described(spark):
    rows = [
        ("ok", geometry.wkb_of([[SQUARE, HOLE]])), ("invalid_but_repairable", geometry.wkb_of([[BOW]])), ("zero_area", geometry.wkb_of([[SQUARE * [1, 0]]])),
        ("empty_geometry", struct.pack("<BII", 1, 3, 0)), ("wrong_geom_type", struct.pack("<BIdd", 1, 1, 0, 0)), ("wkb_parse_error", b"\x01"), ("wkb_parse_error", None),
        ("invalid_unrepairable", geometry.wkb_of([[SQUARE[:3]]])), ("ok", geometry.wkb_of([[SQUARE], [SQUARE + 5]])),
    ]
    df = spark.createDataFrame([(i, s, g) for i, (s, g) in enumerate(rows)], "k int, want string, geom binary")
    got = {r.k: r for r in geometry.described(df).collect()}
    assert all(r.status == r.want for r in got.values())
    assert got[0].cx == pytest.approx((4 * 1 - 0.25 * 0.75) / 3.75) and (got[0].w, got[0].n) == (0, 2)
    square_degree = (6371007.2**2) * math.radians(1) * (math.sin(math.radians(1)) - 0) / 1e4  # on the sphere of equal area
    one = geometry.described(spark.createDataFrame([(geometry.wkb_of([[SQUARE / 2]]),)], "geom binary")).first()
    assert one.hectares == pytest.approx(square_degree, rel=5e-3)
    parts = geometry.exploded(df.where("k = 8")).collect()
    assert [r.part_idx for r in parts] == [0, 1]
    over = df.where("k = 0").select(geometry.tile_overlap(F.col("geom"), F.lit(0.75), F.lit(0.0), F.lit(3.0), F.lit(1.0)).alias("a"), geometry.within(F.col("geom"), F.lit(0.7), F.lit(0.7)).alias("i")).first()
    assert over.a == pytest.approx(1.25 - 0.125) and over.i is False


def test_weights_of_resampling(spark):
    sets = {1: [0, 8, 40, 200, 330], 2: [100, 120], 3: [200], 4: [5, 30], 5: [91, 180, 269]}
    days = spark.createDataFrame([(k, d) for k, ds in sets.items() for d in ds] + [(1, 8), (6, None)], "tile int, day int")
    by = {}
    for r in temporal.resampling_weights(days, "tile", "day").collect():
        by.setdefault((r.tile, r.target), {})[r.day] = r.w
    assert set(by) == {(k, t) for k in sets for t in range(24)} and all(sum(x.values()) == pytest.approx(1) for x in by.values())
    # Target 15: 0 and 8 lie before (8 nearer), 40 and 200 after, of which 200 is out of reach of 40.
    near = by[1, 1]
    assert set(near) == {0, 8, 40}
    b, a, closest = [15.0, 7.0], 25.0, 32.0
    second, after = 1 - b[1] / closest, 1 - a / closest
    first = b[1] / b[0] * second
    assert near[8] == pytest.approx(second / (first + second + after)) and near[0] == pytest.approx(first / (first + second + after))
    assert set(by[2, 0]) == {100, 120} and by[3, 7] == {200: pytest.approx(1)}
    # Target 0 of tile 5: the year turns to 269 (96 days off), after are 91 and 180 (within reach).
    turned = by[5, 0]
    x, y, z = 1 - 96 / 187, 1 - 91 / 187, 91 / 180 * (1 - 91 / 187)
    assert turned == pytest.approx({269: x / (x + y + z), 91: y / (x + y + z), 180: z / (x + y + z)})
    # Target 345 of tile 4: nothing after; its last day is early in the year, so the first day stands for the next year's.
    x, y, z = 1 - 315 / 340, 1 - 25 / 340, 315 / 340 * (1 - 315 / 340)
    assert by[4, 23] == pytest.approx({30: x / (x + y + z), 5: (y + z) / (x + y + z)})


def test_smoothing_keeps_constants_and_lines(spark):
    m = temporal.whittaker_matrix()
    assert m.shape == (12, 24) and m.sum(1) == pytest.approx(np.ones(12))
    assert m @ np.arange(24.0) == pytest.approx(np.arange(24.0).reshape(12, 2).mean(1))
    rough = np.random.default_rng(0).normal(size=24)
    spread = [np.abs(np.diff(temporal.whittaker_matrix(s, months=24) @ rough, 2)).sum() for s in (1, 100, 10000)]
    assert spread[0] > spread[1] > spread[2]


def test_false_clouds_go_pair_by_pair(spark):
    cases = {"110": "000", "111": "001", "1111": "0000", "1011": "1000", "": ""}
    df = spark.createDataFrame([(k, [int(x) for x in k]) for k in cases], "k string, f array<int>")
    got = df.select("k", F.array_join(temporal.without_false_clouds(F.col("f")).cast("array<string>"), "").alias("o")).collect()
    assert {r.k: r.o for r in got} == cases


def test_weighted_means_and_their_flags(spark):
    pixels = spark.createDataFrame([(r, c, 255 if (r, c) == (0, 0) else 10 * r + c) for r in range(3) for c in range(3)], "r int, c int, u8 int")
    boxes = spark.createDataFrame([(1, 0.5, 0.5, 2.0, 1.0), (2, 0.0, 0.0, 1.0, 1.0), (3, 1.0, 1.0, 1.02, 1.02), (4, 0.97, 1.0, 2.0, 2.0)], "k int, x0 double, y0 double, x1 double, y1 double")
    got = {r.k: r.ttc for r in zonal.zonal_means(boxes, pixels, ["k"]).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: 11.0}
    table = spark.createDataFrame([("Forest", 0.9, 0.95, 0.9, 0.96)], "category string, p_lower_95 double, p_upper_95 double, r_lower_95 double, r_upper_95 double")
    rows = spark.createDataFrame([(1, 0.0, 0.1, 0.3, "x"), (2, 10.0, 0.5, 0.0, "FOREST"), (3, 10.01, 0.5, 0.0, "forest"), (4, None, 0.1, 0.0, None)], "k int, ttc double, area double, shift_error double, category string")
    errors = {r.k: r for r in zonal.with_errors(rows, table).collect()}
    assert errors[1].error_plus == 0.0 * 0.15 and errors[4].error_plus is None
    small = lambda raw, t: math.sqrt(((0.96 - 0.9) / t) ** 2 + (raw / t / 2) ** 2) * t
    assert errors[2].error_plus == pytest.approx(small(3.6386, 10)) and errors[3].error_plus == pytest.approx(small(16.68, 10.01))
    inf = spark.range(1).select(zonal.no_infinity(F.lit(float("inf"))).alias("a"), zonal.no_infinity(F.lit(-2.0)).alias("b")).first()
    assert (inf.a, inf.b) == (0.0, -2.0)


def test_regions_and_windows(spark):
    corner = geometry.closed([(1, 1), (3, 3), (1, 3)])  # a triangle: its envelope holds what it doesn't
    regions = spark.createDataFrame([(1, "a", geometry.wkb_of([[SQUARE]])), (2, "b", geometry.wkb_of([[corner]])), (3, "c", None)], "place int, region string, geom binary")
    points = spark.createDataFrame([(1, 1.5, 1.6), (2, 2.4, 2.6), (3, 2.6, 2.4), (4, 9.0, 9.0), (5, None, 1.0)], "k int, x double, y double")
    for cell in (500.0, 0.5):
        assert {r.k: r.region for r in zonal.first_region(points, regions, "k", cell).collect()} == {1: "a", 2: "b", 3: None, 4: None, 5: None}
    w = raster.windows(10, 7, 4, 3, spark).collect()
    assert {(r.r0, r.c0) for r in w} == {(a, b) for a in (0, 3, 6) for b in (0, 3)}


def scene(spark, f, n=9, t=3):
    rows = [(1, i, r, c, *[float(x) for x in f(i, r, c)]) for i in range(t) for r in range(n) for c in range(n)]
    return spark.createDataFrame(rows, "tile int, t int, r int, c int, " + ", ".join(f"b{i} double" for i in range(10)))


def test_cloud_masks(spark):
    cloudy = lambda i, r, c: i == 1 and r < 6 and c < 6
    px = scene(spark, lambda i, r, c: [0.5 if cloudy(i, r, c) else 0.1] * 7 + [0.5 if cloudy(i, r, c) else 0.15] * 3)
    masked = clouds.bright_clouds(px)
    assert {r.t for r in masked.where("cloud").select("t").distinct().collect()} == {1}
    assert clouds.brightening(px).where("cloud").count() == 36
    dark = scene(spark, lambda i, r, c: [0.08 - 0.05 * (i == 2 and r == 0)] * 3 + [0.3] + [0.2] * 3 + [0.16 - 0.1 * (i == 2 and r == 0)] * 3)
    assert clouds.darkening(dark).where("shadow").count() == 9
    soft = {(r.r, r.c): r.interp for r in clouds.interpolation_weights(px.withColumn("cloud", F.expr("r = 4 and c = 4"))).where("t = 0").collect()}
    assert soft[4, 4] == 1 and all(0 <= x <= 1 for x in soft.values())
    near = {(r.r, r.c): r.n for r in clouds.nearness(px.withColumn("f", F.expr("r = 4 and c = 4")), "f", 3, "n").where("t = 0").collect()}
    assert near[4, 4] == 1 and near[4, 5] == pytest.approx(1 - 1 / 3) and near[3, 5] == pytest.approx(1 - 2**0.5 / 3) and near[0, 0] == 0
    flat = clouds.aligned_mosaic(px.select("tile", "t", "r", "c", F.col("b0").alias("v"), F.when(F.expr("t = 1 and r < 6 and c < 6"), 1.0).otherwise(0.0).alias("interp")))
    assert {round(r.v, 6) for r in flat.collect()} == {0.1}
    bare = scene(spark, lambda i, r, c: [0.3, 0.3, 0.3, 0.3, 0, 0, 0, 0, 0.9, 0] if r < 7 and c < 7 else [0.1, 0.1, 0.1, 0.5, 0, 0, 0, 0, 0.1, 0])
    kept = {(r.r, r.c): r.kept for r in clouds.bright_surfaces(bare).collect()}
    assert kept[0, 0] == 0 and kept[8, 8] > 0
    gone = {(r.r, r.c): r.nodata for r in clouds.no_data(scene(spark, lambda i, r, c: [0.0 if (r, c) == (0, 0) else 0.2] * 10), 2).collect()}
    assert gone[0, 2] and gone[1, 1] and not gone[2, 1] and not gone[0, 3]


def test_files(spark):
    t = spark.createDataFrame([(2023, -54.5, -9.2, 1000, 798), (2024, 0.0, 0.5, -3, 9)], "year int, lon double, lat double, x_tile int, y_tile int")
    path = f"{folder()}/tiles"
    files.write_tiles_csv(t, path)
    assert sorted(map(tuple, files.tiles_csv(spark, path).collect())) == sorted(map(tuple, t.collect()))
    t.write.csv(f"{path}-bad", header=True)
    with pytest.raises(ValueError, match="missing columns"):
        files.tiles_csv(spark, f"{path}-bad")
    jobs = [{"job_id": "1", "status": "failed", "tile_info": {"year": 2023, "lon": 1.0, "lat": 2.0, "X_tile": 5, "Y_tile": 6}}, {"job_id": "2"}]
    at = folder()
    with open(f"{at}/jobs.json", "w") as f:
        json.dump(jobs, f)
    assert [(r.year, r.x_tile) for r in files.failed_jobs(spark, f"{at}/jobs.json").collect()] == [(2023, 5)]
    import os

    for i, text in enumerate(['{"run_id": "a", "start_time": "2024-01-01"}', '{"run_id": "b", "start_time": "2024-02-01"}', "not json", '{"run_id": "c"}']):
        os.makedirs(f"{at}/{i}")
        with open(f"{at}/{i}/summary.json", "w") as f:
            f.write(text)
    assert [r.run_id for r in files.runs(spark, at).collect()] == ["b", "a", "c"]
    with open(f"{at}/p.geojson", "w") as f:
        ring = [[0, 0], [1, 0], [0, 1], [0, 0]]
        shapes = [{"type": "Polygon", "coordinates": [ring]}, {"type": "MultiPolygon", "coordinates": [[ring], [[[5, 5, 9], [6, 5, 9], [5, 6, 9], [5, 5, 9]]]]}, {"type": "Point", "coordinates": [1, 2]}]
        json.dump({"type": "FeatureCollection", "features": [{"properties": {"poly_uuid": str(i), "plantstart": "2021-05-01"}, "geometry": g} for i, g in enumerate(shapes)]}, f)
    one, two, none = sorted(files.geojson(spark, f"{at}/p.geojson").collect(), key=lambda r: r.properties["poly_uuid"])
    assert one.polygons[0][0][1] == [1.0, 0.0] and len(two.polygons) == 2 and none.polygons is None and none.geom is None
    assert geometry.area_centre(geometry.rings_of(bytes(two.geom))[1])[0] == pytest.approx(1.0)
    assert [files.kind_of(p, h) for p, h in (("a.csv", ["Year", "X_tile", "Y_tile"]), ("a.csv", ["project_id"]), ("a.parquet", None), ("a.json", None), ("NAME", None))] == ["tiles_csv", "request_csv", "polygon_file", "json_request", "short_name"]
    item = json.loads(files.stac_items(t).first()["item"])
    assert item["id"] == "1000X798Y_2023" and item["geometry"]["coordinates"][0][0] == item["geometry"]["coordinates"][0][4]
    t.write.parquet(f"{at}/grid")
    assert files.grid(spark, f"{at}/nothing", path).count() == 2 and files.grid(spark, f"{at}/grid").count() == 2
    with pytest.raises(FileNotFoundError):
        files.grid(spark, f"{at}/nothing")


def test_chunks_are_written(spark):
    t = spark.range(250).select(F.lit(2023).alias("year"), (F.col("id") % 25).cast("int").alias("x_tile"), (F.col("id") / 25).cast("int").alias("y_tile"))
    path = f"{folder()}/chunks"
    tiles.write_chunks(t, path)
    sizes = {r.chunk: r["count"] for r in spark.read.csv(path, header=True, inferSchema=True).groupBy("chunk").count().collect()}
    assert sizes == {1: 100, 2: 150}
    tiles.write_chunks(t, f"{path}-fixed", 60)
    assert sorted(r["count"] for r in spark.read.csv(f"{path}-fixed", header=True).groupBy("chunk").count().collect()) == [10, 60, 60, 60, 60]


def test_requests_that_are_odd(spark):
    docs = ['{"p": {"2023": {"missing_tiles": ["1X2Y", " 1X2Y "]}, "x": {"missing_tiles": ["9X9Y"]}}}', '{"q": 5}', "junk", None, "{}"]
    got = tiles.request_tiles(spark.createDataFrame([(d,) for d in docs], "document string")).collect()
    assert [(r.year, r.token) for r in got] == [(2023, "1X2Y")]
    with pytest.raises(ValueError, match="not a predicate"):
        tiles.checked_predicate("a = 1; drop table x")
    with pytest.raises(ValueError, match="at least one"):
        tiles.filtered(spark.range(1))
    assert tiles.checked_predicate("updated_at > 3") == "updated_at > 3"


def test_patching_names_and_payloads(spark):
    assert patching.uncertainty_column(["poly_uuid", "TTC", "shift_error"]) == "shift_error"
    assert patching.uncertainty_column(["a_stderr"]) == "a_stderr" and patching.uncertainty_column(["a"]) is None
    rows = spark.createDataFrame([("a", "80", None), ("b", "NaN", "2024"), ("c", None, "2024"), ("", "1", "2024"), (None, "1", "2024"), ("zz", "1", "2024")], "poly_uuid string, TTC string, year string")
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "poly_uuid string")
    got = [(r.poly_uuid, r.status) for r in patching.outcomes(rows, known, patching.indicator("ttc", "year", 2023), apply=True).collect()]
    assert sorted(got) == [("", "error"), ("", "error"), ("a", "sent"), ("b", "error"), ("c", "error"), ("zz", "unmatched")]
    without = patching.outcomes(rows, known, patching.indicator("ttc", "year", None)).where("poly_uuid = 'a'").first()
    assert without.status == "error"


def test_reports(spark, sf):
    from tessera.fixtures import view

    p, g, o = (view(spark, sf, n) for n in ("v_polys", "v_grid", "v_inventory"))
    found = report.status_report(p, g, o, frameworks=("ASIA",))
    assert {r.framework_key for r in found["scope"].collect()} == {"ASIA"} and found["presence"].count() > 0
    run = report.project_run(p, g, o, missing_only=True)
    assert run["ready"].count() + run["fetch"].count() == run["tiles"].count()
    assert report.markdown(found["presence"].orderBy("year"), "Presence").startswith("## Presence\n\n| year | needed |")


def test_scalars_at_their_limits(spark):
    row = spark.range(1).select(
        scalars.quantise(F.lit(2.5 / 65535)).alias("even"), scalars.quantise(F.lit(-1.0)).alias("low"), scalars.radar_db(F.lit(0.0)).alias("dark"), scalars.radar_db(F.lit(1.0)).alias("light"),
        scalars.small_float(F.lit("nan")).alias("nan"), scalars.legacy_ordinal(F.to_date(F.lit("2025-03-01")), 2024).alias("march"),
    ).first()
    assert (row.even, row.low, row.dark, row.nan, row.march) == (2, 0, 0.0, None, 425) and row.light == pytest.approx(1, abs=1e-5)


def test_stream_counts_like_the_batch(spark, sf):
    from tessera.fixtures import view

    at = f"{folder()}/jobs"
    jobs = view(spark, sf, "v_jobs").join(spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("seq"), "ts"), "seq")
    jobs.select("ts", "task_type", "status").repartition(3).write.parquet(at)
    source = spark.readStream.schema(spark.read.parquet(at).schema).option("maxFilesPerTrigger", 10).parquet(at)
    q = stream.status_windows(source).writeStream.outputMode("complete").format("memory").queryName("job_windows").start()
    q.processAllAvailable()
    q.stop()
    total = spark.table("job_windows").agg(F.sum("jobs"), F.sum("good")).first()
    assert (total[0], total[1]) == (jobs.count(), jobs.where("status in ('success', 'partial')").count())


def test_radar_annotations(spark):
    from tessera.sources import radar

    at = folder()

    def put(name, text):
        with open(f"{at}/{name}", "w") as f:
            f.write(text)
        return f"{at}/{name}"

    vector = lambda line, pixel, tag, values: f"<V>{'' if line is None else f'<line>{line}</line>'}<pixel>{pixel}</pixel><{tag}>{values}</{tag}></V>"
    lists = lambda kind, *vs: f"<c><{kind}List count='2'>{''.join(vs)}</{kind}List></c>".replace("<V>", f"<{kind}>").replace("</V>", f"</{kind}>")
    path = put("cal.xml", lists("calibrationVector", vector(0, "0 40 80", "sigmaNought", "1.5 2.5 3.5"), vector(7, "0 40", "sigmaNought", "4 5")))
    assert sorted(map(tuple, radar.lut(spark, path, "calibrationVector", "sigmaNought").collect())) == [(0, 0, 1.5), (0, 40, 2.5), (0, 80, 3.5), (7, 0, 4.0), (7, 40, 5.0)]
    path = put("noise.xml", lists("noiseRangeVector", vector(3, "1 2", "noiseRangeLut", "9 8"), vector(None, "5 x", "noiseLut", "7 6")))
    assert sorted(map(tuple, radar.noise_lut(spark, path).collect())) == [(1, 5, 7.0), (3, 1, 9.0), (3, 2, 8.0)]
    path = put("azimuth.xml", lists("noiseAzimuthVector", vector(None, "1", "noiseAzimuthLut", "2"), vector(None, "4", "noiseAzimuthLut", "3")))
    assert sorted(map(tuple, radar.noise_lut(spark, path).collect())) == [(0, 1, 2.0), (1, 4, 3.0)]
    points = [(0, 0, 30), (0, 10, 32), (20, 0, 31), (20, 10, "x")]
    path = put("grid.xml", "<g>" + "".join(f"<geolocationGridPoint><line>{a}</line><pixel>{b}</pixel><incidenceAngle>{c}</incidenceAngle></geolocationGridPoint>" for a, b, c in points) + "</g>")
    assert sorted(map(tuple, radar.incidence_grid(spark, path).collect()), key=lambda p: p[:2]) == [(0, 0, 30.0), (0, 10, 32.0), (20, 0, 31.0), (20, 10, None)]
    path = put("mid.xml", "<g><imageInformation><incidenceAngleMidSwath>38.5</incidenceAngleMidSwath></imageInformation></g>")
    assert [tuple(r) for r in radar.incidence_grid(spark, path).collect()] == [(0, 0, 38.5)]
    assert [r.angle for r in radar.incidence_grid(spark, put("none.xml", "<g><a>1</a></g>")).collect()] == [35.0]


def test_tables_brought_to_pixels(spark):
    from tessera.operators import radar

    grid = spark.createDataFrame([(a, b, None if (a, b) == (9, 6) else 30.0 + a + 0.5 * b) for a in (0, 4, 9) for b in (0, 3, 6)], "line int, pixel int, angle double")
    got = {(r.r, r.c): r.angle for r in radar.interpolated(grid, "angle", 12, 8, 35.0).collect()}
    assert len(got) == 96
    for (r, c), v in got.items():
        if not (r > 4 and c > 3):  # elsewhere the grid is a plane, carried on beyond it
            assert v == pytest.approx(30 + r + 0.5 * c)
    assert {r.angle for r in radar.interpolated(grid.where("line = 0"), "angle", 2, 2, 35.0).collect()} == {35.0}
    points = [(0, 0, 1.0), (0, 7, 2.0), (6, 3, 3.0), (2, 7, 0.0), (50, 1, 9.0)]
    got = {(r.r, r.c): r.v for r in radar.nearest_values(spark.createDataFrame(points, "line int, pixel int, v double"), "v", 9, 10).collect()}
    assert len(got) == 90
    for (r, c), v in got.items():
        near = sorted(((a - r) ** 2 + (b - c) ** 2, x) for a, b, x in points[:3])
        assert v in {x for d, x in near if d == near[0][0]}
    assert {r.v for r in radar.nearest_values(spark.createDataFrame([], "line int, pixel int, v double"), "v", 2, 2).collect()} == {1.0}
    boxes = [("a", 0.0, 0.0, 2.0, 2.0), ("a", 1.0, 1.0, 3.0, 3.0), ("a", -5.0, 3.5, 9.0, 9.0), ("b", 8.0, 8.0, 9.0, 9.0)]
    share = radar.covered_share(spark.createDataFrame(boxes, "day string, w double, s double, e double, n double"), ["day"], F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("s"), F.lit(4.0).alias("e"), F.lit(4.0).alias("n")))
    assert {r.day: r.share for r in share.collect()} == {"a": pytest.approx((4 + 4 - 1 + 2) / 16), "b": 0.0}


def test_polygon_coverage_and_meeting(spark):
    rng = np.random.default_rng(3)
    for _ in range(20):
        ring = geometry.closed(sorted(map(tuple, rng.uniform(-2, 9, (7, 2))), key=lambda p: math.atan2(p[1] - 3.5, p[0] - 3.5)))  # star-shaped
        hole = geometry.closed([(3.3, 3.3), (3.6, 3.4), (3.5, 3.8)])
        parts = [[ring, hole]]
        got = geometry.coverage(parts, -3, -3, 13, 14)
        want = np.array([[geometry.clip_area(parts, c, r, c + 1, r + 1) for c in range(-3, 10)] for r in range(-3, 11)])
        assert got == pytest.approx(want, abs=1e-9) and got.sum() == pytest.approx(geometry.area_centre(parts)[0])
        for r in range(-3, 11):
            for c in range(-3, 10):
                if want[r + 3, c + 3] > 1e-9:
                    assert geometry.meets_box([[ring]], c, r, c + 1, r + 1)
    assert geometry.meets_box([[SQUARE]], 2, 0, 3, 1) and geometry.meets_box([[SQUARE]], 2, 2, 3, 3) and not geometry.meets_box([[SQUARE]], 2.01, 0, 3, 1)
    assert geometry.meets_box([[SQUARE]], 0.5, 0.5, 1, 1) and not geometry.meets_box([[SQUARE, geometry.closed([(0.2, 0.2), (1.8, 0.2), (1.8, 1.8), (0.2, 1.8)])]], 0.5, 0.5, 1, 1)
    open_ring = geometry.wkb_of([[SQUARE[:-1]], [SQUARE[:-1] * 0.1 + 5]])
    mended = geometry.rings_of(geometry.repaired(open_ring))[1]
    assert len(mended) == 1 and geometry.area_centre(mended)[0] == pytest.approx(4) and geometry.repaired(b"x") is None and geometry.repaired(geometry.wkb_of([[SQUARE * [1, 0]]])) is None
    pixels = spark.createDataFrame([(r, c, 10 * r + c) for r in range(3) for c in range(3)], "r int, c int, u8 int")
    polygons = spark.createDataFrame([(1, geometry.wkb_of([[SQUARE / 2 + 0.5]])), (2, None), (3, geometry.wkb_of([[SQUARE + 50]]))], "k int, geom binary")
    boxes = spark.createDataFrame([(1, 0.5, 0.5, 1.5, 1.5)], "k int, x0 double, y0 double, x1 double, y1 double")
    got = {r.k: (r.ttc, r.shift_error) for r in zonal.polygon_errors(polygons, pixels, "k", 0.5).collect()}
    one = zonal.shift_errors(boxes, pixels, "k", 0.5).first()
    assert got[1] == pytest.approx((one.ttc, one.shift_error)) and got[2] == got[3] == (None, None)


def test_masks_of_odd_sizes_and_false_clouds(spark):
    from tessera.operators import stack

    for h, w in ((3, 4), (4, 3), (5, 5)):
        px = spark.createDataFrame([(1, r, c, float(r * w + c)) for r in range(h) for c in range(w)], "tile int, r int, c int, v double")
        got = {(r.r, r.c): r.v for r in stack.short_wave_doubled(px, "v").collect()}
        assert set(got) == {(r, c) for r in range(2 * h) for c in range(2 * w)}
        if h % 2:
            assert [got[0, c] for c in range(2 - 2 * (w % 2) + 2 * (w % 2), 2 * w)] == [float(c // 2) for c in range(2, 2 * w)]
        if w % 2:
            assert [got[r, 0] for r in range(2 * h)] == [float(r // 2 * w) for r in range(2 * h)]
    assert stack.index_map(8, 11) == [0, *range(8), 7, None] and stack.index_map(8, 9) == [0, *range(8)] and stack.index_map(8, 7) == list(range(1, 8)) and stack.index_map(4, 4) == [0, 1, 2, 3]
    # A textured ground where the far infrared varies most, and a town on half of it.
    rng = np.random.default_rng(1)
    noise = rng.uniform(0.1, 0.3, (16, 16))
    px = scene(spark, lambda i, r, c: [0.2, 0.2, 0.2, 0.25, 0.2, 0.2, noise[r, c], 0.2, 0.4, 0.3], 16, 2)
    ground = spark.createDataFrame([(1, r, c, 5.0 if c < 12 else 50.0, int(c < 4)) for r in range(16) for c in range(16)], "tile int, r int, c int, elevation double, urban int")
    found = clouds.false_positives(px, ground).collect()
    assert {r.c for r in found if r.candidate} == set(range(16)) and all(r.false_cloud == r.candidate for r in found)
    assert {r.c for r in clouds.false_positives(px.withColumn("b8", F.lit(0.1)), ground).collect() if r.candidate} == set(range(10))
    assert not any(r.candidate for r in clouds.false_positives(px, ground, urban=False).collect())
    mosaic = spark.createDataFrame([(1, r, c, *([0.5, 0.2, 0.29] if r < 3 and c < 3 else [0.1 + 0.001 * c] * 3), 1 if r < 8 else 3, r > 25) for r in range(40) for c in range(40)], "tile int, r int, c int, b0 double, b1 double, b2 double, clear int, false_cloud boolean")
    left = clouds.clouds_left(mosaic).collect()
    assert all(r.cloud for r in left if r.r < 3 and r.c < 3) or not any(r.cloud for r in left)
    images = spark.createDataFrame([(1, t, r, 0, float(t == 2 or (t == 3 and r == 0))) for t in range(5) for r in range(10)], "tile int, t int, r int, c int, interp double")
    kept, masks = clouds.pruned(images, lambda p: p)
    assert {r.t for r in kept.collect()} == {0, 1, 3, 4} == {r.t for r in masks.collect()}
    few, _ = clouds.pruned(images.where("t in (0, 1, 2)"), lambda p: p)
    assert {r.t for r in few.collect()} == {0, 1, 2}


def test_runs_are_written_and_updated(spark, sf):
    from tessera.fixtures import view
    from tessera.plans import runs

    jobs = view(spark, sf, "v_jobs")
    at = runs.write_report(jobs, folder(), "20240101")
    summary = spark.read.json(f"{at}/summary").first()
    assert summary.n_jobs == jobs.count() == spark.read.csv(f"{at}/jobs", header=True).count() and summary.step in ("predict", "dem", "s2", "s1_rtc")
    assert spark.read.csv(f"{at}/failed", header=True).count() == summary.n_failed_tiles and spark.read.csv(f"{at}/phase_stats", header=True).count() == 4
    assert "## First failed jobs" in "\n".join(r.value for r in spark.read.text(f"{at}/report").collect())
    at = f"{folder()}/states"
    first = spark.createDataFrame([("a", "s1", "ok", None), ("a", "s2", "failed", "x"), ("b", "s1", "ok", None)], "tile string, step string, status string, detail string")
    runs.write_state(first, at, "r1")
    runs.write_state(first.limit(1), at, "r2")
    runs.update_state(spark, at, "r1", spark.createDataFrame([("a", "s2", "ok", None), ("zz", "s1", "ok", None)], first.schema))
    assert {(r.tile, r.step): (r.status, r.version) for r in runs.load_state(spark, at, "r1").collect()} == {("a", "s1"): ("ok", 1), ("a", "s2"): ("ok", 1), ("b", "s1"): ("ok", 1)}
    assert [(r.run_id, r.version) for r in runs.run_ids(spark, at).collect()] == [("r2", 0), ("r1", 1)] and runs.run_ids(spark, at, 1).count() == 1
    text = runs.availability_text(spark.createDataFrame([(2023, 5, 7, True, False, True)], "year int, x_tile int, y_tile int, dem boolean, s1 boolean, prediction boolean"), "s3://x").first().text.split("\n")
    assert text[0] == "Tile 5X7Y  |  year 2023  |  s3://x" and text[1] == "-" * 48 and text[3].startswith("  s1          MISSING   2023/raw/5/7/raw/s1/") and text[-2:] == ["Raw ARD:    1/2 sources present", "Prediction: present"]


def test_inputs_of_all_kinds(spark, sf):
    from tessera.fixtures import view
    from tessera.plans import inputs

    at = folder()
    grid = spark.createDataFrame([(x, y) for x in range(3) for y in range(3)], "x_tile int, y_tile int")
    polygons = spark.createDataFrame([("u", "p1", "NAME", 10, 10, 210, 20)], "poly_uuid string, project_id string, short_name string, x0 int, y0 int, x1 int, y1 int").withColumn("plantstart", F.to_date(F.lit("2021-05-01")))
    both = {(2020, 0, 0), (2020, 1, 0)}
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(inputs.resolved(spark, grid, "NAME", polygons)) == both == rows(inputs.resolved(spark, grid, polygons=polygons, ids=("u",)))
    for name, text in (("r.csv", "project_id,plantstart_year\np1,2021\n"), ("q.csv", "project_id\np1\n"), ("t.csv", "X,Y,Year,X_tile,Y_tile\n0,0,2020,0,0\n0,0,2020,1,0\n"),
                       ("j.json", '{"p": {"2020": {"missing_tiles": ["0X0Y", "1X0Y", "9X9Y"]}}}')):
        with open(f"{at}/{name}", "w") as f:
            f.write(text)
        assert rows(inputs.resolved(spark, grid, f"{at}/{name}", polygons)) == both
    with open(f"{at}/p.geojson", "w") as f:
        ring = [[0.001, 0.001], [0.06, 0.001], [0.06, 0.002], [0.001, 0.001]]
        json.dump({"features": [{"properties": {"plantstart": "2021-01-01"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}, f)
    assert rows(inputs.resolved(spark, grid, f"{at}/p.geojson")) == both and rows(inputs.resolved(spark, grid, f"{at}/p.geojson", year=1999)) == {(1999, x, y) for _, x, y in both}
    with pytest.raises(ValueError, match="request"):
        inputs.resolved(spark, grid)
    with pytest.raises(ValueError, match="date"):
        tiles.dated(polygons.withColumn("plantstart", F.lit(None).cast("date")))
    found = files.checked_tiles(spark, f"{at}/t.csv", spark.createDataFrame([(2020, 0, 0)], "year int, x_tile int, y_tile int"))
    assert found == {"missing_columns": [], "extra_columns": [], "rows": 2, "existing": 1, "missing": 1}
    assert files.checked_tiles(spark, f"{at}/q.csv")["missing_columns"] == ["X", "X_tile", "Y", "Y_tile", "Year"]
    files.ingest(spark, f"{at}/j.json", grid.withColumns({"lon": F.col("x_tile") / 18, "lat": F.col("y_tile") / 18}), f"{at}/out", 1)
    assert files.tiles_csv(spark, f"{at}/out").count() == 1
    polygons.withColumn("geometry", F.lit(geometry.wkb_of([[SQUARE]]))).write.parquet(f"{at}/polys.parquet")
    shape = files.polygon_table(spark, f"{at}/polys.parquet").first()
    assert (shape.x0, shape.x1, shape.status) == (0.0, 2.0, "ok")
    shapes = spark.createDataFrame([(1, geometry.wkb_of([[SQUARE]])), (2, b"x"), (3, None)], "k int, geom binary")
    assert [r.k for r in files.readable(shapes).collect()] == [1] == [r.k for r in tiles.valid_only(shapes).collect()]
    files.write_results(shapes, f"{at}/results")
    assert spark.read.csv(f"{at}/results", header=True).columns == ["k"]
    info = {r.name: (r.type, r.rows, r.min, r.max) for r in files.described_columns(grid.withColumn("s", F.lit("x"))).collect()}
    assert info == {"x_tile": ("int", 9, 0.0, 2.0), "y_tile": ("int", 9, 0.0, 2.0)}
