"""Readers and writers of the file formats around a run."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import geometry, tiles
from tessera.schemas import JOB, RUN_SUMMARY, TILES_CSV


def required(df: DataFrame, *columns: str) -> DataFrame:
    if missing := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def tiles_csv(spark: SparkSession, path: str) -> DataFrame:
    """(year, lon, lat, x_tile, y_tile) of a CSV file with the columns Year, X, Y, Y_tile and X_tile in any order."""
    raw = required(spark.read.csv(path, header=True), "Year", "X", "Y", "Y_tile", "X_tile")
    kinds = dict(x.split() for x in TILES_CSV.split(", "))
    names = {"Year": "year", "X": "lon", "Y": "lat", "X_tile": "x_tile", "Y_tile": "y_tile"}
    return raw.select(*[F.col(c).cast(kinds[c]).alias(a) for c, a in names.items()])


def write_tiles_csv(tiles: DataFrame, path: str) -> None:
    tiles.select(F.col("year").alias("Year"), F.col("lon").alias("X"), F.col("lat").alias("Y"), F.col("y_tile").alias("Y_tile"), F.col("x_tile").alias("X_tile")).write.csv(path, header=True)


def failed_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Tiles of the jobs in a JSON array that didn't succeed."""
    jobs = spark.read.schema(JOB).json(path, multiLine=True)
    return jobs.where("tile_info is not null").select("tile_info.year", "tile_info.lon", "tile_info.lat", F.col("tile_info.X_tile").alias("x_tile"), F.col("tile_info.Y_tile").alias("y_tile"))


def grid(spark: SparkSession, parquet: str | None = None, csv: str | None = None) -> DataFrame:
    """The tile grid from Parquet, or from CSV where there is none."""
    for path, read in ((parquet, spark.read.parquet), (csv, lambda p: spark.read.csv(p, header=True, inferSchema=True))):
        if path:
            try:
                found = read(path)
            except Exception as e:  # a path that isn't there: the next one is tried
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                continue
            return found.withColumnsRenamed({"X": "lon", "Y": "lat", "X_tile": "x_tile", "Y_tile": "y_tile"})
    raise FileNotFoundError("neither the Parquet nor the CSV grid is there")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries of all runs below a folder, newest first, those without a start last; what isn't JSON is skipped."""
    found = spark.read.schema(RUN_SUMMARY).json(f"{folder}/*/summary.json", multiLine=True, mode="DROPMALFORMED")
    return found.where("run_id is not null").orderBy(F.desc_nulls_last("start_time"))


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, polygons, geom) of the features of a GeoJSON collection that are a Polygon or a MultiPolygon.

    polygons: an array of polygons, each an array of rings of [lon, lat] pairs; geom: the same as well-known binary.
    Features of other kinds have null for both.
    """
    schema = "features array<struct<properties: map<string, string>, geometry: string>>"
    features = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.properties", F.col("f.geometry").alias("g"))
    rings = "array<array<array<double>>>"
    kind = F.get_json_object("g", "$.type")
    one = F.from_json("g", f"coordinates {rings}")["coordinates"]
    many = F.from_json("g", f"coordinates array<{rings}>")["coordinates"]
    found = features.withColumn("polygons", F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many))
    return found.select("properties", "polygons", geometry.wkb(F.col("polygons")).alias("geom"))


def polygon_table(spark: SparkSession, path: str, geom: str = "geometry") -> DataFrame:
    """A Parquet table of polygons: its geometry column as geom, with the envelope x0, y0, x1, y1 and the status beside it."""
    raw = required(spark.read.parquet(path), geom).drop("x0", "y0", "x1", "y1").withColumnRenamed(geom, "geom")
    return geometry.described(raw).withColumnsRenamed({"w": "x0", "s": "y0", "e": "x1", "n": "y1"})


def readable(polygons: DataFrame, geom: str = "geom") -> DataFrame:
    """polygons whose geometry can be read, is a polygon and isn't empty."""
    bad = ("wkb_parse_error", "empty_geometry", "wrong_geom_type")
    kept = geometry.described(polygons.select(F.struct(*polygons.columns).alias("_row"), F.col(geom).alias("geom")))
    return kept.where(~F.col("status").isin(*bad)).select("_row.*")


def request_csv(spark: SparkSession, path: str) -> DataFrame:
    """(project_id, plantstart_year) of a CSV file of requests; without a column plantstart_year any year is meant (null)."""
    raw = required(spark.read.csv(path, header=True), "project_id")
    year = F.col("plantstart_year").try_cast("double").cast("int") if "plantstart_year" in raw.columns else F.lit(None).cast("int")
    return raw.select("project_id", year.alias("plantstart_year"))


def results_csv(spark: SparkSession, path: str) -> DataFrame:
    """A run's results from CSV, types by their values, poly_uuid as text."""
    raw = required(spark.read.csv(path, header=True, inferSchema=True), "poly_uuid")
    return raw.withColumn("poly_uuid", F.col("poly_uuid").cast("string"))


def write_results(results: DataFrame, path: str, geom: str = "geom") -> None:
    """Results as CSV with a header, without their geometry."""
    results.drop(geom).write.csv(path, header=True)


def ingest(spark: SparkSession, request: str, grid_tiles: DataFrame, path: str, limit: int | None = None) -> None:
    """The tiles that a JSON request names and the grid has, the first `limit` by year and place, as a CSV file of tiles."""
    text = spark.read.text(request, wholetext=True).withColumnRenamed("value", "document")
    found = tiles.on_grid(tiles.decoded(tiles.request_tiles(text)).where("x_tile is not null"), grid_tiles)
    if limit is not None:
        found = found.orderBy("year", "x_tile", "y_tile").limit(limit)
    write_tiles_csv(found, path)


def checked_tiles(spark: SparkSession, path: str, present: DataFrame | None = None) -> dict:
    """What a CSV file of tiles lacks, has too much of and holds: missing_columns, extra_columns, rows and, with present
    (year, x_tile, y_tile of what exists), existing and missing."""
    names = {"Year", "X", "Y", "Y_tile", "X_tile"}
    columns = set(spark.read.csv(path, header=True).columns)
    out = {"missing_columns": sorted(names - columns), "extra_columns": sorted(columns - names)}
    if out["missing_columns"]:
        return out
    rows = tiles_csv(spark, path)
    out["rows"] = rows.count()
    if present is not None:
        key = ["year", "x_tile", "y_tile"]
        out["existing"] = rows.join(present.select(*key).distinct(), key, "left_semi").count()
        out["missing"] = out["rows"] - out["existing"]
    return out


def described_columns(df: DataFrame) -> DataFrame:
    """(name, type, rows, min, max) of the columns of numbers."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.dataType.simpleString() in ("tinyint", "smallint", "int", "bigint", "float", "double")}
    ends = df.agg(F.count("*").alias("rows"), *[f(c).cast("double").alias(f"{n}_{c}") for c in kinds for n, f in (("min", F.min), ("max", F.max))])
    each = [F.struct(F.lit(c).alias("name"), F.lit(k).alias("type"), "rows", F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max")) for c, k in kinds.items()]
    return ends.select(F.inline(F.array(*each)))


def kind_of(path: str, header: list[str] | None = None) -> str:
    """What a request file is, by its ending and, for CSV, its header; what isn't a file is a short name."""
    ending = os.path.splitext(path)[1].lower()
    if ending == ".csv":
        return "tiles_csv" if {"Year", "X_tile", "Y_tile"} <= set(header or []) else "request_csv"
    if ending in (".geojson", ".gpkg", ".shp", ".parquet"):
        return "polygon_file"
    return "json_request" if ending == ".json" else "short_name"


def stac_items(tiles: DataFrame) -> DataFrame:
    """A JSON item for each prediction: its box, ring, year and raster."""
    from tessera.functions.scalars import prediction_key, ring, tile_box, tile_tag

    box = tile_box(F.col("lon"), F.col("lat"))
    w, s, e, n = (box[x] for x in ("w", "s", "e", "n"))
    c = [F.col(x) for x in ("year", "x_tile", "y_tile")]
    item = F.struct(
        F.lit("Feature").alias("type"), F.concat_ws("_", tile_tag(c[1], c[2]), F.col("year").cast("string")).alias("id"), F.array(w, s, e, n).alias("bbox"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring(box)).alias("coordinates")).alias("geometry"), F.struct(F.col("year").alias("year")).alias("properties"),
        F.struct(F.struct(prediction_key(*c).alias("href")).alias("prediction")).alias("assets"),
    )
    return tiles.select("year", "x_tile", "y_tile", F.to_json(item).alias("item"))
