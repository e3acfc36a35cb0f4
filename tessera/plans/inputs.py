"""Any kind of request to the tiles that it means."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import tiles
from tessera.sources import files


def of_polygons(polygons: DataFrame, grid: DataFrame, year: int | None = None) -> DataFrame:
    """(year, x_tile, y_tile) of the tiles that polygons meet, in the given year or each polygon's own (before planting)."""
    dated = polygons.withColumn("year", F.lit(year).cast("int")) if year is not None else tiles.dated(polygons)
    join = tiles.polygons_on_grid if "geom" in polygons.columns else tiles.boxes_on_grid
    return join(dated, grid).select("year", "x_tile", "y_tile").distinct()


def resolved(spark: SparkSession, grid: DataFrame, request: str | None = None, polygons: DataFrame | None = None, year: int | None = None, **filters) -> DataFrame:
    """(year, x_tile, y_tile) of a request: conditions on polygons, else a path by its kind, else a project's short name.

    A CSV file of tiles and a JSON request name tiles themselves; a CSV file of requests, a file of polygons (GeoJSON or
    Parquet; years as given, or from a column plantstart) and a short name go by the polygons' places.
    """
    if filters:
        return of_polygons(tiles.filtered(polygons, **filters), grid, year)
    if request is None:
        raise ValueError("give a request or a condition on polygons")
    header = spark.read.csv(request, header=True).columns if request.lower().endswith(".csv") else None
    kind = files.kind_of(request, header)
    if kind == "tiles_csv":
        return files.tiles_csv(spark, request).select("year", "x_tile", "y_tile").distinct()
    if kind == "json_request":
        text = spark.read.text(request, wholetext=True).withColumnRenamed("value", "document")
        return tiles.on_grid(tiles.decoded(tiles.request_tiles(text)), grid).select("year", "x_tile", "y_tile").distinct()
    if kind == "request_csv":
        return of_polygons(tiles.requested_any_year(polygons, files.request_csv(spark, request)), grid, year)
    if kind == "polygon_file":
        if request.lower().endswith(".geojson"):
            raw = files.geojson(spark, request).select("geom", F.to_date(F.try_element_at("properties", F.lit("plantstart"))).alias("plantstart"))
        elif request.lower().endswith(".parquet"):
            raw = spark.read.parquet(request)
        else:
            raise ValueError(f"no reader for {request}")
        boxed = files.geometry.described(files.readable(raw)).withColumnsRenamed({"w": "x0", "s": "y0", "e": "x1", "n": "y1"})
        units = {c: F.col(c) * 3600 for c in ("x0", "y0", "x1", "y1")}
        return of_degrees(boxed, units, grid, year)
    return of_polygons(tiles.filtered(polygons, short_names=(request,)), grid, year)


def of_degrees(boxed: DataFrame, units: dict, grid: DataFrame, year: int | None) -> DataFrame:
    """`of_polygons` for geometries in degrees: envelopes find the cells in the grid's units, polygons are tested in degrees."""
    dated = boxed.withColumn("year", F.lit(year).cast("int")) if year is not None else tiles.dated(boxed)
    near = tiles.boxes_on_grid(dated.withColumns(units), grid)
    side = tiles.SIDE / 3600
    w, s = F.col("x_tile") * side, F.col("y_tile") * side
    return near.where(files.geometry.meets(F.col("geom"), w, s, w + side, s + side)).select("year", "x_tile", "y_tile").distinct()
