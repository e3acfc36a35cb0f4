"""Reports and runs put together from operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import coverage, geometry, inventory, tiles, zonal
from tessera.operators.shared import Saved


def status_report(polygons: DataFrame, grid: DataFrame, objects: DataFrame, sources: tuple[str, ...] = ("s1", "dem"), **filters) -> dict[str, DataFrame]:
    """Scope, coverage, needed tiles and their presence by year, of the polygons that the filters leave."""
    chosen = tiles.filtered(polygons, **filters) if filters else polygons
    needed = tiles.needed_tiles(chosen, grid)
    return {"scope": coverage.scope(chosen), "coverage": coverage.coverage(chosen), "needed": needed, "presence": inventory.by_year(needed, objects, sources)}


def filter_effects(polygons: DataFrame, **filters) -> DataFrame:
    """(condition, value, polygons): how many polygons each value of `tiles.filtered`'s conditions picks by itself, and in the
    last row all of them together. One pass over the polygons; the rows are as many as values were given, for `markdown` to show."""
    tests = [*tiles.single_tests(**filters), ("all conditions", None, tiles.all_tests(**filters))]
    rows = F.array(*[F.struct(F.lit(c).alias("condition"), F.lit(v).cast("string").alias("value"), F.count_if(t).alias("polygons")) for c, v, t in tests])
    return polygons.agg(rows.alias("rows")).select(F.inline("rows"))


def project_run(polygons: DataFrame, grid: DataFrame, objects: DataFrame, sources: tuple[str, ...] = ("s1", "dem"), missing_only: bool = False) -> dict[str, DataFrame]:
    """What a project's run has to do: polygons, tiles, those ready to predict and those to fetch first."""
    chosen = tiles.without_year(polygons) if missing_only else polygons
    needed = tiles.needed_tiles(chosen, grid, only_missing=False)
    ready = inventory.ready(needed, objects, sources)
    return {"polygons": chosen, "tiles": needed, "ready": ready, "fetch": needed.join(ready, ["year", "x_tile", "y_tile"], "left_anti")}


def statistics(boxes: DataFrame, pixels: DataFrame, key: str, details: DataFrame, intervals: DataFrame, regions: DataFrame, shift: float) -> DataFrame:
    """Means and all four errors of sites in one plan: details has key, area, category and the site's centre (x, y).

    regions: place, geom and intervals of the sub-regions; the first that holds the centre counts. Of several rows of
    details that share a key the first by `place` counts where there is such a column, else the least.
    """
    details = zonal.first_of(details, key)
    fields = ("p_lower_95", "p_upper_95", "r_lower_95", "r_upper_95")
    found = zonal.first_region(details.select(key, "x", "y"), regions, key)
    sub = found.select(key, F.when(F.col("place").isNotNull(), F.struct(*fields)).alias("sub"))
    return zonal.with_errors(zonal.shift_errors(boxes, pixels, key, shift).join(details, key).join(sub, key), intervals)


def polygon_statistics(polygons: DataFrame, pixels: DataFrame, intervals: DataFrame, regions: DataFrame, shift: float, key: str = "poly_uuid") -> DataFrame:
    """(key, year, place, part_idx, ttc, area, category, error_plus, error_minus, plus_minus_average) of polygons of all years in one plan.

    polygons: key, year, place (their order), geom (well-known binary in pixels), area, category, and x, y in the
    regions' units (else the geometry's own centre). pixels: year, r, c, u8; regions: place, geom and intervals. Geometries
    that aren't sound are repaired, parts of multipolygons are rows of their own, and each row has its own mean; area
    and category come from the first row of its key, by place. Rows without a year are left out, and so is what can't be
    repaired. Years meet their own rasters by equality, so no year is a run by itself.
    """
    found = geometry.described(polygons.select(F.struct(*polygons.columns).alias("row"), "geom")).where("row.year is not null")
    sound = F.when(F.col("status") == "ok", F.col("geom")).otherwise(geometry.repair(F.col("geom")))
    centre = [F.col("row")[c] if c in polygons.columns else F.col(o) for c, o in (("x", "cx"), ("y", "cy"))]
    rows = geometry.exploded(found.select("row", sound.alias("geom"), centre[0].alias("x"), centre[1].alias("y")))
    feature = F.struct(F.col("row.year").alias("year"), F.col("row")[key].alias("key"), F.col("row.place").alias("place"), "part_idx")
    rows = Saved(polygons.sparkSession, "polygon-statistics").table(rows.select(feature.alias("feature"), "geom", "x", "y"), "rows")
    shifts = [(0.0, 0.0), *((dx * shift, dy * shift) for dx, dy in zonal.SHIFTS)]
    parts = zonal.polygon_parts(rows, "feature", shifts).select("feature", "feature.year", "r", "c", "parts")
    means = zonal.errors_of_means(zonal.means_of_parts(parts, pixels, "feature", len(shifts), on=("year", "r", "c")), "feature")
    fields = ("p_lower_95", "p_upper_95", "r_lower_95", "r_upper_95")
    sub = zonal.first_region(rows.select("feature", "x", "y"), regions, "feature").select("feature", F.when(F.col("place").isNotNull(), F.struct(*fields)).alias("sub"))
    first = zonal.first_of(polygons.select(F.col(key).alias("key"), "place", "area", "category"), "key")
    whole = rows.select("feature", "feature.key").join(means, "feature", "left").join(sub, "feature", "left").join(first, "key")
    out = zonal.with_errors(whole, intervals)
    return out.select(F.col("key").alias(key), "feature.year", "feature.place", "feature.part_idx", "ttc", "area", "category", "error_plus", "error_minus", "plus_minus_average")


def markdown(rows: DataFrame, title: str, limit: int = 200) -> str:
    """A Markdown table of a report's first rows, with the number of those that are left out, if any, below it."""
    head = "| " + " | ".join(rows.columns) + " |\n|" + "-|" * len(rows.columns)
    first = rows.limit(limit + 1).collect()
    body = "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in first[:limit])
    more = f"\n{rows.count() - limit} more rows.\n" if len(first) > limit else ""
    return f"## {title}\n\n{head}\n{body}\n{more}"
