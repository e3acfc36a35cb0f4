"""Area-weighted statistics of polygons over rasters, and their errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import buffered

from . import geometry, overlay
from .raster import NODATA

#: Least part of a pixel that counts, eight directions of shift, limit of a small site in hectares.
LEAST_PART, SHIFTS, SMALL_SITE = 0.05, [(1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (1, -1), (-1, 1), (-1, -1)], 0.5
#: Land cover codes of each category; all others are forest.
LAND_COVER = {
    "urban": [190],
    "grassland": [130],
    "cropland": [10, 11, 12, 20],
    "forest": [50, 60, 61, 62, 70, 71, 80, 81, 82, 90, 160, 170],
    "mosaic vegetation": [30, 40, 100, 110],
    "shrub/scrub/otherland": [120, 121, 122, 140, 150, 151, 152, 153, 200, 201, 202, 0, 220],
}


def overlap(low: Column, high: Column, cell: Column) -> Column:
    """The part of the unit interval from `cell` that an interval covers."""
    return F.greatest(F.least(high, cell + 1) - F.greatest(low, cell), F.lit(0.0))


def pixel_parts(boxes: DataFrame) -> DataFrame:
    """boxes (x0, y0, x1, y1 in pixels) spread over the pixels (r, c) that they meet, with the part covered."""
    cells = lambda a, b: F.explode(F.sequence(F.floor(a).cast("int"), F.greatest(F.ceil(b).cast("int") - 1, F.floor(a).cast("int"))))
    spread = boxes.select("*", cells("x0", "x1").alias("c")).select("*", cells("y0", "y1").alias("r"))
    return spread.withColumn("part", overlap(F.col("x0"), F.col("x1"), F.col("c")) * overlap(F.col("y0"), F.col("y1"), F.col("r")))


def moved_part(i: tuple[float, float]) -> Column:
    """The part of a pixel (r, c) that a box (x0, y0, x1, y1) covers when moved by i."""
    dx, dy = i
    return overlap(F.col("x0") + dx, F.col("x1") + dx, F.col("c")) * overlap(F.col("y0") + dy, F.col("y1") + dy, F.col("r"))


def moved_pixels(boxes: DataFrame, shifts: list[tuple[float, float]]) -> DataFrame:
    """boxes spread once over all pixels (r, c) that they meet in place or moved by one of shifts; all columns stay."""
    reach_x, reach_y = max(abs(dx) for dx, _ in shifts), max(abs(dy) for _, dy in shifts)
    cells = lambda a, b, by: F.explode(F.sequence(F.floor(F.col(a) - by).cast("int"), F.greatest(F.ceil(F.col(b) + by).cast("int") - 1, F.floor(F.col(a) - by).cast("int"))))
    return boxes.select("*", cells("x0", "x1", reach_x).alias("c")).select("*", cells("y0", "y1", reach_y).alias("r"))


#: Polygons are laid over windows of so many pixels on a side.
WINDOW = 64


def polygon_parts(polygons: DataFrame, key: str, shifts: list[tuple[float, float]], geom: str = "geom") -> DataFrame:
    """(key, r, c, parts) for polygons (key, well-known binary in pixels): the part of each pixel, in place and
    moved, by exact coverage; pixels that no moved polygon covers to LEAST_PART are left out.

    A polygon's envelope is cut into windows of WINDOW x WINDOW pixels, so a task holds a window and not a polygon's raster.
    """
    reach_x, reach_y = max(abs(dx) for dx, _ in shifts), max(abs(dy) for _, dy in shifts)
    boxed = polygons.select(key, F.col(geom).alias("geom"), geometry.envelope(F.col(geom)).alias("_e")).where("_e.w is not null").select(key, "geom", "_e.*")
    cells = lambda a, b, by: F.explode(F.sequence(F.floor((F.col(a) - by) / WINDOW).cast("int"), F.floor((F.col(b) + by) / WINDOW).cast("int")))
    spread = boxed.select(key, "geom", "s", "n", cells("w", "e", reach_x).alias("_i")).select(key, "geom", "_i", cells("s", "n", reach_y).alias("_j"))
    found = geometry.pixel_coverage(F.col("geom"), F.col("_i") * WINDOW, F.col("_j") * WINDOW, shifts, WINDOW, WINDOW)
    return spread.select(key, F.inline(found)).where(F.array_max("parts") >= LEAST_PART)


def means_of_parts(parts: DataFrame, pixels: DataFrame, key: str, n: int, value: str = "u8", on: tuple[str, ...] = ("r", "c")) -> DataFrame:
    """(key, means): the n means of value weighted by each of `parts` that is LEAST_PART or more, without NODATA.

    Pixels meet parts by the columns `on`. A key without any pixel that counts has no row; a mean without one is null.
    """
    return weighted_means(parts.join(pixels.where(F.col(value) != NODATA), list(on)), key, [F.get("parts", F.lit(i)) for i in range(n)], value)


def weighted_means(data: DataFrame, key: str, parts: list[Column], value: str) -> DataFrame:
    weights = [F.when(p >= LEAST_PART, p) for p in parts]
    return data.groupBy(key).agg(F.array(*[F.try_divide(F.sum(F.col(value) * w), F.sum(w)) for w in weights]).alias("means"))


def zonal_means(boxes: DataFrame, pixels: DataFrame, keys: list[str], value: str = "u8") -> DataFrame:
    """(keys, ttc): means weighted by covered parts of LEAST_PART or more, without NODATA; null where none counts."""
    data = pixel_parts(boxes).join(pixels.where(F.col(value) != NODATA), ["r", "c"], "left")
    weight = F.when(F.col(value).isNotNull() & (F.col("part") >= LEAST_PART), F.col("part"))
    return data.groupBy(*keys).agg(F.try_divide(F.sum(F.col(value) * weight), F.sum(weight)).alias("ttc"))


def errors_of_means(means: DataFrame, key: str) -> DataFrame:
    """(key, ttc, shift_error) from the means in place and moved: the root of the mean square of the relative changes.

    Directions without a value are left out of the sum but count among the 8; a mean of 0 has no error.
    """
    ttc = F.get("means", F.lit(0))
    square = F.aggregate(F.slice("means", 2, len(SHIFTS)), F.lit(0.0), lambda s, x: s + F.coalesce(F.pow(F.try_divide(x - ttc, ttc), 2), F.lit(0.0)))
    return means.select(key, ttc.alias("ttc"), F.when(ttc == 0, 0.0).when(ttc.isNotNull(), F.sqrt(square / len(SHIFTS))).alias("shift_error"))


def shift_errors(boxes: DataFrame, pixels: DataFrame, key: str, by: float) -> DataFrame:
    """(key, ttc, shift_error) of boxes (x0, y0, x1, y1 in pixels): their mean, and how it changes moved in 8 directions.

    A box is spread over the pixels once; its four sides go along, and the nine parts of a pixel follow from them where it
    has met its value. Boxes without any pixel that counts have nulls.
    """
    shifts = [(0.0, 0.0), *((dx * by, dy * by) for dx, dy in SHIFTS)]
    data = moved_pixels(boxes.select(key, "x0", "y0", "x1", "y1"), shifts).join(pixels.where(F.col("u8") != NODATA), ["r", "c"])
    means = weighted_means(data, key, [moved_part(i) for i in shifts], "u8")
    return boxes.select(key).distinct().join(errors_of_means(means, key), key, "left")


def polygon_errors(polygons: DataFrame, pixels: DataFrame, key: str, by: float, geom: str = "geom") -> DataFrame:
    """As `shift_errors`, for polygons (key, well-known binary in pixels)."""
    parts = polygon_parts(polygons, key, [(0.0, 0.0), *((dx * by, dy * by) for dx, dy in SHIFTS)], geom)
    return polygons.select(key).distinct().join(errors_of_means(means_of_parts(parts, pixels, key, 1 + len(SHIFTS)), key), key, "left")


def small_site_error(area: Column, ttc: Column) -> Column:
    """Relative error of sites up to SMALL_SITE hectares: a fixed value for each bracket, over the mean.

    Means often are whole numbers, from which sums of parts leave them a hair off: brackets go by seven decimals.
    """
    mean = F.round(ttc, 7)
    raw = F.when(mean <= 10, 3.6386).when(mean <= 40, 16.68).when(mean <= 100, 23.468).otherwise(0.0)
    return F.when((ttc == 0) | (area > SMALL_SITE), 0.0).otherwise(F.try_divide(raw, ttc))


def interval_error(high: Column, low: Column, ttc: Column) -> Column:
    return F.when(ttc == 0, 0.0).otherwise(F.try_divide(high - low, ttc))


def combined(ttc: Column, shift: Column, small: Column, lower: list[Column], upper: list[Column]) -> Column:
    """struct(error_plus, error_minus, plus_minus_average): relative errors added in quadrature, shift and site halved."""
    square = lambda c: c * c
    common = square(shift / 2) + square(small / 2)
    minus = ttc * F.sqrt(sum((square(c) for c in lower), common))
    plus = ttc * F.sqrt(sum((square(c) for c in upper), common))
    return F.struct(plus.alias("error_plus"), minus.alias("error_minus"), ((plus + minus) / 2).alias("plus_minus_average"))


def no_infinity(x: Column) -> Column:
    return F.when(F.abs(x) == float("inf"), 0.0).otherwise(x)


def land_category(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, codes in LAND_COVER.items():
        out = F.when(code.isin(*codes), name).otherwise(out)
    return F.coalesce(out, F.lit("forest"))


def majority(pixels: DataFrame, key: str, code: str) -> DataFrame:
    """The most frequent class but NODATA of each key; of several the least code."""
    n = pixels.where(F.col(code) != NODATA).groupBy(key, code).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.max(F.struct("n", (-F.col(code)).alias("m"))).alias("x")).select(key, (-F.col("x.m")).alias(code), F.col("x.n").alias("n"))


def first_of(table: DataFrame, key: str) -> DataFrame:
    """One row for each key of a table of intervals: the first by `place` where it has that column, else the least."""
    rest = [c for c in table.columns if c not in (key, "place")]
    order = ["place"] if "place" in table.columns else []
    return table.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("x")).select(key, *[F.col(f"x.{c}") for c in rest])


def with_errors(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """rows (ttc, area, shift_error, category, and sub: a struct of an interval or null) with their errors.

    intervals: category, p_lower_95, p_upper_95, r_lower_95, r_upper_95; a category that it lacks (case aside) is
    taken as forest, of several rows of one the first counts. Without a column `sub`, or where it is null, the
    sub-region adds nothing. Rows without a mean have no errors.
    """
    fields = ("p_lower_95", "p_upper_95", "r_lower_95", "r_upper_95")
    own = first_of(intervals.select(F.lower("category").alias("_category"), *fields, *(["place"] if "place" in intervals.columns else [])), "_category")
    table = own.select("_category", F.struct(*fields).alias("_own"))
    known = table.select(F.col("_category").alias("_known"))
    named = rows.join(known, F.lower("category") == F.col("_known"), "left").withColumn("_category", F.coalesce("_known", F.lit("forest"))).drop("_known")
    ttc = F.col("ttc")
    lower = lambda c: interval_error(F.col(f"{c}.p_upper_95"), F.col(f"{c}.r_lower_95"), ttc)
    upper = lambda c: interval_error(F.col(f"{c}.r_upper_95"), F.col(f"{c}.p_lower_95"), ttc)
    sub = "sub" in rows.columns
    none = F.when(ttc.isNotNull(), 0.0)
    lowers, uppers = ([f("_own"), *([F.coalesce(f("sub"), none)] if sub else [])] for f in (lower, upper))
    errors = combined(ttc, F.col("shift_error"), small_site_error(F.col("area"), ttc), lowers, uppers)
    return named.join(table, "_category", "left").withColumn("errors", errors).select(*[c for c in rows.columns if c != "sub"], "errors.*")


#: Points and regions meet by squares of so many units on a side.
CELL = 500.0


def first_region(points: DataFrame, regions: DataFrame, key: str, cell: float = CELL) -> DataFrame:
    """(key, and regions' columns but geom): the first region (by place) that holds a point (key, x, y); nulls without one.

    regions: place, geom (polygons as well-known binary) and any other columns. A region is spread over the squares that
    it has a part of: squares inside carry its key alone, those on its edge also the piece of it in them, against which
    the points there are tested. So the join is by equality of squares, and what it shuffles grows with regions' edges.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    rest = [c for c in regions.columns if c != "geom"]
    spread = regions.select(F.struct(*rest).alias("found"), F.inline(geometry.cell_pieces(F.col("geom"), cell)))
    met = points.select(key, "x", "y", at("x").alias("i"), at("y").alias("j")).join(spread, ["i", "j"])
    inside = met.where(F.col("piece").isNull() | geometry.within(F.col("piece"), F.col("x"), F.col("y"))).groupBy(key).agg(F.min("found").alias("found"))
    return points.select(key).distinct().join(inside, key, "left").select(key, *[F.col(f"found.{c}").alias(c) for c in rest])


def sub_regions(countries: DataFrame, intervals: DataFrame, cell: float | None = None) -> DataFrame:
    """Regions for `first_region`: a row for each country (subregion, geom) whose sub-region has an interval (category and the
    four bounds), or with `cell` a row for each sub-region, its countries merged square by square of that side. place is the
    order of names."""
    fields = ("p_lower_95", "p_upper_95", "r_lower_95", "r_upper_95")
    named = countries.join(intervals.select(F.col("category").alias("subregion"), *fields), "subregion")
    if cell:
        whole = overlay.dissolved(named, "subregion", cell).drop("area")
        named = whole.join(named.select("subregion", *fields).distinct(), "subregion")
    return named.select(F.col("subregion").alias("place"), F.col("subregion").alias("region"), "geom", *fields)


def within_bounds(pixels: DataFrame, boxes: DataFrame, metres: float = 500.0) -> DataFrame:
    """Pixels (lon, lat) within the bounds of all boxes (w, s, e, n) after each has grown by metres on all sides."""
    grown = boxes.select(buffered(F.struct("w", "s", "e", "n"), metres).alias("b"))
    whole = grown.agg(F.min("b.w").alias("_w"), F.min("b.s").alias("_s"), F.max("b.e").alias("_e"), F.max("b.n").alias("_n"))
    near = pixels.join(F.broadcast(whole))  # one row
    return near.where("lon >= _w and lon <= _e and lat >= _s and lat <= _n").select(*pixels.columns)


def interval_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of confidence intervals from a CSV file with a header."""
    return spark.read.csv(path, header=True, inferSchema=True)
