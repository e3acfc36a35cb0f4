"""Elevation: filters with mirrored edges, slopes and aspects, as windows along rows and columns (tile, r, c, value)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .raster import along

#: Metres in a degree of latitude, slopes (degrees) below which others than 0 become it.
METRES_PER_DEGREE, LEAST_SLOPE = 111320.0, 0.02


def mirrored(pixels: DataFrame, n: int, tile: str = "tile") -> DataFrame:
    """pixels with copies of the n lines next to each edge beyond it, as a mirror there shows them; `own` marks the others.

    What a window over n lines on either side needs is then all there. Rasters have at least n rows and columns.
    """
    size = pixels.groupBy(tile).agg((F.max("r") + 1).alias("_h"), (F.max("c") + 1).alias("_w"))

    def places(at: str, size: str) -> Column:
        x, last = F.col(at), 2 * F.col(size) - 1 - F.col(at)
        return F.filter(F.array(x, F.when(x < n, -1 - x), F.when(x >= F.col(size) - n, last)), lambda p: p.isNotNull())

    spread = pixels.join(size, tile).withColumn("_r", F.explode(places("r", "_h"))).withColumn("_c", F.explode(places("c", "_w")))
    own = (F.col("_r") == F.col("r")) & (F.col("_c") == F.col("c"))
    return spread.withColumn("own", own).drop("r", "c", "_h", "_w").withColumnsRenamed({"_r": "r", "_c": "c"})


def own_of(extended: DataFrame) -> DataFrame:
    return extended.where("own").drop("own")


def median_filtered(pixels: DataFrame, value: str, n: int = 2, tile: str = "tile") -> DataFrame:
    """The median of the (2 n + 1) squared pixels around each, edges mirrored; a list holds one window's values."""
    down, across = along(tile)
    line = mirrored(pixels, n, tile).withColumn("_line", F.collect_list(value).over(across.rowsBetween(-n, n)))
    whole = line.withColumn("_all", F.array_sort(F.flatten(F.collect_list("_line").over(down.rowsBetween(-n, n)))))
    return own_of(whole).withColumn(value, F.get("_all", F.lit(2 * n * (n + 1)))).drop("_line", "_all")


def smoothed(pixels: DataFrame, value: str, sigma: float = 0.5, truncate: float = 3.0, tile: str = "tile") -> DataFrame:
    """A Gaussian filter, cut off at `truncate` sigmas, edges mirrored: weighted sums along rows, then columns."""
    n = int(truncate * sigma + 0.5)
    raw = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-n, n + 1)]
    weights = [x / sum(raw) for x in raw]

    def line(c: str, w: W) -> Column:
        near = [F.lag(c, -i).over(w) if i < 0 else F.lead(c, i).over(w) if i else F.col(c) for i in range(-n, n + 1)]
        return sum((x * k for x, k in zip(near[1:], weights[1:], strict=True)), F.lag(c, n).over(w) * weights[0])

    down, across = along(tile)
    return own_of(mirrored(pixels, n, tile).withColumn("_line", line(value, across)).withColumn(value, line("_line", down))).drop("_line")


def local_variance(pixels: DataFrame, value: str, out: str, n: int = 3, tile: str = "tile") -> DataFrame:
    """The variance over the (2 n + 1) squared pixels around each, edges mirrored: mean of squares less the squared mean."""
    down, across = along(tile)
    near = lambda c, w: F.sum(c).over(w.rowsBetween(-n, n))
    extended = mirrored(pixels, n, tile).withColumn("_q", F.col(value) * F.col(value))
    lines = extended.withColumns({"_s1": near(value, across), "_s2": near("_q", across)})
    count = float((2 * n + 1) ** 2)
    both = lines.withColumns({"_m1": near("_s1", down) / count, "_m2": near("_s2", down) / count})
    return own_of(both).withColumn(out, F.col("_m2") - F.col("_m1") * F.col("_m1")).drop("_q", "_s1", "_s2", "_m1", "_m2")


def steepness(dx: Column, dy: Column) -> Column:
    """Degrees between the horizontal and a plane with these gradients."""
    return F.degrees(F.acos(1 / F.sqrt(1 + dx * dx + dy * dy)))


def normal_slopes(dem: DataFrame, value: str, width: float, height: float, floor: float | None = LEAST_SLOPE, tile: str = "tile") -> DataFrame:
    """dem with `slope` (degrees) from the four neighbours of each pixel, 0 at the raster's edge.

    width and height: a pixel's size in the unit of the elevation. Slopes above 0 and below floor become floor.
    """
    down, across = along(tile)
    rise = lambda w, size: (F.lead(value).over(w) - F.lag(value).over(w)) / (2 * size)
    steep = dem.withColumns({"_x": rise(across, width), "_y": rise(down, height)}).withColumn("slope", F.coalesce(steepness(F.col("_x"), F.col("_y")), F.lit(0.0)))
    if floor is not None:
        steep = steep.withColumn("slope", F.when((F.col("slope") > 0) & (F.col("slope") < floor), floor).otherwise(F.col("slope")))
    return steep.drop("_x", "_y")


def plane_slopes(dem: DataFrame, value: str, width: float, height: float, n: int = 1, tile: str = "tile") -> DataFrame:
    """dem with `slope` (degrees) of the plane fitted by least squares to the (2 n + 1) squared pixels around each.

    On a regular grid the fit's gradients are weighted sums: along one axis by distance, along the other plain. Null
    where the window isn't whole.
    """
    down, across = along(tile)
    count = (2 * n + 1) * sum(i * i for i in range(-n, n + 1))
    by_distance = lambda c, w: sum((i * (F.lead(c, i).over(w) - F.lag(c, i).over(w)) for i in range(2, n + 1)), F.lead(c, 1).over(w) - F.lag(c, 1).over(w))
    plain = lambda c, w: sum((F.lead(c, i).over(w) + F.lag(c, i).over(w) for i in range(1, n + 1)), F.col(c))
    first = dem.withColumns({"_dx": by_distance(value, across), "_sum": plain(value, across)})
    both = first.withColumns({"_x": plain("_dx", down) / (count * width), "_y": by_distance("_sum", down) / (count * height)})
    return both.withColumn("slope", steepness(F.col("_x"), F.col("_y"))).drop("_dx", "_sum", "_x", "_y")


def metre_spacing(pixel_degrees: float, centre_latitude: float) -> tuple[float, float]:
    """Width and height in metres of a pixel given in degrees."""
    return pixel_degrees * METRES_PER_DEGREE * math.cos(math.radians(centre_latitude)), pixel_degrees * METRES_PER_DEGREE


def slope_and_aspect(dem: DataFrame, value: str, width: float, height: float, tile: str = "tile") -> DataFrame:
    """dem with `slope` and `aspect` in radians, from central differences (one-sided at the edges).

    The aspect is 0 where the ground falls towards the first row and grows clockwise.
    """

    def gradient(w: W, size: float) -> Column:
        before, own, after = F.lag(value).over(w), F.col(value), F.lead(value).over(w)
        return (F.coalesce(after, own) - F.coalesce(before, own)) / F.when(before.isNull() | after.isNull(), size).otherwise(2 * size)

    down, across = along(tile)
    steep = dem.withColumns({"_y": gradient(down, height), "_x": gradient(across, width)})
    turned = F.atan2(-F.col("_x"), F.col("_y"))
    aspect = F.when(turned < 0, turned + 2 * math.pi).otherwise(turned)
    return steep.withColumns({"slope": F.atan(F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y"))), "aspect": aspect}).drop("_x", "_y")
