"""Rasters as relations of pixels (tile, r, c, value): separable windows, mosaics, blends, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import percentiles

#: No data, and the limits below which the mosaic's pixels become 0.
NODATA, LEAST_MAX, LEAST_VALUE = 255, 30, 20
#: A difference that clouds make, and the least number of other pixels for a correlation.
FAR, LEAST_CLOSE = 30, 100


def along(tile: str, row: str = "r", col: str = "c") -> tuple[W, W]:
    """Windows down a column and along a row of a raster; a task holds a line of pixels, never the raster."""
    return W.partitionBy(tile, col).orderBy(row), W.partitionBy(tile, row).orderBy(col)


def both_ways(*image: str, row: str = "r", col: str = "c") -> tuple[W, W, W, W]:
    """Windows down and up a column, along and back a row of an image."""
    lines = (W.partitionBy(*image, col), row), (W.partitionBy(*image, row), col)
    return tuple(w.orderBy(order) for w, at in lines for order in (F.col(at), F.desc(at)))


def window_extreme(pixels: DataFrame, n: int, value: str, out: str, tile: str = "tile", least: bool = False, after: int | None = None) -> DataFrame:
    """The greatest (or least) value within n rows and columns before to `after` (else n) behind: one pass down, one across. All
    pixels must be there."""
    f, to = F.min if least else F.max, n if after is None else after
    down, across = along(tile)
    first = pixels.withColumn("_part", f(value).over(down.rowsBetween(-n, to)))
    return first.withColumn(out, f("_part").over(across.rowsBetween(-n, to))).drop("_part")


def closed(pixels: DataFrame, n: int, value: str, out: str, tile: str = "tile") -> DataFrame:
    """Grey closing with a square of 2 n + 1: the window's greatest value, then the least of these."""
    return window_extreme(window_extreme(pixels, n, value, "_top", tile), n, "_top", out, tile, least=True).drop("_top")


def window_sum(pixels: DataFrame, value: str, out: str, tile: str = "tile") -> DataFrame:
    """The sum over 3 x 3 pixels; beyond an edge, the line next to it counts again (the edge mirrors)."""

    def line(w: W, c: Column) -> Column:
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        return c + F.coalesce(before, after, F.lit(0)) + F.coalesce(after, before, F.lit(0))

    down, across = along(tile)
    return pixels.withColumn("_part", line(down, F.col(value))).withColumn(out, line(across, F.col("_part"))).drop("_part")


def cross_distance(pixels: DataFrame, flag: str, out: str, tile: str = "tile") -> DataFrame:
    """Steps (not diagonal) from each pixel to the nearest flagged one of its raster, null without any.

    Down a column the nearest flagged pixel on either side, then along a row the least of that plus the steps to it, each
    from both ends of the line, as a window up to what follows would be reckoned anew at each pixel: no pixel is copied.
    """
    down, up, across, back = (w.rangeBetween(W.unboundedPreceding, 0) for w in both_ways(tile))
    at = F.when(F.col(flag), F.col("r"))
    column = pixels.withColumn("_d", F.least(F.col("r") - F.max(at).over(down), F.min(at).over(up) - F.col("r")))
    left, right = F.min(F.col("_d") - F.col("c")).over(across), F.min(F.col("_d") + F.col("c")).over(back)
    return column.withColumn(out, F.least(left + F.col("c"), right - F.col("c"))).drop("_d")


def cross_dilated(pixels: DataFrame, flag: str, n: int, tile: str = "tile") -> DataFrame:
    """pixels with `dilated`: whether a flagged one is within n steps (not diagonal)."""
    return cross_distance(pixels, flag, "_steps", tile).withColumn("dilated", F.coalesce(F.col("_steps") <= n, F.lit(False))).drop("_steps")


def mosaic(pixels: DataFrame, order: str, value: str = "u8") -> DataFrame:
    """One value for each (r, c): of tiles that overlap, the first in order that has data; else NODATA."""
    first = F.min(F.when(F.col(value) != NODATA, F.struct(order, value))).getField(value)
    return pixels.groupBy("r", "c").agg(F.coalesce(first, F.lit(NODATA)).alias(value))


def denoised(pixels: DataFrame, value: str = "u8", tile: str = "tile") -> DataFrame:
    """Pixels whose 3 x 3 neighbourhood stays under LEAST_MAX become 0, and so do those under LEAST_VALUE.

    NODATA is a value like others here: it stays, and lifts its neighbours' maximum.
    """
    seen = window_extreme(pixels, 1, value, "_max", tile)
    return seen.withColumn(value, F.when((F.col("_max") < LEAST_MAX) | (F.col(value) < LEAST_VALUE), 0).otherwise(F.col(value))).drop("_max")


def block_means(pixels: DataFrame, side: int, value: str, tile: str = "tile") -> DataFrame:
    at = lambda c: F.floor(F.col(c) / side).cast("int").alias(f"b{c}")
    return pixels.groupBy(tile, at("r"), at("c")).agg(F.avg(value).alias("mean"))


def bad_blocks(pixels: DataFrame, side: int, value: str, share: float = 0.25, tile: str = "tile") -> DataFrame:
    """Blocks of side x side pixels with `bad`: whether more than a share of them have no data."""
    at = lambda c: F.floor(F.col(c) / side).cast("int").alias(f"b{c}")
    return pixels.groupBy(tile, at("r"), at("c")).agg((F.count_if(F.col(value) == NODATA) > share * F.count("*")).alias("bad"))


def gauss(size: int, sigma: float, i: Column, j: Column) -> Column:
    """The value of a size x size Gaussian kernel, not normalised, at row i and column j."""
    middle = (size - 1) / 2
    return F.exp(-((i - middle) * (i - middle) + (j - middle) * (j - middle)) / (2.0 * sigma * sigma))


def windows(height: int, width: int, size: int, step: int, spark: SparkSession) -> DataFrame:
    """(w, r0, c0): windows of size x size at every step, the last ones moved in so that they fit."""
    at = lambda n: F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(max(0, n - 1)), F.lit(step)), lambda x: F.least(x, F.lit(max(0, n - size)))))
    rows = spark.range(1).select(F.explode(at(height)).alias("r0")).select("r0", F.explode(at(width)).alias("c0"))
    return rows.select(F.concat_ws("_", "r0", "c0").alias("w"), "r0", "c0")


def agreement(predictions: DataFrame, window: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """(keys, window, multiplier): the median disagreement of a scene's windows over a window's own, at most 1.5.

    A window's disagreement is the mean absolute difference of its values from the mean of the other windows' at
    the same pixels. Sums by pixel give the others' mean, so no window meets each other. keys name the scene, if
    there are several.
    """
    keys = keys or []
    pixel = W.partitionBy(*keys, "r", "c")
    others = F.try_divide(F.sum(value).over(pixel) - F.col(value), F.count(value).over(pixel) - 1)
    off = predictions.withColumn("_off", F.abs(others - F.col(value))).groupBy(*keys, window).agg(F.avg("_off").alias("ratio"))
    middle = off.groupBy(*keys).agg(F.median("ratio").alias("middle"), F.min("ratio").alias("least"))
    usable = (F.col("least") > 0) & F.col("ratio").isNotNull()
    both = off.join(middle, keys) if keys else off.crossJoin(F.broadcast(middle))
    return both.select(*keys, window, F.when(usable, F.least(F.col("middle") / F.col("ratio"), F.lit(1.5))).otherwise(1.0).alias("multiplier"))


def blended(predictions: DataFrame, weight: Column, value: str, keys: list[str]) -> DataFrame:
    """The weighted mean in per cent of predictions from 0 to 1 (greater ones are no data), whole and cut off.

    15 or less becomes 0, over 100 or without any weight NODATA.
    """
    w = F.when(F.col(value) <= 1, weight).otherwise(0.0)
    mean = F.try_divide(F.sum(F.col(value) * 100 * w), F.sum(w))
    out = F.when(F.col("_m").isNull() | (F.col("_m") > 100), NODATA).when(F.col("_m") <= 15, 0).otherwise(F.floor("_m"))
    return predictions.groupBy(*keys).agg(F.when(F.sum(w) > 0, mean).alias("_m")).withColumn("u8", out.cast("int")).drop("_m")


def compared(a: DataFrame, b: DataFrame, value: str, keys: list[str], group: list[str]) -> DataFrame:
    """Agreement of two rasters over the pixels that both have data for.

    corr_close is the correlation without the pixels that differ by more than FAR, null unless more than LEAST_CLOSE
    are left; far is their share.
    """
    both = a.where(F.col(value) != NODATA).join(b.where(F.col(value) != NODATA).withColumnRenamed(value, "_b"), keys)
    off = F.abs(F.col(value) - F.col("_b"))
    share = lambda n: F.round(100.0 * F.count_if(off <= n) / F.count("*"), 6).alias(f"within_{n}")
    close = F.when(off <= FAR, 1)
    return both.groupBy(*group).agg(
        F.round(F.when(F.count(close) > LEAST_CLOSE, F.corr(F.when(off <= FAR, F.col(value)), F.when(off <= FAR, F.col("_b")))), 6).alias("corr_close"),
        F.round(100.0 * F.count_if(off > FAR) / F.count("*"), 6).alias("far"), F.count("*").alias("n"), F.round(F.avg(off), 6).alias("mae"), F.max(off).alias("max_off"), F.round(F.sqrt(F.avg(off * off)), 6).alias("rmse"), share(1), share(5), share(10),
        F.round(F.corr(value, "_b"), 6).alias("corr"), F.round(F.avg(value), 6).alias("mean_a"), F.round(F.avg("_b"), 6).alias("mean_b"),
    )


def band_stats(values: DataFrame, group: str, value: str, shares: tuple[int, ...] = (5, 50, 95)) -> DataFrame:
    """Statistics of a band's positive values (percentiles interpolated), their share, and that of NaN among all."""
    number = F.when(~F.isnan(value), F.col(value))
    good = F.when(number > 0, number)
    r = lambda c: F.round(c, 6)
    plain = values.groupBy(group).agg(
        F.min(good).alias("min"), F.max(good).alias("max"), r(F.avg(good)).alias("mean"), r(F.stddev_pop(good)).alias("std"),
        r(F.count(good) / F.count("*")).alias("valid"), r(F.count_if(F.isnan(value)) / F.count("*")).alias("nan"),
    )
    points = percentiles(values.select(group, good.alias("_v")), [group], "_v", {f"p{q}": q / 100 for q in shares})
    return plain.join(points.select(group, *[r(f"p{q}").alias(f"p{q}") for q in shares]), group, "left")


def finite_range(values: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """(groups, low, high): least and greatest finite value; 0 and 1 without any, and never equal."""
    finite = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), F.col(value).cast("double"))
    low, high = F.coalesce(F.min(finite), F.lit(0.0)), F.coalesce(F.max(finite), F.lit(1.0))
    return values.groupBy(*(groups or [])).agg(low.alias("low"), F.when(low == high, high + 1e-9).otherwise(high).alias("high"))


def flattened(cells: DataFrame, axes: list[str], value: str) -> DataFrame:
    """An array's cells (a column for each axis) as a picture: means over all but its two longest axes, in their order.

    Of axes of one length the later ones are the longest.
    """
    sizes = cells.agg(*[(F.max(a) + 1).alias(a) for a in axes]).first()
    kept = sorted(sorted(range(len(axes)), key=lambda i: (sizes[axes[i]] or 0, i))[-2:])
    return cells.groupBy(*[axes[i] for i in kept]).agg(F.avg(value).alias(value))


def slopes(dem: DataFrame, value: str, metres: float, tile: str = "tile") -> DataFrame:
    """Slope in degrees from central differences (one-sided at the edges)."""

    def gradient(w: W) -> Column:
        before, own, after = F.lag(value).over(w), F.col(value), F.lead(value).over(w)
        return (F.coalesce(after, own) - F.coalesce(before, own)) / F.when(before.isNull() | after.isNull(), metres).otherwise(2 * metres)

    down, across = along(tile)
    steep = dem.withColumn("_dy", gradient(down)).withColumn("_dx", gradient(across))
    return steep.withColumn("slope", F.degrees(F.atan(F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))))).drop("_dx", "_dy")


def doubled(pixels: DataFrame, value: str, tile: str = "tile") -> DataFrame:
    """A raster of twice the rows and columns by bilinear interpolation between pixel centres; edges repeat.

    A pixel gives each output near it a weight, and outputs add up what they get: no pixel looks for its neighbours.
    """
    size = pixels.groupBy(tile).agg((F.max("r") + 1).alias("_h"), (F.max("c") + 1).alias("_w"))

    def spread(at: str, n: str) -> Column:
        last = F.col(n) * 2 - 1
        near = lambda off, w: F.struct((F.col(at) * 2 + off).alias("to"), F.lit(w).alias("w"))
        own = F.array(near(-1, 0.25), near(0, 0.75), near(1, 0.75), near(2, 0.25))
        first = F.when(F.col(at) == 0, F.array(F.struct(F.lit(0).alias("to"), F.lit(0.25).alias("w")))).otherwise(F.array().cast("array<struct<to: int, w: double>>"))
        end = F.when(F.col(at) == F.col(n) - 1, F.array(F.struct(last.alias("to"), F.lit(0.25).alias("w")))).otherwise(F.array().cast("array<struct<to: int, w: double>>"))
        return F.filter(F.concat(own, first, end), lambda x: (x["to"] >= 0) & (x["to"] <= last))

    each = pixels.join(size, tile).select(tile, value, spread("r", "_h").alias("_r"), spread("c", "_w").alias("_c"))
    out = each.select(tile, value, F.explode("_r").alias("_r"), "_c").select(tile, value, "_r", F.explode("_c").alias("_c"))
    return out.groupBy(tile, F.col("_r.to").alias("r"), F.col("_c.to").alias("c")).agg(F.sum(F.col(value) * F.col("_r.w") * F.col("_c.w")).alias(value))


def rolled_up(parity: DataFrame, name: str, score: str) -> DataFrame:
    """Mean and least score of rasters, and which has the least."""
    return parity.agg(F.round(F.avg(score), 6).alias("mean"), F.min(score).alias("least"), F.min(F.struct(score, name)).getField(name).alias("worst"))


def differences(a: DataFrame, b: DataFrame, value: str, keys: list[str], far: float = 5) -> DataFrame:
    """Percentiles of the absolute differences of two rasters, their deviation, equal, nearly equal (1e-6) and far pixels."""
    off = a.join(b.withColumnRenamed(value, "_b"), keys).select(F.abs(F.col(value) - F.col("_b")).alias("off"))
    plain = off.agg(
        F.round(F.stddev_pop("off"), 6).alias("std"), F.count_if(F.col("off") == 0).alias("equal"), F.count_if(F.col("off") <= 1e-6).alias("near"),
        F.count_if(F.col("off") > far).alias("far"), F.max("off").alias("most"),
    )
    points = percentiles(off, [], "off", {f"p{q}": q / 100 for q in (50, 90, 95, 99)})
    return plain.join(points.select(*[F.round(c, 6).alias(c) for c in points.columns]))
