"""Cloud, shadow and brightness masks of pixel series (tile, r, c, t and bands b0 to b9) as windows over time and space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions.spectral import evi, normalised_difference

from .raster import both_ways, cross_dilated, window_extreme
from .shared import Saved, percentiles
from .terrain import local_variance, smoothed


def band(i: int) -> Column:
    return F.col(f"b{i}")



def opened(pixels: DataFrame, flag: str, shrink: int, grow: int) -> DataFrame:
    """A flag whose false places grow by `shrink` steps and whose true ones then grow by `grow`, in crosses."""
    keyed = pixels.withColumn("_image", F.concat_ws("|", "tile", "t"))
    lost = cross_dilated(keyed.withColumn("_no", ~F.col(flag)), "_no", shrink, "_image").withColumn("_left", ~F.col("dilated")).drop("dilated", "_no")
    return cross_dilated(lost, "_left", grow, "_image").withColumn(flag, F.col("dilated")).drop("dilated", "_left", "_image")


def bright_clouds(pixels: DataFrame, green: float = 0.21) -> DataFrame:
    """pixels with `cloud`: bright in the narrow near infrared and green, not much redder than the short-wave band."""
    raw = (band(7) > 0.166) & (band(1) > green) & F.coalesce(F.try_divide(band(5), band(8)) < 4.292, F.lit(False))
    return opened(pixels.withColumn("cloud", raw), "cloud", 2, 10)


def brightening(pixels: DataFrame, reach: int = 2) -> DataFrame:
    """pixels with `cloud`: far brighter than the pixel's least within `reach` images, in blue, green and red."""
    near = W.partitionBy("tile", "r", "c").orderBy("t").rowsBetween(-reach, reach)
    rise = lambda i, by: band(i) - F.min(band(i)).over(near) > by
    return pixels.withColumn("cloud", rise(0, 0.08) & rise(1, 0.08) & rise(2, 0.07))


def darkening(pixels: DataFrame) -> DataFrame:
    """pixels with `shadow`: darker than the pixel's median of four images before to two after, and not water."""
    near = W.partitionBy("tile", "r", "c").orderBy("t").rowsBetween(-4, 2)
    whole = W.partitionBy("tile", "r", "c")
    middle = lambda i: F.array_sort(F.collect_list(band(i)).over(near))  # noqa: E731  at most seven values

    def median(i: int) -> Column:
        x = middle(i)
        half = F.floor((F.size(x) - 1) / 2).cast("int")
        return (F.get(x, half) + F.get(x, F.floor(F.size(x) / 2).cast("int"))) / 2

    below = lambda i, by: band(i) - median(i) < -by
    water = F.median(normalised_difference(band(1), band(3))).over(whole) > 0
    return pixels.withColumn("shadow", below(7, 0.04) & below(8, 0.04) & below(0, 0.02) & (band(0) < 0.09) & (band(7) < 0.17) & ~F.coalesce(water, F.lit(False)))


def nearness(pixels: DataFrame, flag: str, reach: int, out: str) -> DataFrame:
    """1 at flagged pixels, falling with the straight distance to the nearest to 0 at `reach` pixels and beyond.

    Down a column the nearest flagged pixel, then along a row the least distance to one of those within reach, held in
    a list of at most 2 reach + 1: no pixel is copied.
    """
    down, up, across, _ = both_ways("tile", "t")
    at = F.when(F.col(flag), F.col("r"))
    upto = lambda w: w.rangeBetween(W.unboundedPreceding, 0)
    column = pixels.withColumn("_d", F.least(F.col("r") - F.max(at).over(upto(down)), F.min(at).over(upto(up)) - F.col("r")))
    near = F.collect_list(F.when(F.col("_d") < reach, F.struct("c", "_d"))).over(across.rangeBetween(1 - reach, reach - 1))
    least = F.array_min(F.transform("_within", lambda x: F.sqrt((x["c"] - F.col("c")) * (x["c"] - F.col("c")) + x["_d"] * x["_d"])))
    found = column.withColumn("_within", near).withColumn("_least", F.least(F.coalesce(least, F.lit(float(reach))), F.lit(float(reach))))
    return found.withColumn(out, 1 - F.col("_least") / reach).drop("_d", "_within", "_least")


def interpolation_weights(pixels: DataFrame, flag: str = "cloud", side: int = 15) -> DataFrame:
    """pixels with `interp`: nearness to clouds within 12 pixels, small values 0, then closed over side x side pixels (of an even
    side, the window for the greatest reaches one further behind, that for the least one further before)."""
    soft = nearness(pixels, flag, 12, "_soft").withColumn("_soft", F.when(F.col("_soft") < 0.2, 0.0).otherwise(F.col("_soft")))
    keyed = soft.withColumn("_image", F.concat_ws("|", "tile", "t"))
    half = side // 2
    top = window_extreme(keyed, side - 1 - half, "_soft", "_top", "_image", after=half)
    return window_extreme(top, half, "_top", "interp", "_image", least=True, after=side - 1 - half).drop("_soft", "_top", "_image")


def aligned_mosaic(pixels: DataFrame, value: str = "v", weight: str = "interp") -> DataFrame:
    """(tile, r, c, value): the mean over images, by 1 - weight, after each image takes the others' median and spread.

    An image's own clear pixels (weight under 0.25) are compared with the mean of the other images there; sums by
    pixel give that mean, so images never meet in pairs. The result stays within the pixel's range.
    """
    pixel = W.partitionBy("tile", "r", "c")
    clear = F.when(F.col(weight) < 1, F.col(value))
    others = F.try_divide(F.sum(clear).over(pixel) - F.coalesce(clear, F.lit(0.0)), F.count(clear).over(pixel) - F.when(clear.isNull(), 0).otherwise(1))
    both = pixels.withColumn("_others", others)
    used = F.when((F.col(weight) < 0.25) & F.col("_others").isNotNull(), True)
    stats = both.groupBy("tile", "t").agg(
        F.median(F.when(used, F.col("_others"))).alias("_mr"), F.stddev_pop(F.when(used, F.col("_others"))).alias("_sr"), F.median(F.when(used, F.col(value))).alias("_mv"), F.stddev_pop(F.when(used, F.col(value))).alias("_sv")
    )
    scale = F.coalesce(F.try_divide(F.col("_sr"), F.col("_sv")), F.lit(1.0))
    fitted = pixels.join(stats, ["tile", "t"]).withColumn("_fit", F.col(value) * scale + F.coalesce(F.col("_mr") - F.col("_mv") * scale, F.lit(0.0)))
    w = 1 - F.col(weight)
    mean = F.coalesce(F.try_divide(F.sum(F.col("_fit") * w), F.sum(w)), F.percentile(value, 0.1))
    return fitted.groupBy("tile", "r", "c").agg(F.least(F.greatest(mean, F.min(value)), F.max(value)).alias(value))


def bright_surfaces(pixels: DataFrame, least: float = 0.2) -> DataFrame:
    """(tile, r, c, kept): 0 at bright bare ground, 1 from three pixels off it.

    Ground is bare where at least two images have it bright, poor in vegetation and strong in the short-wave band.
    """
    flag = (F.try_divide(band(3), band(8) + 0.01) < 0.9) & ((band(0) + band(1) + band(2)) / 3 > least) & (evi(band(0), band(2), band(3)) < 0.3)
    bare = pixels.groupBy("tile", "r", "c").agg((F.count_if(F.coalesce(flag, F.lit(False))) > 1).alias("bare")).withColumn("t", F.lit(0))
    return nearness(opened(bare, "bare", 2, 1), "bare", 3, "_near").select("tile", "r", "c", (1 - F.col("_near")).alias("kept"))


def no_data(pixels: DataFrame, grow: int = 10) -> DataFrame:
    """(tile, r, c, nodata): pixels whose first four bands are all 0 in every image, or missing in one, and those near them."""
    first = [band(i) for i in range(4)]
    empty = F.bool_and(F.coalesce(sum(first[1:], first[0]) == 0, F.lit(False)))
    missing = F.bool_or(F.greatest(*[c.isNull().cast("int") for c in first]) == 1)
    raw = pixels.groupBy("tile", "r", "c").agg((empty | missing).alias("_raw"))
    return cross_dilated(raw, "_raw", grow).select("tile", "r", "c", F.col("dilated").alias("nodata"))


def square_grown(pixels: DataFrame, flag: str, n: int, out: str, image: list[str]) -> DataFrame:
    """pixels with `out`: whether a flagged pixel is within n rows and columns."""
    keyed = pixels.withColumns({"_image": F.concat_ws("|", *image), "_flag": F.coalesce(F.col(flag).cast("int"), F.lit(0))})
    return window_extreme(keyed, n, "_flag", "_grown", "_image").withColumn(out, F.col("_grown") > 0).drop("_image", "_flag", "_grown")


def without_noise(pixels: DataFrame, flag: str = "cloud") -> DataFrame:
    """A flag without single clouds that are always there: of a pixel flagged in all images, the first image in which no
    pixel beside it is flagged is cleared. Pixels at the raster's edge stay."""
    keyed = pixels.withColumns({"_image": F.concat_ws("|", "tile", "t"), "_flag": F.col(flag).cast("int")})
    down, across = W.partitionBy("_image", "c").orderBy("r").rowsBetween(-1, 1), W.partitionBy("_image", "r").orderBy("c").rowsBetween(-1, 1)
    near = keyed.withColumns({"_line": F.sum("_flag").over(down), "_rows": F.count("*").over(down)})
    near = near.withColumns({"_sum": F.sum("_line").over(across), "_cells": F.sum("_rows").over(across)})
    whole = W.partitionBy("tile", "r", "c")
    alone = F.col(flag) & (F.col("_sum") <= 1) & (F.col("_cells") == 9) & (F.min("_flag").over(whole) > 0)
    first = F.min(F.when(alone, F.col("t"))).over(whole)
    return near.withColumn(flag, F.col(flag) & ~F.coalesce(alone & (F.col("t") == first), F.lit(False))).drop("_image", "_flag", "_line", "_rows", "_sum", "_cells")


#: Limits of the parallax index, of vegetation, and of elevation in units of 90 metres.
PARALLAX, GREEN_LIMIT, HIGH = -0.4, 0.4, 0.10


def parallax_index(pixels: DataFrame) -> DataFrame:
    """(tile, t, r, c, cdi) of blocks of 2 x 2 pixels: how much more the ratio of the far to the narrow infrared band varies
    around them than that of the wide to the narrow one, from -1 to 1; null where neither does."""
    keyed = pixels.select(F.concat_ws("|", "tile", "t").alias("_image"), "tile", "t", "r", "c", "b3", "b6", "b7")
    soft = smoothed(keyed, "b3", 0.5, 3.0, "_image")
    block = lambda at: F.floor(F.col(at) / 2).cast("int").alias(at)
    means = soft.groupBy("_image", "tile", "t", block("r"), block("c")).agg(*[F.avg(b).alias(b) for b in ("b3", "b6", "b7")])
    ratios = means.withColumns({"_wide": F.try_divide("b3", "b7"), "_far": F.try_divide("b6", "b7")})
    varied = local_variance(local_variance(ratios, "_wide", "_v", 3, "_image"), "_far", "_v7", 3, "_image")
    return varied.select("tile", "t", "r", "c", F.try_divide(F.col("_v7") - F.col("_v"), F.col("_v7") + F.col("_v")).alias("cdi"))


def false_positives(pixels: DataFrame, ground: DataFrame, urban: bool = True) -> DataFrame:
    """(tile, t, r, c, candidate, false_cloud): pixels that may be taken for clouds by mistake.

    ground: tile, r, c, elevation in metres and, with urban, urban (1: a town). Without urban no pixel is a candidate
    by place. A candidate is a town's pixel, or one that is mostly built up and not water, below HIGH; a false cloud is
    also near the parallax of no cloud, with little vegetation. Both grow by six pixels in all directions.
    """
    block = lambda at: F.floor(F.col(at) / 2).cast("int").alias(f"_b{at}")
    cdi = parallax_index(pixels).select("tile", "t", F.col("r").alias("_br"), F.col("c").alias("_bc"), "cdi")
    ndvi, ndwi, ndbi = normalised_difference(band(3), band(2)), normalised_difference(band(1), band(3)), normalised_difference(band(8), band(3))
    marked = pixels.select("tile", "t", "r", "c", block("r"), block("c"), ndvi.alias("_ndvi"), ndwi.alias("_ndwi"), F.coalesce((ndbi > 0) & (ndbi > ndvi), F.lit(False)).cast("double").alias("_built"))
    low = marked.join(cdi, ["tile", "t", "_br", "_bc"], "left").withColumn("_clear", F.coalesce((F.col("cdi") >= PARALLAX) & (F.col("_ndvi") < GREEN_LIMIT), F.lit(False)))
    place = marked.groupBy("tile", "r", "c").agg(F.median("_built").alias("_built"), F.median("_ndwi").alias("_ndwi")).join(ground, ["tile", "r", "c"])
    here = F.when(F.col("urban") == 1, F.lit(True)).otherwise((F.col("_built") > 0) & F.coalesce(F.col("_ndwi") < 0, F.lit(False))) if urban else F.lit(False)
    place = place.withColumn("_here", here & (F.col("elevation") / 90 <= HIGH))
    grown = square_grown(place, "_here", 6, "candidate", ["tile"]).select("tile", "r", "c", "candidate")
    out = square_grown(low, "_clear", 6, "_near", ["tile", "t"]).join(grown, ["tile", "r", "c"])
    return out.select("tile", "t", "r", "c", "candidate", (F.col("candidate") & F.col("_near")).alias("false_cloud"))


def clouds_left(mosaic: DataFrame, part: float = 1.0) -> DataFrame:
    """mosaic (tile, r, c, b0, b1, b2, clear: the number of images without interpolation, false_cloud) with `cloud`.

    Doubtful pixels have one clear image at most or are within ten steps of a false cloud. Of these, clouds are brighter in
    blue and red than 99 per cent of the others, though not wholly white, and away from false clouds; the clouds' gaps of
    up to three steps are taken out of them, and the rest grows by eight. A tile of doubtful pixels alone has no clouds.
    part: take that part of both limits.
    """
    found = cross_dilated(mosaic, "false_cloud", 10).withColumnRenamed("dilated", "_near").withColumn("_doubt", (F.col("clear") < 2) | F.col("_near"))
    near = Saved(mosaic.sparkSession, "clouds-left").table(found, "near")
    sure = near.where(~F.col("_doubt"))
    limits = percentiles(sure, ["tile"], "b0", {"_blue": 0.99}).join(percentiles(sure, ["tile"], "b2", {"_red": 0.99}), "tile")
    lit = (F.col("b0") > part * F.col("_blue")) & (F.col("b2") > part * F.col("_red")) & F.col("_doubt") & (F.col("b0") + F.col("b1") + F.col("b2") < 1) & ~F.col("_near")
    marked = near.join(limits, "tile", "left").withColumn("_lost", ~F.coalesce(lit, F.lit(False)))
    kept = cross_dilated(marked, "_lost", 3).withColumn("_kept", ~F.col("dilated")).drop("dilated")
    return cross_dilated(kept, "_kept", 8).withColumnRenamed("dilated", "cloud").select(*mosaic.columns, "cloud")


def pruned(pixels: DataFrame, detect, share: float = 0.9, rounds: int = 3, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """pixels without the images of which more than a share is to be interpolated, and detect's result for the others.

    detect takes pixels and returns tile, t, r, c and interp (over 0: to be interpolated). As what one image shows depends
    on the others, it runs again after each round that drops some, and once in all if none does: its result is written, read to judge
    the images, and returned. A tile keeps all images of a round that would leave it fewer than `least`. The driver sees
    no rows, only whether a round dropped any.
    """
    saved = Saved(pixels.sparkSession, "pruned")
    found = saved.table(detect(pixels), "found-0")
    for k in range(rounds):
        images = found.groupBy("tile", "t").agg((F.avg((F.col("interp") > 0).cast("int")) > share).alias("bad"))
        left = images.groupBy("tile").agg(F.count_if(~F.col("bad")).alias("left")).where(F.col("left") >= least)
        bad = saved.table(images.where("bad").join(left, "tile").select("tile", "t"), f"images-{k}")
        if bad.isEmpty():
            break
        pixels = saved.table(pixels.join(bad, ["tile", "t"], "left_anti"), f"pixels-{k}")
        found = saved.table(detect(pixels), f"found-{k + 1}")
        for old in [f"found-{k}", f"images-{k}"] + ([f"pixels-{k - 1}"] if k else []):
            saved.drop(old)
    return pixels, found
