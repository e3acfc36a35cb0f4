"""Clouds and shadows by comparison in time and within images: references, levels that follow the share, outliers, haze, and all steps together."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions.spectral import normalised_difference

from .clouds import bright_clouds, false_positives, nearness, opened
from .raster import cross_dilated, cross_distance, window_sum
from .shared import Saved, percentiles

#: How much brighter than its references a cloud is in blue, green and red; the range of the limit to the near
#: references, what woods take off it, and its least; the step of levels and the share that near clouds may have beyond far ones.
FAR_RISE, NEAR_RISE = (0.08, 0.08, 0.07), (0.01, 0.01, 0.0)
NEAR_LIMIT, WOODS, LEAST_LIMIT = (0.05, 0.10), 0.02, 0.04
STEP, MORE = 0.0025, 0.075
#: Brightest sum of a near cloud, outliers' z-score, brightness and spread of colours that aren't white, limits of haze.
WHITE_SUM, LEAST_Z, DULL, COLOURED = 0.75, 3.5, 0.4, 0.5
HAZE, STRONG_HAZE = (1.5, 0.67, 1.0), (1.3, 0.5)


def compared_images(n: int) -> list[tuple[list[int], list[list[int]]]]:
    """For each of n > 2 images in order of time: those around it, and those near it in layers, the first of which is looked at
    first, the others only where it has nothing.

    Around are two before to two after, at either end five in all. Near are the two neighbours, at an end the two next
    to it, with one more before them where they reach the last two of more than three images. Each further layer, ten
    at most, goes one image further back, and forward to just before as many.
    """
    out = []
    for i in range(n):
        low, high = (0, 4) if i == 0 else (n - 5, n - 1) if i == n - 1 else (i - 2, i + 2)
        near = [1, 2] if i == 0 else [n - 3, n - 2] if i == n - 1 else [i - 1, i + 1]
        if near[-1] >= n - 2 and n > 3:
            near = [near[0] - 1, *near]
        layers = [[k % n for k in near]]
        for step in range(1, 11):
            reach = range(max(near[0] - step, 0), min(near[-1] + step, n))
            layers.append([k for k in reach if k != i])
        out.append((list(range(max(low, 0), min(high, n - 1) + 1)), layers))
    return out


def least_known(values: np.ndarray) -> np.ndarray:
    """The least along the axis of images, NaN left out; NaN where all are."""
    least = np.where(np.isnan(values), np.inf, values).min(1)
    return np.where(np.isinf(least), np.nan, least)


def rises(v: np.ndarray, hidden: np.ndarray, woods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pixels' series (pixel, image, blue to red): whether each is a far cloud, and by how much it is above the near limit."""
    n = v.shape[1]
    far, score = np.zeros(v.shape[:2], bool), np.zeros(v.shape[:2])
    known = np.where(hidden[..., None], np.nan, v)
    quarter, least = np.percentile(v, 25, axis=1), v.min(1)
    for i, (around, layers) in enumerate(compared_images(n) if n > 2 else [(None, None)] * n):
        if around is None:
            upper = near = least
        else:
            upper = least_known(known[:, around])
            upper = np.where(np.isnan(upper[:, :1]), quarter, upper)
            near = least_known(known[:, layers[0]])
            for layer in layers[1:]:
                if not np.isnan(near).any():
                    break
                if layer:
                    near = np.where(np.isnan(near), least_known(known[:, layer]), near)
            near = np.where(np.isnan(near), least, near)
        limit = np.maximum(np.clip(near[:, 0] / 2 + 0.005, *NEAR_LIMIT) - WOODS * woods, LEAST_LIMIT)
        far[:, i] = (v[:, i] - upper > FAR_RISE).all(1)
        score[:, i] = (v[:, i] - near - limit[:, None] - NEAR_RISE).min(1)
    return far, score


def rising(pixels: DataFrame, ground: DataFrame, shadow: str = "shadow") -> DataFrame:
    """(tile, t, r, c, far, score): pixels (b0 to b2 and a flag for shadows) against what they look like in other images.

    ground: tile, r, c, woods (1: forest). far: much brighter than the least of the images around. score: by how much
    it is brighter than the images near it, beyond the limit there; over 0 it is a near cloud. Images in which the pixel
    is in shadow count as missing; where all around are, the quartile of the series stands for them, where all near are,
    those further off, in the end the least of all. A pixel's series is an array, of some tens of images.
    """
    kinds = [pixels.schema[c].dataType.simpleString() for c in ("tile", "r", "c", "t")]
    series = pixels.groupBy("tile", "r", "c").agg(F.array_sort(F.collect_list(F.struct("t", *[F.col(b).cast("double").alias(b) for b in ("b0", "b1", "b2")], F.coalesce(F.col(shadow), F.lit(False)).alias("hidden")))).alias("s"))
    series = series.join(ground.select("tile", "r", "c", "woods"), ["tile", "r", "c"], "left")
    each = lambda name: F.transform("s", lambda x: x[name])
    flat = F.flatten(F.transform("s", lambda x: F.array(x["b0"], x["b1"], x["b2"])))
    series = series.select("tile", "r", "c", each("t").alias("t"), flat.alias("v"), each("hidden").alias("hidden"), F.coalesce(F.col("woods").cast("double"), F.lit(0.0)).alias("woods"))

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            sizes = np.diff(batch.column(3).offsets.to_numpy())
            first = np.cumsum(sizes) - sizes
            values = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)
            hidden = batch.column(5).flatten().to_numpy(zero_copy_only=False)
            woods = batch.column(6).to_numpy()
            far, score = np.zeros(len(values), bool), np.zeros(len(values))
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                at = first[own][:, None] + np.arange(n)
                far[at], score[at] = rises(values[at], hidden[at], woods[own])
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (batch.column(3).flatten(), pa.array(far), pa.array(score))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["tile", "r", "c", "t", "far", "score"])

    found = series.mapInArrow(compare, f"tile {kinds[0]}, r {kinds[1]}, c {kinds[2]}, t array<{kinds[3]}>, far array<boolean>, score array<double>")
    return found.select("tile", "r", "c", F.explode(F.arrays_zip("t", "far", "score")).alias("x")).select("tile", "x.t", "r", "c", "x.far", "x.score")


def levelled(scored: DataFrame) -> DataFrame:
    """scored (tile, t, far, score) with `near`: score above the image's level.

    The level is the first of 0, STEP, 2 STEP ... at which the share of such pixels is no more than MORE above that of far
    ones. A pixel's score says at how many levels it still counts, so counts of pixels by that number, from the top
    down, give the share at every level at once: no image is gone through again and again.
    """
    steps = F.greatest(F.ceil(F.col("score") / STEP), F.lit(0)).cast("long")
    counts = scored.withColumn("steps", steps).groupBy("tile", "t", "steps").agg(F.count("*").alias("n"), F.count_if("far").alias("far"))
    zero = counts.select("tile", "t").distinct().select("tile", "t", F.lit(0).cast("long").alias("steps"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("far"))
    image = W.partitionBy("tile", "t")
    above = F.sum("n").over(image.orderBy(F.desc("steps")).rangeBetween(W.unboundedPreceding, 0)) - F.sum("n").over(W.partitionBy("tile", "t", "steps"))
    shares = counts.unionByName(zero).withColumns({"above": above, "of": F.sum("n").over(image), "share": F.sum("far").over(image)})
    level = shares.where((F.col("above") - F.col("share")) / F.col("of") <= MORE).groupBy("tile", "t").agg(F.min("steps").alias("level"))
    return scored.withColumn("steps", steps).join(level, ["tile", "t"]).withColumn("near", F.col("steps") > F.col("level")).drop("steps", "level")


def visible(of: str = "") -> Column:
    return F.col(f"{of}b0") + F.col(f"{of}b1") + F.col(f"{of}b2")


def outliers(pixels: DataFrame) -> DataFrame:
    """pixels (b0 to b2, water below 0 on land, cloud, shadow) with `cloud` true too where they are far brighter than their image.

    Brightness is the sum of the visible bands over its median off clouds and shadows, 1 on water. An outlier is LEAST_Z
    deviations above the mean off clouds (of all pixels, if clouds cover the image), and on land. Pixels that become
    clouds in more than one image stay as they were in all. Medians come from exact ranks, not from arrays.
    """
    clear = pixels.where("not cloud and not shadow").select("tile", "t", visible().alias("sum"))
    middle = percentiles(clear, ["tile", "t"], "sum", {"_middle": 0.5})
    lit = pixels.join(middle, ["tile", "t"], "left").withColumn("_ratio", F.when(F.col("water") > 0, 1.0).otherwise(F.try_divide(visible(), F.col("_middle"))))
    off = F.when(~F.col("cloud"), F.col("_ratio"))
    stats = lit.groupBy("tile", "t").agg(
        F.when(F.bool_and("cloud"), F.avg("_ratio")).otherwise(F.avg(off)).alias("_mean"), F.when(F.bool_and("cloud"), F.stddev_pop("_ratio")).otherwise(F.stddev_pop(off)).alias("_deviation")
    )
    z = F.try_divide(F.col("_ratio") - F.col("_mean"), F.col("_deviation"))
    marked = lit.join(stats, ["tile", "t"]).withColumn("_new", F.coalesce((z > LEAST_Z) & (F.col("water") < 0) & ~F.col("cloud"), F.lit(False)))
    often = F.count_if("_new").over(W.partitionBy("tile", "r", "c"))
    return marked.withColumn("_often", often).withColumn("cloud", F.col("cloud") | (F.col("_new") & (F.col("_often") == 1))).select(pixels.columns)


def white_only(pixels: DataFrame) -> DataFrame:
    """pixels whose `cloud` is false where they are dull and coloured: no cloud looks so."""
    bands = [F.col(f"b{i}") for i in range(3)]
    mean = visible() / 3
    coloured = F.coalesce(F.try_divide(F.greatest(*bands) - F.least(*bands), mean) > COLOURED, F.lit(False))
    return pixels.withColumn("cloud", F.col("cloud") & ~((mean < DULL) & coloured))


def hazy(pixels: DataFrame) -> DataFrame:
    """(tile, t): images that are brighter off clouds than their tile's others, with less contrast and colour, as haze makes them.

    Means and deviations of an image's clear pixels are set against the medians of its tile's images (some tens).
    Images without clear pixels are not judged.
    """
    bands = [F.col(f"b{i}") for i in range(3)]
    images = pixels.where("not cloud").groupBy("tile", "t").agg(F.avg(visible() / 3).alias("mean"), F.stddev_pop(visible() / 3).alias("spread"), F.stddev_pop(F.greatest(*bands) - F.least(*bands)).alias("colour"))
    tile = W.partitionBy("tile")
    over = {c: F.try_divide(F.col(c), F.median(c).over(tile)) for c in ("mean", "spread", "colour")}
    mean, spread, colour = over["mean"], over["spread"], over["colour"]
    haze = ((mean >= HAZE[0]) & (spread <= HAZE[1]) & (colour < HAZE[2])) | ((mean >= STRONG_HAZE[0]) & (spread <= STRONG_HAZE[1]))
    return images.withColumn("haze", F.coalesce(haze, F.lit(False))).where("haze").select("tile", "t")


def compared_clouds(pixels: DataFrame, ground: DataFrame, saved: Saved) -> DataFrame:
    """pixels (tile, t, r, c, b0 to b9, shadow) with water and `cloud`: brighter than in other images or within their own, and white.

    ground: tile, r, c, woods (1: forest), water (NDWI, over 0 on water). Off woods, near clouds are left where they reach
    two steps around.
    """
    scored = saved.table(rising(pixels, ground), "scored")
    both = pixels.join(levelled(scored), ["tile", "t", "r", "c"]).join(ground.select("tile", "r", "c", "woods", "water"), ["tile", "r", "c"])
    both = both.withColumns({"_near": F.col("near") & (visible() < WHITE_SUM), "_image": F.concat_ws("|", "tile", "t")})
    kept = cross_dilated(both.withColumn("_no", ~F.col("_near")), "_no", 2, "_image")
    near = F.when(F.col("woods") == 1, F.col("_near")).otherwise(~F.col("dilated"))
    first = saved.table(kept.withColumn("cloud", F.col("far") | near).select(*pixels.columns, "water", "cloud"), "first")
    return saved.table(white_only(outliers(first)), "marked")


def with_haze(pixels: DataFrame) -> DataFrame:
    """pixels whose `cloud` is true in all of a hazy image."""
    whole = hazy(pixels).withColumn("_haze", F.lit(True))
    return pixels.join(whole, ["tile", "t"], "left").withColumn("cloud", F.col("cloud") | F.coalesce("_haze", F.lit(False))).select(pixels.columns)


def clouds_in_time(pixels: DataFrame, ground: DataFrame) -> DataFrame:
    """pixels (tile, t, r, c, b0 to b9, shadow) with `cloud`, by `compared_clouds` and haze.

    Steps that look at whole images are written, so that a lost executor repeats one step.
    """
    return with_haze(compared_clouds(pixels, ground, Saved(pixels.sparkSession, "clouds-in-time"))).drop("water")


#: Limits of the first clouds, of shadows (blue, green, narrow infrared and short wave), and of what only looks like clouds.
FIRST_GREEN = 0.28
BELOW_MIDDLE, BELOW_TOP = {"blue": 0.02, "nir": 0.04, "swir": 0.04}, {"nir": 0.04, "swir": 0.04}
SHADOW, DEEP, SLOPE = {"blue": 0.09, "nir": 0.17}, {"blue": 0.03, "nir": 0.18}, {"blue": 0.07, "nir": 0.18, "sum": 0.28, "metres": 25}
WATER_SHADOW = {"blue": 0.05, "green": 0.05, "nir": 0.03}
STEADY, BARE, WET, DARK, HIGH_GROUND = 0.4, 0.75, 0.11, 0.21, 30


def shadows_of(v: np.ndarray, cloudy: np.ndarray, total: np.ndarray, water: np.ndarray, metres: np.ndarray) -> np.ndarray:
    """Shadows in pixels' series (pixel, image; blue, green, nir, swir), by the images around that aren't cloudy.

    Around are four before to two after, for the first image three after. On land: darker than their middle, or far
    darker than their greatest and dark, where the ground is high also if less dark; on water, darker than all images' middle.
    """
    n = v.shape[1]
    known = np.where(cloudy[..., None], np.nan, v)
    out = np.zeros(cloudy.shape, bool)
    with np.errstate(invalid="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore")  # a series may be cloudy throughout
        whole = np.nanmedian(known, 1)
        whole = np.where(np.isnan(whole), np.median(v, 1), whole)
        for i in range(n):
            around = known[:, : min(4, n)] if i == 0 else known[:, max(i - 4, 0) : min(i + 3, n)]
            top, middle = np.nanmax(around, 1), np.nanmedian(around, 1)
            middle = np.where(np.isnan(middle), v.min(1), middle)
            blue, green, nir, swir = v[:, i].T
            low = (nir - middle[:, 2] < -BELOW_MIDDLE["nir"]) & (swir - middle[:, 3] < -BELOW_MIDDLE["swir"]) & (blue - middle[:, 0] < -BELOW_MIDDLE["blue"]) & (blue < SHADOW["blue"]) & (nir < SHADOW["nir"])
            far = (nir - top[:, 2] < -BELOW_TOP["nir"]) & (swir - top[:, 3] < -BELOW_TOP["swir"])
            deep = far & (blue < DEEP["blue"]) & (nir < DEEP["nir"])
            steep = far & (blue < SLOPE["blue"]) & (nir < SLOPE["nir"]) & (total[:, i] < SLOPE["sum"]) & (metres >= SLOPE["metres"])
            wet = (blue - whole[:, 0] < -WATER_SHADOW["blue"]) & (green - whole[:, 1] < -WATER_SHADOW["green"]) & (nir < WATER_SHADOW["nir"])
            out[:, i] = np.where(water > 0, wet, low | deep | steep)
    return out


def shaded(pixels: DataFrame, ground: DataFrame) -> DataFrame:
    """(tile, t, r, c, shadow): `shadows_of` every pixel's series. pixels: b0 to b9 and cloud; ground: water, elevation in metres."""
    kinds = [pixels.schema[c].dataType.simpleString() for c in ("tile", "r", "c", "t")]
    steps = F.array_sort(F.collect_list(F.struct("t", *[F.col(b).cast("double").alias(b) for b in ("b0", "b1", "b7", "b8")], visible().cast("double").alias("sum"), "cloud")))
    series = pixels.groupBy("tile", "r", "c").agg(steps.alias("s")).join(ground.select("tile", "r", "c", "water", "elevation"), ["tile", "r", "c"], "left")
    each = lambda name: F.transform("s", lambda x: x[name])
    flat = F.flatten(F.transform("s", lambda x: F.array(x["b0"], x["b1"], x["b7"], x["b8"])))
    none = F.lit(0.0)
    series = series.select("tile", "r", "c", each("t").alias("t"), flat.alias("v"), each("cloud").alias("cloud"), each("sum").alias("sum"), F.coalesce(F.col("water").cast("double"), none).alias("water"), F.coalesce(F.col("elevation").cast("double"), none).alias("elevation"))

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            sizes = np.diff(batch.column(3).offsets.to_numpy())
            first = np.cumsum(sizes) - sizes
            flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (4, 5, 6)]
            values, shadow = flat[0].reshape(-1, 4), np.zeros(len(flat[1]), bool)
            water, metres = batch.column(7).to_numpy(), batch.column(8).to_numpy()
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                at = first[own][:, None] + np.arange(n)
                shadow[at] = shadows_of(values[at], flat[1][at], flat[2][at], water[own], metres[own])
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (batch.column(3).flatten(), pa.array(shadow))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["tile", "r", "c", "t", "shadow"])

    found = series.mapInArrow(compare, f"tile {kinds[0]}, r {kinds[1]}, c {kinds[2]}, t array<{kinds[3]}>, shadow array<boolean>")
    return found.select("tile", "r", "c", F.explode(F.arrays_zip("t", "shadow")).alias("x")).select("tile", "x.t", "r", "c", "x.shadow")


def grown(pixels: DataFrame, flag: str, n: int) -> DataFrame:
    """pixels whose flag holds within n steps of where it held, in each image."""
    keyed = pixels.withColumn("_image", F.concat_ws("|", "tile", "t"))
    return cross_dilated(keyed, flag, n, "_image").withColumn(flag, F.col("dilated")).select(pixels.columns)


def shrunk(pixels: DataFrame, flag: str, n: int) -> DataFrame:
    """pixels whose flag holds only where all within n steps had it; beyond the edge nothing is missing."""
    return grown(pixels.withColumn(flag, ~F.col(flag)), flag, n).withColumn(flag, ~F.col(flag))


def disked(pixels: DataFrame, flag: str, n: int) -> DataFrame:
    """pixels whose flag holds within a straight distance of n of where it held."""
    return nearness(pixels, flag, n + 1, "_disk").withColumn(flag, F.col("_disk") > 1 / (n + 1) - 1e-9).select(pixels.columns)


def spread_in_time(pixels: DataFrame, flag: str, n: int) -> DataFrame:
    """pixels whose flag holds within n steps, of which some may go to earlier or later images."""
    far = cross_distance(pixels.withColumn("_image", F.concat_ws("|", "tile", "t")), flag, "_steps", "_image")
    own = W.partitionBy("tile", "r", "c").orderBy("t")
    reach = [F.coalesce((F.lag("_steps", k) if k >= 0 else F.lead("_steps", -k)).over(own) <= n - abs(k), F.lit(False)) for k in range(-n, n + 1)]
    return far.withColumn(flag, F.greatest(*[x.cast("int") for x in reach]) == 1).select(pixels.columns)


def near_sum(pixels: DataFrame, flag: str, out: str) -> DataFrame:
    keyed = pixels.withColumns({"_image": F.concat_ws("|", "tile", "t"), "_one": F.col(flag).cast("int")})
    return window_sum(keyed, "_one", out, "_image").drop("_image", "_one")


def identified(pixels: DataFrame, ground: DataFrame, urban: bool = True) -> DataFrame:
    """pixels (tile, t, r, c, b0 to b9) with `cloud`, clouds and their shadows, and `false_cloud`, what only looks like clouds.

    ground: tile, r, c, elevation in metres, woods and, with urban, urban (1: a town). Steps: first clouds, shadows by the
    images around, clouds by comparison, then without what false_positives, bare ground and water explain, single
    pixels and dark ground; what is left grows by size and place. Shadows far from few clouds on low ground go; dark
    pixels of images that are mostly clear and images in haze come to it. Each part is written, so that a lost
    executor repeats one part, and all are windows along lines, columns and pixels' series: no task holds an image.
    """
    saved, key = Saved(pixels.sparkSession, "identified"), ["tile", "t", "r", "c"]
    ndwi = normalised_difference(F.col("b1"), F.col("b3"))
    water = pixels.groupBy("tile", "r", "c").agg(F.median(ndwi).alias("water"))
    place = saved.table(ground.join(water, ["tile", "r", "c"]), "place")
    dark = shaded(bright_clouds(pixels, FIRST_GREEN), place)
    dark = saved.table(disked(opened(dark, "shadow", 2, 3), "shadow", 5), "shadows")
    found = compared_clouds(pixels.join(dark, key), place, saved)

    wrong = false_positives(pixels, place, urban)
    steady = visible() / 3 - F.min(F.least("b0", "b1", "b2")).over(W.partitionBy("tile", "r", "c").orderBy("t").rowsBetween(-1, 1)) < STEADY
    bare = spread_in_time(pixels.select(*key, F.coalesce(F.try_divide(F.col("b3"), F.col("b8") + 0.01) < BARE, F.lit(False)).alias("bare")), "bare", 3)
    flat = found.withColumn("steady", steady).join(wrong, key).join(bare, key).join(place.select("tile", "r", "c", "woods", "elevation"), ["tile", "r", "c"])
    flat = flat.withColumns({"bare": F.col("bare") & ~F.coalesce(F.col("water") < 0, F.lit(False)), "wet": F.coalesce((F.col("water") > 0) & (F.col("b8") < WET), F.lit(False)), "dark": visible() < DARK})
    flat = flat.withColumns({"cloud": F.col("cloud") & ~(F.col("steady") & (F.col("false_cloud") | F.col("bare"))), "shadow": F.col("shadow") & ~(F.col("steady") & F.col("false_cloud"))})
    flat = saved.table(grown(grown(flat, "wet", 10), "dark", 3).withColumn("cloud", F.col("cloud") & ~F.col("wet")), "explained")
    many = near_sum(flat, "cloud", "many").withColumn("cloud", F.col("cloud") & (F.col("many") >= 5) & ~(F.col("dark") & (F.col("woods") != 1)))

    sized = shrunk(grown(many.drop("many"), "candidate", 5), "cloud", 1)
    sized = sized.withColumns({"town": F.col("cloud") & F.col("candidate"), "open": F.col("cloud") & ~F.col("candidate")})
    sized = near_sum(shrunk(sized, "town", 3), "open", "many").withColumns({"large": F.col("open") & (F.col("many") >= 6), "open": F.col("open") & (F.col("many") < 6)})
    sized = grown(grown(sized, "large", 5), "open", 1).withColumn("open", F.col("open") | F.col("large"))
    sized = disked(sized, "open", 3).withColumns({"weight": F.col("open").cast("int") + F.col("town").cast("int"), "around": F.col("open") | F.col("town")})
    sized = saved.table(grown(sized, "around", 50).drop("large", "many", "cloud", "candidate", "wet", "dark", "steady"), "sized")

    image = W.partitionBy("tile", "t")
    clouds, shadows = F.avg("weight").over(image), F.avg(F.col("shadow").cast("int")).over(image)
    far_off = ((shadows > clouds + 0.3) & (clouds < 0.3)) | ((clouds < 0.05) & (shadows > 3 * clouds))
    near = F.col("around") | (F.col("elevation") >= HIGH_GROUND)
    both = sized.withColumn("far_off", far_off).withColumn("shadow", F.col("shadow") & (near | ~F.col("far_off"))).withColumn("weight", F.greatest("weight", F.col("shadow").cast("int")))
    clear = F.when(F.col("weight") == 0, 1 / F.col("b0"))
    both = both.withColumns({"share": F.avg("weight").over(image), "limit": F.avg(clear).over(image) + 2 * F.stddev_pop(clear).over(image)})
    deep = F.coalesce((F.col("share") < 0.9) & (1 / F.col("b0") > F.col("limit")) & (F.col("b7") < SHADOW["nir"]), F.lit(False))
    marked = opened(both.withColumn("deep", deep), "deep", 2, 2).withColumn("cloud", (F.col("weight") > 0) | (F.col("deep") & ~F.coalesce(F.col("water") > 0, F.lit(False))))
    marked = spread_in_time(marked.withColumn("false_cloud", F.col("false_cloud") | F.col("bare")), "false_cloud", 2)
    return with_haze(saved.table(marked.select(*pixels.columns, "cloud", "false_cloud"), "marked-all"))
