"""Clouds taken out of a tile's images: weights, mosaic, regression, blending and what is left, step by step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import clouds, regression
from .shared import Saved

BANDS = [f"b{i}" for i in range(regression.BANDS)]
#: Fixed value: the side of the window over which removal closes its weights.
CLOSED = 20


def band_mosaic(pixels: DataFrame) -> DataFrame:
    """(tile, r, c, m0 to m9): the aligned mosaic of every band; a band of a tile is a raster of its own, so all go in one pass."""
    pairs = [F.struct(F.lit(i).alias("band"), F.col(b).cast("double").alias("v")) for i, b in enumerate(BANDS)]
    long = pixels.select("tile", "t", "r", "c", "interp", F.explode(F.array(*pairs)).alias("x")).select(F.struct("tile", "x.band").alias("tile"), "t", "r", "c", "interp", "x.v")
    found = clouds.aligned_mosaic(long).select("tile.tile", "r", "c", "tile.band", "v")
    return found.groupBy("tile", "r", "c").agg(*[F.max(F.when(F.col("band") == i, F.col("v"))).alias(f"m{i}") for i in range(len(BANDS))])


def left_over(weighted: DataFrame, mosaic: DataFrame, false_clouds: DataFrame) -> DataFrame:
    """(tile, r, c, cloud): clouds that the mosaic still shows; false_clouds: tile, r, c of places that only look like clouds."""
    clear = weighted.groupBy("tile", "r", "c").agg(F.count_if(F.col("interp") <= 0).alias("clear"))
    places = false_clouds.select("tile", "r", "c").distinct().withColumn("false_cloud", F.lit(True))
    flat = mosaic.select("tile", "r", "c", *[F.col(f"m{i}").alias(f"b{i}") for i in range(3)]).join(clear, ["tile", "r", "c"]).join(places, ["tile", "r", "c"], "left")
    return clouds.clouds_left(flat.withColumn("false_cloud", F.coalesce("false_cloud", F.lit(False)))).select("tile", "r", "c", "cloud")


def removed(pixels: DataFrame, false_clouds: DataFrame, order=None) -> dict[str, DataFrame]:
    """pixels (tile, t, r, c, b0 to b9, cloud) without their clouds, in steps each of which is written before the next one reads it.

    A lost executor so repeats its part of one step alone. `pixels`: all columns, bands blended with what the mosaic
    and the image's regression give, and interp, the weight of that, with places that the mosaic still shows as clouds
    at 1. `mosaic`: tile, r, c, m0 to m9. `dropped`: tile and t of images that are nothing but interpolation.
    order: which pixels of a sample come first (see regression.samples).
    """
    saved = Saved(pixels.sparkSession, "removal")
    weighted = saved.table(clouds.interpolation_weights(pixels, "cloud", CLOSED), "weights")
    mosaic = saved.table(band_mosaic(weighted), "mosaic")
    ground = saved.table(mosaic.join(regression.places(weighted), ["tile", "r", "c"]), "ground")
    blended = saved.table(regression.regression_filled(weighted, ground, order), "blended")
    left = saved.table(left_over(weighted, mosaic, false_clouds), "left")
    dropped = weighted.groupBy("tile", "t").agg(F.min("interp").alias("least")).where("least >= 1").select("tile", "t")
    out = blended.join(left.withColumnRenamed("cloud", "_left"), ["tile", "r", "c"]).withColumn("interp", F.least(F.col("interp") + F.col("_left").cast("int"), F.lit(1.0)))
    return {"pixels": out.select(weighted.columns), "mosaic": mosaic, "dropped": saved.table(dropped, "dropped")}
