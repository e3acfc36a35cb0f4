"""Tables of a radar scene brought to its pixels, and what its footprints cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions.spectral import calibrated, flattened

from . import overlay


def filled_points(points: DataFrame, value: str) -> DataFrame:
    """A grid's points (line, pixel, value, a few hundred) with nulls filled from the nearest point, in steps of the grid."""
    ranks = points.withColumns({"_i": F.dense_rank().over(W.orderBy("line")), "_j": F.dense_rank().over(W.orderBy("pixel"))})
    known = ranks.where(F.col(value).isNotNull()).agg(F.collect_list(F.struct("_i", "_j", F.col(value).alias("v"))).alias("_known"))
    away = lambda x: (x["_i"] - F.col("_i")) * (x["_i"] - F.col("_i")) + (x["_j"] - F.col("_j")) * (x["_j"] - F.col("_j"))
    nearest = F.array_min(F.transform("_known", lambda x: F.struct(away(x).alias("d"), x["_i"].alias("i"), x["_j"].alias("j"), x["v"].alias("v"))))["v"]
    return ranks.join(F.broadcast(known)).select("line", "pixel", F.coalesce(value, nearest).alias(value))


def interpolated(points: DataFrame, value: str, height: int, width: int, otherwise: float) -> DataFrame:
    """(r, c, value) for all pixels of an image: bilinear between a grid's points (line, pixel, value), carried on beyond them.

    Pixels are dealt to the grid's cells by equality of lines and of columns. A grid of fewer than two lines or pixels, or
    without values, gives `otherwise` everywhere.
    """
    spark = points.sparkSession
    whole = spark.range(height).select(F.col("id").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("c"))
    n = points.agg(F.count_distinct("line").alias("l"), F.count_distinct("pixel").alias("p"), F.count(value).alias("v")).first()
    if n["l"] < 2 or n["p"] < 2 or not n["v"]:
        return whole.withColumn(value, F.lit(otherwise))
    known = filled_points(points, value)

    def cells(at: str, size: int, out: str) -> DataFrame:
        """(out, a, b): each line of the image with the two of the grid that it lies between."""
        w = W.orderBy(at)
        pairs = known.select(at).distinct().select(F.col(at).alias(f"{out}a"), F.lead(at).over(w).alias(f"{out}b"), F.lag(at).over(w).isNull().alias("first"), F.lead(at, 2).over(w).isNull().alias("last"))
        low = F.when(F.col("first"), F.lit(0)).otherwise(F.greatest(F.col(f"{out}a"), F.lit(0)))
        high = F.when(F.col("last"), F.lit(size - 1)).otherwise(F.least(F.col(f"{out}b") - 1, F.lit(size - 1)))
        inside = pairs.where(f"{out}b is not null").withColumns({"low": low, "high": high}).where("low <= high")
        return inside.select(F.explode(F.sequence("low", "high")).alias(out), f"{out}a", f"{out}b")

    # A cell of the grid has its four corners in one row.
    along, down = W.partitionBy("line").orderBy("pixel"), W.partitionBy("pixel").orderBy("line")
    corners = known.select("line", "pixel", F.col(value).alias("aa"), F.lead(value).over(along).alias("ab"))
    corners = corners.select(F.col("line").alias("ra"), F.col("pixel").alias("ca"), "aa", "ab", F.lead("aa").over(down).alias("ba"), F.lead("ab").over(down).alias("bb"))
    found = whole.join(cells("line", height, "r"), "r").join(cells("pixel", width, "c"), "c").join(corners, ["ra", "ca"])
    y, x = (F.col("r") - F.col("ra")) / (F.col("rb") - F.col("ra")), (F.col("c") - F.col("ca")) / (F.col("cb") - F.col("ca"))
    mix = lambda a, b, t: a * (1 - t) + b * t
    return found.select("r", "c", mix(mix(F.col("aa"), F.col("ab"), x), mix(F.col("ba"), F.col("bb"), x), y).alias(value))


#: The scale of stored backscatter, and degrees of incidence where nothing says them.
SCALE, INCIDENCE = 65535, 35.0


def terrain_corrected(image: DataFrame, height: int, width: int, look: Column, calibration: DataFrame | None = None, noise: DataFrame | None = None, incidence: DataFrame | None = None, terrain: DataFrame | None = None, angle: float = INCIDENCE) -> DataFrame:
    """(r, c, v) of a radar image (r, c, dn): calibrated, freed of terrain, as whole numbers of SCALE for 1; above 1 it is cut off.

    calibration and noise are tables of points (line, pixel, value), of which the nearest counts; noise is taken off the
    power, and without calibration the numbers stay as they are. incidence: points of degrees, between which it is
    bilinear; without them `angle`. terrain: r, c, slope and aspect in radians, where it is missing there is no change; look is
    the direction of view in radians. Slopes that turn too far away give 0, and so do points of calibration without a value.
    """
    keyed = image
    # What is a whole number but for the last bits of a double counts as that number.
    whole = lambda x: F.floor(F.round(x, 6)).cast("int")
    at = lambda points, name: nearest_values(points, "value", height, width).withColumnRenamed("value", name)
    gamma = F.col("dn").cast("double")
    if calibration is not None:
        keyed = keyed.join(at(calibration, "lut"), ["r", "c"])
        keyed = keyed.join(at(noise, "noise"), ["r", "c"]) if noise is not None else keyed.withColumn("noise", F.lit(0.0))
        gamma = F.coalesce(calibrated(gamma, F.col("noise"), F.col("lut")), F.lit(0.0))
    if terrain is not None:
        degrees = F.lit(angle)
        if incidence is not None:
            keyed = keyed.join(interpolated(incidence, "value", height, width, angle).withColumnRenamed("value", "degrees"), ["r", "c"])
            degrees = F.col("degrees")
        keyed = keyed.join(terrain.select("r", "c", "slope", "aspect"), ["r", "c"], "left")
        theta = F.radians(degrees)
        local = F.cos("slope") * F.cos(theta) + F.sin("slope") * F.sin(theta) * F.cos(F.col("aspect") - look)
        gamma = F.when(F.col("slope").isNull() | F.col("aspect").isNull(), gamma).otherwise(F.coalesce(flattened(gamma, F.cos(theta), local), F.lit(0.0)))
    return keyed.select("r", "c", whole(F.least(F.greatest(gamma, F.lit(0.0)), F.lit(1.0)) * SCALE).alias("v"))


def nearest_values(points: DataFrame, value: str, height: int, width: int) -> DataFrame:
    """(r, c, value) for all pixels of an image: the value of the nearest of some points (line, pixel, value) over 0.

    Down a column the nearest point on either side, then along the row the nearest of what its columns found: columns
    with points are few, so a row's list of them is small. Of points as near, the one with the least column, then line.
    Without points, 1 everywhere.
    """
    spark = points.sparkSession
    good = points.where((F.col(value) > 0) & (F.col("line") < height) & (F.col("pixel") < width) & (F.col("line") >= 0) & (F.col("pixel") >= 0))
    good = good.groupBy(F.col("line").alias("r"), F.col("pixel").alias("c")).agg(F.max(value).alias(value))
    columns = good.select("c").distinct().select("c", F.explode(F.sequence(F.lit(0), F.lit(height - 1))).alias("r"))
    down, back = (W.partitionBy("c").orderBy(order).rowsBetween(W.unboundedPreceding, 0) for order in (F.col("r"), F.desc("r")))
    at = F.when(F.col(value).isNotNull(), F.struct("r", value))
    up, low = F.max(at).over(down), F.min(at).over(back)
    near = columns.join(good, ["r", "c"], "left").withColumns({"_up": up, "_low": low})
    above = F.coalesce(F.col("r") - F.col("_up.r") <= F.col("_low.r") - F.col("r"), F.col("_up").isNotNull())
    found = near.select("r", F.struct("c", F.when(above, F.col("_up")).otherwise(F.col("_low")).alias("p")).alias("x")).groupBy("r").agg(F.collect_list("x").alias("_near"))
    whole = spark.range(height).select(F.col("id").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("c")).join(found, "r", "left")
    away = lambda x: (x["c"] - F.col("c")) * (x["c"] - F.col("c")) + (x["p"]["r"] - F.col("r")) * (x["p"]["r"] - F.col("r"))
    nearest = F.array_min(F.transform("_near", lambda x: F.struct(away(x).alias("d"), x["c"].alias("c"), x["p"]["r"].alias("r"), x["p"][value].alias("v"))))["v"]
    return whole.select("r", "c", F.coalesce(nearest, F.lit(1.0)).alias(value))


def covered_share(footprints: DataFrame, keys: list[str], box: Column) -> DataFrame:
    """(keys, share): the part of a box (struct of w, s, e, n) that the footprints (boxes w, s, e, n) of a group cover together.

    Between two neighbouring sides the covered height is the sum of what each footprint, in the order of its lower side,
    adds to those before it. A group is what covers one tile on one day.
    """
    cut = lambda c, f, g: f(g(F.col(c), box["w" if c in "we" else "s"]), box["e" if c in "we" else "n"]).alias(c)
    inside = footprints.select(*keys, *[cut(c, F.least, F.greatest) for c in ("w", "s", "e", "n")], box.alias("_box"))
    real = inside.where("w < e and s < n")
    sides = real.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("w", "e"))))).alias("_x"))
    slabs = sides.select(*keys, F.explode(F.arrays_zip(F.slice("_x", F.lit(1), F.size("_x") - 1).alias("a"), F.slice("_x", F.lit(2), F.size("_x") - 1).alias("b"))).alias("_s")).select(*keys, "_s.a", "_s.b")
    within = slabs.join(real, keys).where("w <= a and e >= b")
    before = F.max("n").over(W.partitionBy(*keys, "a").orderBy("s", "n").rowsBetween(W.unboundedPreceding, -1))
    added = within.withColumn("_added", F.greatest(F.col("n") - F.greatest(F.col("s"), F.coalesce(before, F.col("s"))), F.lit(0.0)) * (F.col("b") - F.col("a")))
    area = (F.col("_box.e") - F.col("_box.w")) * (F.col("_box.n") - F.col("_box.s"))
    sums = added.groupBy(*keys).agg(F.try_divide(F.sum("_added"), F.max(area)).alias("share"))
    return footprints.select(*keys).distinct().join(sums, keys, "left").withColumn("share", F.coalesce("share", F.lit(0.0)))


def footprint_coverage(footprints: DataFrame, day: str, side: float, geom: str = "geom") -> DataFrame:
    """(day, x_tile, y_tile, share): the part of each tile (a square of side `side`) that the union of a day's footprints covers.

    footprints: polygons as well-known binary in the tiles' units. Tiles that a day's footprints don't enter have no row.
    """
    found = overlay.square_unions(footprints, day, side, geom).where("area > 0")
    return found.select(F.col("g").alias(day), F.col("i").alias("x_tile"), F.col("j").alias("y_tile"), (F.col("area") / (side * side)).alias("share"))
