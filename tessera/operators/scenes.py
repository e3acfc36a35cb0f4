"""Choosing among satellite scenes of a tile (columns scene_id, tile, acquired, cloud, local_cloud, coverage, orbit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Limits of cloud, scenes for each month and in all, coverage that is enough, days that are near.
HARD_DROP, MODERATE, FINAL_MAX, BETTER_BY = 0.50, 0.30, 0.40, 0.20
PER_MONTH, IN_ALL, ENOUGH, NEAR_DAYS = 2, 24, 0.95, 3


def month(c: str = "acquired") -> Column:
    return F.year(c) * 100 + F.month(c)


def score() -> Column:
    """Cloud, for cloudier scenes mostly that of the centre."""
    return F.when(F.col("cloud") > MODERATE, 0.25 * F.col("cloud") + 0.75 * F.col("local_cloud")).otherwise(F.col("cloud"))


def clear(scenes: DataFrame) -> DataFrame:
    """Scenes within the cloud limits for which the tile's month has no much clearer centre, with their score."""
    least = F.min("local_cloud").over(W.partitionBy("tile", month()))
    marked = scenes.withColumns({"score": score(), "least": least})
    return marked.where((F.col("cloud") <= HARD_DROP) & (F.col("score") <= FINAL_MAX) & ~(F.col("least") < F.col("local_cloud") - BETTER_BY)).drop("least")


def chosen(clear_scenes: DataFrame) -> DataFrame:
    """Up to IN_ALL scenes of a tile and year: the best PER_MONTH of each month first, then the best of the others."""
    rank = F.row_number().over(W.partitionBy("tile", month()).orderBy("score", "scene_id"))
    first = clear_scenes.withColumn("later", (rank > PER_MONTH).cast("int"))
    place = F.row_number().over(W.partitionBy("tile", F.year("acquired")).orderBy("later", "score", "scene_id"))
    return first.withColumn("place", place).where(F.col("place") <= IN_ALL).drop("later")


def nearest(steps: DataFrame, scenes: DataFrame) -> DataFrame:
    """For each (tile, step date) the nearest scene within NEAR_DAYS, by coverage where several are as near.

    Where the coverage of that one isn't enough, one within a day whose is enough takes its place. Scenes are spread
    over the days that they are near to, so the join is by equality of days.
    """
    spread = scenes.select("tile", "scene_id", "coverage", "acquired", F.explode(F.sequence(F.lit(1 - NEAR_DAYS), F.lit(NEAR_DAYS - 1))).alias("off"))
    near = steps.join(spread.select("tile", "scene_id", "coverage", F.date_add("acquired", F.col("off")).alias("step"), F.abs("off").alias("days")), ["tile", "step"])
    behind = -F.col("coverage")
    enough = (F.col("days") <= 1) & (F.col("coverage") >= ENOUGH)
    best = near.groupBy("tile", "step").agg(
        F.min(F.struct("days", behind.alias("behind"), "scene_id")).alias("first"), F.min(F.when(enough, F.struct(behind.alias("behind"), "days", "scene_id"))).alias("other")
    )
    pick = lambda c: F.when((-F.col("first.behind") < ENOUGH) & F.col("other").isNotNull(), F.col(f"other.{c}")).otherwise(F.col(f"first.{c}"))
    return best.select("tile", "step", pick("scene_id").alias("scene_id"), pick("days").alias("days"), (-pick("behind")).alias("coverage"))


def better_within(scenes: DataFrame, days: int = 30, by: float = BETTER_BY) -> DataFrame:
    """Scenes with `alternative`: whether a clearer one is within some days on either side."""
    day = F.datediff("acquired", F.lit("1970-01-01"))
    least = F.min("cloud").over(W.partitionBy("tile").orderBy(day).rangeBetween(-days, days))
    return scenes.withColumn("alternative", least < F.col("cloud") - by)


def quarter_days(scenes: DataFrame, k: int = 2, threshold: float = ENOUGH) -> DataFrame:
    """The k days of the greatest coverage of each tile and quarter; a day under the threshold only if it is the best."""
    days = scenes.groupBy("tile", F.year("acquired").alias("year"), F.quarter("acquired").alias("quarter"), "acquired").agg(F.max("coverage").alias("coverage"))
    rank = F.row_number().over(W.partitionBy("tile", "year", "quarter").orderBy(F.desc("coverage"), "acquired"))
    return days.withColumn("rank", rank).where((F.col("rank") <= k) & ((F.col("coverage") >= threshold) | (F.col("rank") == 1)))


def orbit_of(scenes: DataFrame, k: int = 2, threshold: float = ENOUGH) -> DataFrame:
    """The orbit of each tile and year with the most qualifying days (at most k a quarter), then the most scenes; ties: ascending."""
    by_quarter = scenes.groupBy("tile", F.year("acquired").alias("year"), "orbit", F.quarter("acquired").alias("q")).agg(
        F.countDistinct(F.when(F.col("coverage") >= threshold, F.col("acquired"))).alias("days"), F.count("*").alias("n")
    )
    whole = by_quarter.groupBy("tile", "year", "orbit").agg(F.sum(F.least("days", F.lit(k))).alias("qualifying"), F.sum("n").alias("raw"))
    rank = F.row_number().over(W.partitionBy("tile", "year").orderBy(F.desc("qualifying"), F.desc("raw"), "orbit"))
    return whole.withColumn("rank", rank).where("rank = 1").drop("rank")


def class_shares(pixels: DataFrame, image: str, code: str, top: int = 4) -> DataFrame:
    """The `top` most frequent classes of each image with their share."""
    n = pixels.groupBy(image, code).agg(F.count("*").alias("n"))
    share = n.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy(image)), 6))
    return share.withColumn("rank", F.row_number().over(W.partitionBy(image).orderBy(F.desc("n"), code))).where(F.col("rank") <= top)


def of_orbit(scenes: DataFrame, orbit: str = "BOTH") -> DataFrame:
    """Scenes of ASC(ending) or DESC(ending) orbits, or of BOTH."""
    wanted = {"ASC": ["ascending"], "DESC": ["descending"], "BOTH": ["ascending", "descending"]}
    return scenes.where(F.col("orbit").isin(*wanted[orbit.upper()]))


def quarter_scenes(scenes: DataFrame, k: int = 1, threshold: float = ENOUGH) -> DataFrame:
    """The k scenes of the greatest coverage of each tile and quarter (ties: the earlier, then the lesser id); one under the
    threshold only if it is the best."""
    by = W.partitionBy("tile", F.year("acquired"), F.quarter("acquired")).orderBy(F.desc("coverage"), "acquired", "scene_id")
    ranked = scenes.withColumn("rank", F.row_number().over(by))
    return ranked.where((F.col("rank") <= k) & ((F.col("coverage") >= threshold) | (F.col("rank") == 1)))


#: Fixed value: the greatest share of bad pixels that an image may have.
BAD_SHARE = 0.20


def usable(pixels: DataFrame, image: str, bad: Column, most: float = BAD_SHARE) -> DataFrame:
    """(image, bad): images of which at most a share of the pixels is bad."""
    return pixels.groupBy(image).agg(F.avg(bad.cast("double")).alias("bad")).where(F.col("bad") <= most)
