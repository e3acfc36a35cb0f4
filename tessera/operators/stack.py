"""From band, radar and elevation pixels to the frames and channels that a model reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.spectral import brightness, evi, grndvi, msavi2

BANDS = [f"b{i}" for i in range(10)]
INDICES = ["evi", "bi", "msavi2", "grndvi"]
#: Fixed order of the 17 channels: ten bands, elevation, two radar bands, four indices.
CHANNELS = [*BANDS, "dem", "vv", "vh", *INDICES]


def resized(pixels: DataFrame, value: str, sizes: DataFrame, tile: str = "tile") -> DataFrame:
    """(tile, r, c, value) at the sizes (tile, h, w, to_h, to_w) by bilinear interpolation between pixel centres; edges repeat.

    A pixel gives each output near it a weight, and outputs add up what they get: no pixel looks for its neighbours.
    """

    def spread(at: str, n: str, to: str) -> Column:
        scale = F.col(to) / F.col(n)
        first, last = F.floor((F.col(at) - 0.5) * scale - 0.5), F.ceil((F.col(at) + 1.5) * scale - 0.5)
        outs = F.sequence(F.greatest(first, F.lit(0)).cast("int"), F.least(last, F.col(to) - 1).cast("int"))

        def weight(o: Column) -> Column:
            y = F.least(F.greatest((o + 0.5) / scale - 0.5, F.lit(0.0)), F.col(n) - 1.0)
            return F.struct(o.alias("to"), F.greatest(1 - F.abs(y - F.col(at)), F.lit(0.0)).alias("w"))

        return F.filter(F.transform(outs, weight), lambda x: x["w"] > 0)

    each = pixels.join(sizes, tile).select(tile, value, spread("r", "h", "to_h").alias("_r"), spread("c", "w", "to_w").alias("_c"))
    out = each.select(tile, value, F.explode("_r").alias("_r"), "_c").select(tile, value, "_r", F.explode("_c").alias("_c"))
    return out.groupBy(tile, F.col("_r.to").alias("r"), F.col("_c.to").alias("c")).agg(F.sum(F.col(value) * F.col("_r.w") * F.col("_c.w")).alias(value))


def sizes_of(pixels: DataFrame, factor: int, tile: str = "tile") -> DataFrame:
    size = pixels.groupBy(tile).agg((F.max("r") + 1).alias("h"), (F.max("c") + 1).alias("w"))
    return size.select(tile, "h", "w", (F.col("h") * factor).alias("to_h"), (F.col("w") * factor).alias("to_w"))


def zoomed(pixels: DataFrame, value: str, factor: int, tile: str = "tile") -> DataFrame:
    return resized(pixels, value, sizes_of(pixels, factor, tile), tile)


def short_wave_doubled(pixels: DataFrame, value: str, tile: str = "tile") -> DataFrame:
    """A short-wave band at twice its rows and columns: means of blocks of 2 x 2 first, as it was seen coarser.

    Where a side is odd, its first line is no part of a block: it fills the first output line (the first column over
    the first row), each pixel twice as far as there is room, and the blocks the others.
    """
    size = pixels.groupBy(tile).agg((F.max("r") + 1).alias("_h"), (F.max("c") + 1).alias("_w")).select(tile, "_h", "_w", (F.col("_h") % 2).alias("_or"), (F.col("_w") % 2).alias("_oc"))
    sized = pixels.join(size, tile)
    inner = sized.where("r >= _or and c >= _oc")
    block = lambda at, odd: F.floor((F.col(at) - F.col(odd)) / 2).cast("int").alias(at)
    means = inner.groupBy(tile, block("r", "_or"), block("c", "_oc")).agg(F.avg(value).alias(value))
    half = size.select(tile, *[F.floor((F.col(f"_{x}") - F.col(o)) / 2).alias(x) for x, o in (("h", "_or"), ("w", "_oc"))], (2 * F.col("_h") - F.col("_or")).alias("to_h"), (2 * F.col("_w") - F.col("_oc")).alias("to_w"))
    blocks = resized(means, value, half, tile).join(size, tile).select(tile, (F.col("r") + F.col("_or")).cast("int").alias("r"), (F.col("c") + F.col("_oc")).cast("int").alias("c"), value)
    twice = lambda at: F.explode(F.array(2 * F.col(at), 2 * F.col(at) + 1)).alias(at)
    column = sized.where("_oc = 1 and c = 0").select(tile, twice("r"), F.lit(0).alias("c"), value)
    row = sized.where("_or = 1 and r = 0").select(tile, "_oc", F.lit(0).alias("r"), twice("c"), value).where("not (_oc = 1 and c = 0)").drop("_oc")
    return blocks.unionByName(column).unionByName(row)


def unsaturated(radar: DataFrame, value: str, image: list[str]) -> DataFrame:
    """Values of 1 (saturated) replaced by the median of their image's others; null where it has none."""
    middle = radar.groupBy(*image).agg(F.median(F.when(F.col(value) != 1, F.col(value))).alias("_middle"))
    return radar.join(middle, image).withColumn(value, F.when(F.col(value) == 1, F.col("_middle")).otherwise(F.col(value))).drop("_middle")


def index_map(n: int, to: int) -> list[int | None]:
    """For each of `to` lines the line of n that it shows, None for an empty one.

    Too few lines get half of those that lack on either side (one before all if only one does), which repeat the edge;
    of too many half of those over are cut off on either side. What then lacks or is over goes by the middle, empty.
    """
    half = abs(to - n) // 2
    if n < to:
        lines = [0] * max(half, 1) + list(range(n)) + [n - 1] * half
    elif n > to:
        lines = list(range(half, n - half)) if half else list(range(1, n))
    else:
        lines = list(range(n))
    cut = max(0, (len(lines) - to) // 2)
    lines = lines[cut : cut + to]
    lack = to - len(lines)
    return [None] * (lack // 2) + lines + [None] * (lack - lack // 2)


def aligned(pixels: DataFrame, value: str, size: tuple[int, int], to: tuple[int, int], empty: float = 0.0, tile: str = "tile") -> DataFrame:
    """Rasters of one size (rows, columns) brought to another by `index_map`, whose tables have a row for each line."""
    spark, keys = pixels.sparkSession, [c for c in pixels.columns if c not in ("r", "c", value)]
    table = lambda n, m, out, at: spark.createDataFrame(list(enumerate(index_map(n, m))), f"{out} int, {at} int")
    grid = pixels.select(*keys).distinct().join(F.broadcast(table(size[0], to[0], "_r", "r"))).join(F.broadcast(table(size[1], to[1], "_c", "c")))
    found = grid.join(pixels, [*keys, "r", "c"], "left").withColumn(value, F.coalesce(F.when(F.col("r").isNotNull() & F.col("c").isNotNull(), F.col(value)), F.lit(empty)))
    return found.select(*keys, F.col("_r").alias("r"), F.col("_c").alias("c"), value)


def zeros_filled(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values of 0 replaced by the median over time of the pixel's others, 0 where it has none."""
    middle = series.groupBy(*keys).agg(F.median(F.nullif(F.col(value), F.lit(0.0))).alias("_middle"))
    return series.join(middle, keys).withColumn(value, F.when(F.col(value) == 0, F.coalesce("_middle", F.lit(0.0))).otherwise(F.col(value))).drop("_middle")


def with_indices(pixels: DataFrame) -> DataFrame:
    b, g, r, n, s = (F.col(f"b{i}") for i in (0, 1, 2, 3, 8))
    return pixels.withColumns({"evi": evi(b, r, n), "bi": brightness(b, r, n, s), "msavi2": msavi2(r, n), "grndvi": grndvi(g, r, n)})


def feature_stack(smooth: DataFrame, raw: DataFrame, radar: DataFrame, dem: DataFrame, pixel: list[str]) -> DataFrame:
    """(pixel, frame, CHANNELS): four quarters and, as frame 4, the whole year.

    smooth: bands b0 to b9 for each pixel and month (0 to 11), raw: the same for each image, radar: vv and vh for each
    month, dem: dem for each pixel. A quarter's bands, indices and radar are medians of its three months; the year's are
    medians of the images, and of the months for radar. Elevation is the same in all frames.
    """
    quarter = F.floor(F.col("month") / 3).cast("int").alias("frame")
    middle = lambda names: [F.median(c).alias(c) for c in names]
    quarters = with_indices(smooth).groupBy(*pixel, quarter).agg(*middle([*BANDS, *INDICES]))
    year = with_indices(raw).groupBy(*pixel).agg(*middle([*BANDS, *INDICES])).withColumn("frame", F.lit(4))
    radars = radar.groupBy(*pixel, quarter).agg(*middle(["vv", "vh"])).unionByName(radar.groupBy(*pixel).agg(*middle(["vv", "vh"])).withColumn("frame", F.lit(4)))
    return quarters.unionByName(year).join(radars, [*pixel, "frame"]).join(dem, pixel).select(*pixel, "frame", *CHANNELS)
