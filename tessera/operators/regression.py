"""Gaps of cloudy images from the mosaic: non-negative least squares for each image and band, on a balanced sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tessera.functions.spectral import evi, normalised_difference, snow

from .shared import Saved

#: Bands, and features: the mosaic's bands and snow.
BANDS, FEATURES = 10, 11
#: An image with so many clear pixels is fitted by itself; most samples; how often the greenest and the barest count
#: besides; the limits of clipped features; the least share of an image that must be in part clear.
ENOUGH, MOST, EXTREME, LOW, HIGH, LEAST_SHARE = 40_000, 90_000, 10, 0.005, 1.0, 0.01
#: Shares of the vegetation index between parts of the sample, and beyond which pixels are extreme.
CUTS = {"_20": 0.2, "_40": 0.4, "_60": 0.6, "_80": 0.8, "_2": 0.02, "_98": 0.98}
#: In sums: all features, the mosaic's bands clipped, then the targets.
CLIPPED, TARGETS = FEATURES, FEATURES + BANDS
WIDTH = TARGETS + BANDS


def places(pixels: DataFrame) -> DataFrame:
    """(tile, r, c, water, snow): whether a pixel is water by the medians of its bands, and in which share of images it is snow."""
    b = [F.col(f"b{i}") for i in range(BANDS)]
    ndwi = normalised_difference(F.median(b[1]), F.median(b[3]))
    return pixels.groupBy("tile", "r", "c").agg(F.coalesce(ndwi > 0, F.lit(False)).alias("water"), F.avg(snow(b[0], b[1], b[2], b[3], b[8]).cast("double")).alias("snow"))


def fitted_images(pixels: DataFrame) -> DataFrame:
    """(tile, date, t): for each image `date` with gaps (interp over 0) and clear pixels, the images t that it is fitted on.

    That is itself where it has more than ENOUGH clear pixels, else also its neighbours, for the last one the two before it.
    """
    clear, gap, part = (F.count_if(F.col("interp") == 0), F.count_if(F.col("interp") > 0), F.avg((F.col("interp") < 1).cast("int")))
    images = pixels.groupBy("tile", "t").agg(clear.alias("clear"), ((clear > 0) & (gap > 0) & (part > LEAST_SHARE)).alias("fitted"))
    by = W.partitionBy("tile")
    images = images.withColumns({"at": F.row_number().over(by.orderBy("t")), "of": F.count("*").over(by)})
    last, alone = F.col("at") == F.col("of"), F.col("clear") > ENOUGH
    low = F.greatest(F.when(alone, F.col("at")).when(last, F.col("at") - 2).otherwise(F.col("at") - 1), F.lit(1))
    high = F.when(alone | last, F.col("at")).otherwise(F.col("at") + 1)
    dates = images.where("fitted").select("tile", F.col("t").alias("date"), F.explode(F.sequence(low, high)).alias("at"))
    return dates.join(images.select("tile", "at", "t"), ["tile", "at"]).select("tile", "date", "t")


def cut(q: float, by: W) -> Column:
    """The percentile q of evi in each window, between the values at the two places beside it. An image's rows are sorted once for all
    of them, and are gathered for the sample's fifths anyway."""
    at = F.floor(q * (F.col("n") - 1)).cast("long")
    value = lambda place: F.max(F.when(F.col("place") == place, F.col("evi"))).over(by)
    low, high = value(at), value(F.least(at + 1, F.col("n") - 1))
    return low + (high - low) * (q * (F.col("n") - 1) - at)


def samples(pixels: DataFrame, ground: DataFrame, order: Column | None = None) -> DataFrame:
    """(tile, date, weight, x, y): clear pixels off water on which each image is fitted.

    ground: tile, r, c, the mosaic m0 to m9, water and snow. x has the mosaic and snow, y the image's bands. Of each
    fifth of the pixels by vegetation, a fifth of MOST or of all pixels count once, the first by `order` (a hash of the
    pixel); beyond that the two per cent with the least and with the greatest index count EXTREME times each.
    """
    own = fitted_images(pixels)
    near = pixels.where("interp = 0").join(ground.where(~F.col("water")), ["tile", "r", "c"]).join(own, ["tile", "t"])
    order = F.xxhash64("tile", "t", "r", "c") if order is None else order
    x, y = F.array(*[F.col(f"m{i}").cast("double") for i in range(BANDS)], F.col("snow").cast("double")), F.array(*[F.col(f"b{i}").cast("double") for i in range(BANDS)])
    rows = near.select("tile", "date", "t", "r", "c", order.alias("order"), evi(F.col("b0"), F.col("b2"), F.col("b3")).alias("evi"), x.alias("x"), y.alias("y")).where("evi is not null")
    by = W.partitionBy("tile", "date")
    placed = rows.withColumns({"n": F.count("*").over(by), "place": F.row_number().over(by.orderBy("evi")) - 1})
    fifth = sum(((F.col("evi") >= F.col(c)).cast("int") for c in ("_40", "_60", "_80")), (F.col("evi") >= F.col("_20")).cast("int"))
    ranked = placed.withColumns({name: cut(q, by) for name, q in CUTS.items()}).withColumn("fifth", fifth)
    rank = F.row_number().over(W.partitionBy("tile", "date", "fifth").orderBy("order", "t", "r", "c"))
    once = (rank <= F.floor(F.least(F.col("n"), F.lit(MOST)) / 5)).cast("int")
    extreme = EXTREME * ((F.col("evi") < F.col("_2")).cast("int") + (F.col("evi") >= F.col("_98")).cast("int"))
    return ranked.withColumn("weight", once + extreme).where("weight > 0").select("tile", "date", "weight", "x", "y")


def product_sums(sampled: DataFrame) -> DataFrame:
    """(tile, date, i, j, s): weighted sums of products, i over features and clipped features, j over these and the targets.

    Each task adds up its own rows as products of matrices; a row for each of them and image is shuffled.
    """
    kinds = sampled.schema["tile"].dataType.simpleString(), sampled.schema["date"].dataType.simpleString()

    def partial(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            tile, date = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
            code = tile.indices.to_numpy().astype(np.int64) * len(date.dictionary) + date.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)[order]
            y = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)[order]
            weight = batch.column(2).to_numpy()[order]
            left = np.hstack([x, np.clip(x[:, :BANDS], LOW, HIGH)])
            whole = np.hstack([left, y])
            used, first = np.unique(code[order], return_index=True)
            ends = np.append(first[1:], len(order))
            sums = [((left[a:b] * weight[a:b, None]).T @ whole[a:b]).ravel() for a, b in zip(first, ends, strict=True)]
            at = pa.array(order[first])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * TARGETS * WIDTH), pa.array(np.concatenate(sums)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), lists], names=["tile", "date", "sums"])

    parts = sampled.select("tile", "date", "weight", "x", "y").mapInArrow(partial, f"tile {kinds[0]}, date {kinds[1]}, sums array<double>")
    each = parts.select("tile", "date", F.posexplode("sums").alias("at", "s")).groupBy("tile", "date", "at").agg(F.sum("s").alias("s"))
    return each.select("tile", "date", F.floor(F.col("at") / WIDTH).cast("int").alias("i"), (F.col("at") % WIDTH).alias("j"), "s")


def features_of(band: int) -> list[int]:
    """The places in sums of a band's features: those of lower bands are clipped."""
    return [CLIPPED + j if j < band else j for j in range(BANDS)] + [BANDS]


def band_sums(sums: DataFrame) -> DataFrame:
    """(tile, date, band, i, s0 to s10, y): the normal equations of each image and band, a row for each of their rows."""
    wide = sums.groupBy("tile", "date", "i").agg(F.map_from_entries(F.collect_list(F.struct("j", "s"))).alias("row"))
    rows = [F.struct(F.lit(b).alias("band"), F.lit(k).alias("i"), F.lit(at).alias("at"), F.array(*map(F.lit, features_of(b))).alias("of")) for b in range(BANDS) for k, at in enumerate(features_of(b))]
    each = wide.withColumn("e", F.explode(F.filter(F.array(*rows), lambda e: e["at"] == F.col("i"))))
    return each.select("tile", "date", "e.band", "e.i", *[F.element_at("row", F.get("e.of", F.lit(j))).alias(f"s{j}") for j in range(FEATURES)], F.element_at("row", F.col("e.band") + TARGETS).alias("y"))


def nonnegative(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """x of at least 0 with the least x'gx / 2 - h'x, by an active set: variables enter by their slope, and leave where a step to
    the free ones' solution would make them negative."""
    n = len(h)
    x, free = np.zeros(n), np.zeros(n, bool)
    least = 1e-10 * max(1.0, np.abs(h).max(initial=0))
    for _ in range(10 * n):  # each entry lowers the objective, so sets don't return; the bound is for rounding
        slope = np.where(free, -np.inf, h - g @ x)
        if slope.max() <= least:
            break
        free[slope.argmax()] = True
        while free.any():
            s = np.zeros(n)
            s[free] = np.linalg.lstsq(g[np.ix_(free, free)], h[free], rcond=1e-12)[0]
            bad = free & (s <= 0)
            if not bad.any():
                x = s
                break
            step = (x[bad] / np.maximum(x[bad] - s[bad], 1e-300)).min()
            x = x + step * (s - x)
            free &= (x > 1e-12) & ~(bad & (x <= 1e-12))
            x[~free] = 0
    return x


def coefficients(sums: DataFrame) -> DataFrame:
    """(tile, date, coef): for each image the coefficients of all bands, FEATURES for each, one band after the other.

    Whole systems of one image, 21 x 31 numbers, are gathered and solved in batches.
    """
    whole = sums.groupBy("tile", "date").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "j", "s"))), lambda e: e["s"]).alias("s"))
    kinds = sums.schema["tile"].dataType.simpleString(), sums.schema["date"].dataType.simpleString()

    def solve(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for s in batch.column(2).to_pylist():
                m = np.array(s).reshape(TARGETS, WIDTH)
                found.append(np.concatenate([nonnegative(m[np.ix_(features_of(b), features_of(b))], m[features_of(b), TARGETS + b]) for b in range(BANDS)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.tolist() for f in found], pa.list_(pa.float64()))], names=["tile", "date", "coef"])

    return whole.mapInArrow(solve, f"tile {kinds[0]}, date {kinds[1]}, coef array<double>")


def filled(pixels: DataFrame, ground: DataFrame, coef: DataFrame) -> DataFrame:
    """pixels with b0 to b9 blended, by interp, with what the mosaic gives there: its bands times the image's coefficients, or as
    they are where the image has none."""
    x = [F.col(f"m{i}") for i in range(BANDS)] + [F.col("snow")]
    fit = lambda b: sum((F.get("coef", F.lit(b * FEATURES + j)) * x[j] for j in range(1, FEATURES)), F.get("coef", F.lit(b * FEATURES)) * x[0])
    value = lambda b: F.when(F.col("interp") > 0, F.col(f"b{b}") * (1 - F.col("interp")) + F.coalesce(fit(b), x[b]) * F.col("interp")).otherwise(F.col(f"b{b}"))
    both = pixels.join(ground.drop("water"), ["tile", "r", "c"], "left").join(coef.withColumnRenamed("date", "t"), ["tile", "t"], "left")
    return both.select(*[value(int(c[1:])).alias(c) if c in {f"b{i}" for i in range(BANDS)} else F.col(c) for c in pixels.columns])


def regression_filled(pixels: DataFrame, ground: DataFrame, order: Column | None = None) -> DataFrame:
    """`filled` by the coefficients that `samples` give; the systems of equations are written before they are solved."""
    sums = Saved(pixels.sparkSession, "regression").table(product_sums(samples(pixels, ground, order)), "sums")
    return filled(pixels, ground, coefficients(sums))
