"""Rows in a global order of an id, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import written

#: Rows are cut into ranges of the id of about this weight (bytes of text, say), and at most MAX_RANGES of them.
RANGE_WEIGHT, MAX_RANGES = 4 << 20, 10_000


def range_of(value: Column, bounds: list) -> Column:
    """The number of the (bounded) list of bounds that are below value; null ids come first."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b) for b in bounds])

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        low, high = F.get(array, mid) < value, F.get(array, mid) >= value
        return F.when(s["lo"] < s["hi"], F.struct(F.when(low, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(high, mid).otherwise(s["hi"]).alias("hi"))).otherwise(s)

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    lo_hi = F.aggregate(F.array_repeat(F.lit(0), len(bounds).bit_length() + 1), start, halve)
    return F.when(value.isNull(), F.lit(0)).otherwise(lo_hi["lo"])


def bounds_for(light: DataFrame, id_col: str, weight: str) -> list:
    """Ids between ranges of near equal weight, from approximate quantiles: they only set task sizes."""
    n = light.agg(F.sum(weight).alias("w"), F.count("*").alias("n")).first()
    ranges = int(min(MAX_RANGES, max(1, (n["w"] or 0) // RANGE_WEIGHT), max(1, n["n"] // 4)))
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = light.agg(F.percentile_approx(id_col, F.array(*map(F.lit, shares)), F.lit(20 * ranges)).alias("q")).first()["q"]
    return sorted(set(found or []))


def prefix_sums(light: DataFrame, id_col: str, value: str, bounds: list, order: list[str]) -> DataFrame:
    """light with `start`: the sum of `value` over all rows before it in the order of id_col, then `order`.

    Sums of ranges are added up first (a row for each), then rows within each range.
    """
    ranged = written(light.withColumn("range", range_of(F.col(id_col), bounds)), "ranged")
    totals = ranged.groupBy("range").agg(F.sum(value).alias("total"))
    before = totals.withColumn("before", F.sum("total").over(Window.orderBy("range")) - F.col("total")).drop("total")
    within = F.sum(value).over(Window.partitionBy("range").orderBy(F.col(id_col).asc_nulls_first(), *order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    return ranged.withColumn("within", within).join(F.broadcast(before), "range").withColumn("start", F.col("before") + F.col("within")).drop("range", "before", "within")
