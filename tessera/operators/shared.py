"""Tables in the folder that driver and executors share, and exact ranks without one task that sees all rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A group's values are cut into so many ranges; only those that hold a wanted rank are sorted.
RANGES = 64


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a new local folder if all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Saved:
    """Tables of one run in the shared folder, dropped once nothing reads them any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """df with n = 0, 1, ... in a global order: ranges of rows are sorted each by itself, then take their offsets.

    The sorted rows are written to the shared folder, as the ranges that Spark samples differ from run to run.
    """
    saved = Saved(df.sparkSession, "numbered")
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = saved.table(rows.select("*", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_own")), "rows")
    counts = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = counts.select("_part", (F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")).alias("_before"))  # a row for each range
    return rows.join(F.broadcast(before), "_part").withColumn("n", F.col("_before") + F.col("_own")).drop("_at", "_part", "_own", "_before")


def ranked(values: DataFrame, groups: list[str], value: str, wanted: Column) -> DataFrame:
    """(groups, n, rank, value): the values at the wanted places (an array made from n, counted from 0) of each group's order.

    Approximate quantiles cut a group's values into RANGES ranges, whose counts say which ranges hold a wanted place;
    only those are sorted, each by a task of its own. Equal values are counted before they are gathered. Nulls are left out.
    """
    keys = groups or ["_all"]
    data = values.where(F.col(value).isNotNull())
    if not groups:
        data = data.withColumn("_all", F.lit(0))
    counts = data.groupBy(*keys, value).agg(F.count("*").alias("_rows"))
    cuts = data.groupBy(*keys).agg(F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 10_000).alias("_cuts"))
    placed = counts.join(cuts, keys).withColumn("_range", F.size(F.filter("_cuts", lambda x: x < F.col(value)))).drop("_cuts")
    sums = placed.groupBy(*keys, "_range").agg(F.sum("_rows").alias("_rows"))
    by = Window.partitionBy(*keys)
    before = sums.select(*keys, "_range", F.sum("_rows").over(by).alias("n"), F.sum("_rows").over(by.orderBy("_range")).alias("_upto"), F.col("_rows").alias("_in"))
    held = before.withColumn("_ranks", F.filter(wanted, lambda x: (x < F.col("_upto")) & (x >= F.col("_upto") - F.col("_in")))).where(F.size("_ranks") > 0)
    found = placed.join(held.select(*keys, "_range", "n", "_ranks", (F.col("_upto") - F.col("_in")).alias("_start")), [*keys, "_range"])
    upto = F.col("_start") + F.sum("_rows").over(Window.partitionBy(*keys, "_range").orderBy(value))
    each = found.withColumn("_upto", upto).withColumn("rank", F.explode("_ranks")).where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_rows")))
    return each.select(*groups, "n", "rank", value)


def percentiles(values: DataFrame, groups: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(groups, a column for each of shares): percentiles, interpolated between the two values beside their place."""
    at = lambda q: F.floor(q * (F.col("n") - 1)).cast("long")
    wanted = F.array_distinct(F.concat(*[F.array(at(q), F.least(at(q) + 1, F.col("n") - 1)) for q in shares.values()]))
    found = ranked(values, groups, value, wanted)
    pick = lambda rank: F.max(F.when(F.col("rank") == rank, F.col(value).cast("double")))
    sides = [x for name, q in shares.items() for x in (pick(at(q)).alias(f"_lo_{name}"), pick(F.least(at(q) + 1, F.col("n") - 1)).alias(f"_hi_{name}"))]
    wide = found.groupBy(*groups, "n").agg(*sides)
    between = lambda name, q: F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (q * (F.col("n") - 1) - at(q))
    return wide.select(*groups, *[between(name, q).alias(name) for name, q in shares.items()])
