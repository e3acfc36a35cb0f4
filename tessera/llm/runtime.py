"""Shared folder, written intermediate tables and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a new local one if all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The intermediate tables of one operator's run, in a folder of their own, dropped once nothing reads them any more.

    Tables that the run's result is read from stay; the folder is the caller's to expire.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, shared_path(spark, name)

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Like `written`, with the writer's options; the name must be new within the run."""
        df.write.options(**options).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def is_small(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint if df, which should be a written table of narrow rows, has at most max_rows rows; else df as it is."""
    return F.broadcast(df) if is_small(df, max_rows) else df


#: Of n rows, keys with more than n / HOT_SHARE are spread: fewer than HOT_SHARE keys can be so common.
HOT_SHARE = 1000


def looked_up(rows: DataFrame, facts: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """rows joined with what facts, a row or a few, has for its key, however many rows share a key.

    The facts of the commonest keys are copied, a copy for each n / HOT_SHARE of the n rows, so there are fewer than
    2 * HOT_SHARE copies in all; a row of such a key meets one of them by a hash of the row. rows should be a written table.
    Rows without facts, or with a null key, are left out.
    """
    share = rows.count() // HOT_SHARE + 1
    common = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > share).select(key, F.ceil(F.col("n") / share).alias("copies"))
    common = F.broadcast(scratch.table(common, f"common-{uuid.uuid4().hex[:8]}"))
    copies = F.coalesce("copies", F.lit(1))
    spread = rows.join(common, key, "left").withColumn("copy", F.pmod(F.xxhash64(*rows.columns), copies)).drop("copies")
    facts = facts.join(common, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("copies")
    return spread.join(facts, [key, "copy"]).drop("copy")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
