"""Which expected objects exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import source_key


def expected_keys(tiles: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """A row for each tile-year and source, with its object key."""
    parts = [F.struct(F.lit(s).alias("source"), source_key(s, F.col("year"), F.col("x_tile"), F.col("y_tile")).alias("object_key")) for s in sources]
    return tiles.select("year", "x_tile", "y_tile", F.explode(F.array(*parts)).alias("k")).select("year", "x_tile", "y_tile", "k.*")


def presence(tiles: DataFrame, inventory: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """expected_keys with `there`. The inventory is a relation of keys, so there are no requests that can fail."""
    keys = inventory.select("object_key").distinct().withColumn("there", F.lit(True))
    return expected_keys(tiles, sources).join(keys, "object_key", "left").withColumn("there", F.coalesce("there", F.lit(False)))


def availability(tiles: DataFrame, inventory: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """Each tile-year and whether all its sources exist."""
    return presence(tiles, inventory, sources).groupBy("year", "x_tile", "y_tile").agg(F.bool_and("there").alias("available"))


def matrix(tiles: DataFrame, inventory: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """Each tile-year with a column for each source."""
    return presence(tiles, inventory, sources).groupBy("year", "x_tile", "y_tile").pivot("source", list(sources)).agg(F.bool_or("there"))


def by_year(tiles: DataFrame, inventory: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    found = availability(tiles, inventory, sources)
    return found.groupBy("year").agg(F.count("*").alias("needed"), F.count_if("available").alias("existing"), F.count_if(~F.col("available")).alias("missing"))


def ready(tiles: DataFrame, inventory: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """Tile-years all of whose sources exist."""
    return availability(tiles, inventory, sources).where("available").drop("available")


def first_there(wanted: DataFrame, candidates: list, inventory: DataFrame, *keys: str) -> DataFrame:
    """(keys, object_key, place): of alternative keys (columns, best first) the first that exists; nulls without one."""
    tries = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), c.alias("object_key")) for i, c in enumerate(candidates)])).alias("k")
    found = wanted.select(*keys, tries).select(*keys, "k.*").join(inventory.select("object_key").distinct(), "object_key")
    best = found.groupBy(*keys).agg(F.min(F.struct("place", "object_key")).alias("best"))
    return wanted.select(*keys).distinct().join(best, list(keys), "left").select(*keys, "best.object_key", "best.place")


def tile_ids(inventory: DataFrame) -> DataFrame:
    """Distinct tile tags among all object names, whatever stands before or after them."""
    tag = F.regexp_extract("object_key", r"(\d+X\d+Y)[^/]*$", 1)
    return inventory.select(tag.alias("tag")).where("tag <> ''").distinct()
