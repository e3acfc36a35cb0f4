"""Annotations of radar scenes: assets, orbits, addresses, and look-up tables in XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Incidence in degrees where a scene says none.
INCIDENCE = 35.0


def asset_named(assets: Column, *words: str) -> Column:
    """The first asset (a map of names to addresses), by name, whose name has all words; null without one."""
    found = F.map_filter(assets, lambda k, x: _all(F.lower(k), words))
    return F.try_element_at(found, F.try_element_at(F.array_sort(F.map_keys(found)), F.lit(1)))


def _all(name: Column, words: tuple[str, ...]) -> Column:
    test = F.lit(True)
    for w in words:
        test = test & name.contains(w.lower())
    return test


def incidence(properties: Column) -> Column:
    """Degrees from the properties (a map), else INCIDENCE."""
    return F.coalesce(F.try_element_at(properties, F.lit("view:incidence_angle")).try_cast("double"), F.lit(INCIDENCE))


def look_angle(orbit: Column) -> Column:
    """Radians: to the right of an ascending orbit, else to the left."""
    return F.when(orbit == "ascending", F.lit(1.5707963267948966)).otherwise(F.lit(4.71238898038469))


def web_address(address: Column, region: str = "eu-central-1") -> Column:
    """s3://bucket/key as an https address; others as they are."""
    return F.regexp_replace(address, r"^s3://([^/]+)/(.*)$", f"https://$1.s3.{region}.amazonaws.com/$2")


def signed(address: Column, token: str) -> Column:
    """address with an access token, which takes the place of any it had."""
    return F.concat(F.regexp_replace(address, r"\?.*$", ""), F.lit("?" + token.lstrip("?&")))


def lut(spark: SparkSession, path: str, vector: str, *values: str) -> DataFrame:
    """(line, pixel, value) of the vectors in the file's list of them (vectorList); value is named as the first of values.

    A vector's numbers are in the first of the tags `values` that it has. One without a line takes its place in the
    list, from 0. A file without the list gives no rows.
    """
    schema = f"{vector} array<struct<line: string, pixel: string, {', '.join(f'{v}: string' for v in values)}>>"
    lists = spark.read.schema(schema).format("xml").option("rowTag", f"{vector}List").load(path)
    vectors = lists.select(F.posexplode(vector).alias("place", "v"))
    numbers = lambda c, kind: F.transform(F.split(F.trim(c), r"\s+"), lambda x: x.try_cast(kind))
    text = F.coalesce(*[F.col(f"v.{v}") for v in values])
    zipped = F.arrays_zip(numbers(F.col("v.pixel"), "int").alias("pixel"), numbers(text, "double").alias("value"))
    line = F.coalesce(F.col("v.line").try_cast("int"), F.col("place"))
    out = vectors.select(line.alias("line"), F.explode(zipped).alias("z")).select("line", F.col("z.pixel").alias("pixel"), F.col("z.value").alias(values[0]))
    return out.where(F.col("pixel").isNotNull() & F.col(values[0]).isNotNull())


def noise_lut(spark: SparkSession, path: str) -> DataFrame:
    """(line, pixel, noise): thermal noise from range vectors, in a file without their list from those by azimuth."""
    for kind in ("Range", "Azimuth"):
        lists = spark.read.schema("x string").format("xml").option("rowTag", f"noise{kind}VectorList").load(path)
        if not lists.isEmpty():
            break
    found = lut(spark, path, f"noise{kind}Vector", f"noise{kind}Lut", "noiseLut", "noiseLevel")
    return found.withColumnRenamed(f"noise{kind}Lut", "noise")


def incidence_grid(spark: SparkSession, path: str) -> DataFrame:
    """(line, pixel, angle) for all lines and pixels that the annotation's grid points name, null where it has no point.

    Points that can't be read are left out; without any, the grid is one point with the angle at the middle of the swath
    (INCIDENCE without that). A scene's grid has some hundred points.
    """
    points = spark.read.schema("line string, pixel string, incidenceAngle string").format("xml").option("rowTag", "geolocationGridPoint").load(path)
    points = points.select(F.col("line").try_cast("int").alias("line"), F.col("pixel").try_cast("int").alias("pixel"), F.col("incidenceAngle").try_cast("double").alias("angle"))
    points = points.where("line is not null and pixel is not null and angle is not null").groupBy("line", "pixel").agg(F.max("angle").alias("angle"))
    if points.isEmpty():
        middle = spark.read.schema("incidenceAngleMidSwath string").format("xml").option("rowTag", "imageInformation").load(path)
        value = F.coalesce(F.max(F.col("incidenceAngleMidSwath").try_cast("double")), F.lit(INCIDENCE))
        return middle.agg(value.alias("angle")).select(F.lit(0).alias("line"), F.lit(0).alias("pixel"), "angle")
    lines, pixels = points.agg(F.array_sort(F.collect_set("line")).alias("l"), F.array_sort(F.collect_set("pixel")).alias("p")), points
    dense = lines.select(F.explode("l").alias("line"), "p").select("line", F.explode("p").alias("pixel"))
    return dense.join(pixels, ["line", "pixel"], "left")
