"""Scope and coverage reports over polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tiles import lacks_coverage, prediction_year


def scope(polygons: DataFrame) -> DataFrame:
    """Polygons, years and hectares by project, short name and framework."""
    year = F.year("plantstart")
    return polygons.groupBy("project_id", "short_name", "framework_key").agg(
        F.count("*").alias("n_polys"), F.min(year).alias("min_year"), F.max(year).alias("max_year"), F.round(F.sum("calc_area"), 1).alias("area")
    )


def coverage(polygons: DataFrame) -> DataFrame:
    """By label: polygons with a value for their year, for other years only, and without any; most missing first, then by label.

    An undated polygon that has values is neither right nor wrong, so the three need not add up to the total.
    """
    has = F.map_contains_key("ttc", prediction_year())
    return polygons.groupBy(F.coalesce("short_name", "project_id").alias("label")).agg(
        F.count("*").alias("total"), F.count_if(~lacks_coverage() & has).alias("correct_yr"), F.count_if(~lacks_coverage() & ~has).alias("wrong_yr"), F.count_if(lacks_coverage()).alias("missing")
    ).orderBy(F.desc("missing"), "label")


def missing_summary(polygons: DataFrame) -> DataFrame:
    """Polygons without coverage by framework, by project within it, and in all: one pass with grouping sets."""
    missing = polygons.where(lacks_coverage())
    return missing.groupingSets([["framework_key"], ["short_name", "framework_key"], []], "framework_key", "short_name").agg(
        F.count("*").alias("cnt"), F.grouping_id().alias("level")
    )


def framework_coverage(polygons: DataFrame) -> DataFrame:
    """Counts, share with a value for the year in per cent, and the range of prediction years, by framework."""
    has = F.coalesce(F.map_contains_key("ttc", prediction_year()), F.lit(False))
    return polygons.groupBy("framework_key").agg(
        F.count("*").alias("total"),
        F.count_if(has).alias("covered"),
        F.round(100.0 * F.count_if(has) / F.count("*"), 1).alias("pct"),
        F.min(prediction_year()).alias("min_pred"),
        F.max(prediction_year()).alias("max_pred"),
    )


def year_histogram(polygons: DataFrame) -> DataFrame:
    return polygons.withColumn("pred_year", prediction_year()).where("pred_year is not null").groupBy("pred_year").agg(F.count("*").alias("n"))
