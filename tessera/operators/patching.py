"""Matching results with the records of an outside system, and auditing what is lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import small_float

OUTCOMES = ("sent", "dryrun", "unmatched", "error")
#: Names of a column of uncertainties in order of preference, then endings that will do.
UNCERTAINTY, ENDINGS = ("plus_minus_average", "shift_error", "ttc_shift_error"), ("_error", "_stderr", "_uncertainty")


def uncertainty_column(columns: list[str]) -> str | None:
    lower = {c.lower(): c for c in columns}
    named = next((lower[c] for c in UNCERTAINTY if c in lower), None)
    return named or next((c for c in columns if c.lower().endswith(ENDINGS)), None)


def indicator(value: str, year: str, default_year: int | None, uncertainty: str | None = None) -> Column:
    """struct(value, year, plus_minus), null where the value or the year is missing; a row's year goes first."""
    y = F.coalesce(F.col(year).try_cast("int"), F.lit(default_year).cast("int"))
    v = small_float(F.col(value).cast("string"))
    extra = small_float(F.col(uncertainty).cast("string")) if uncertainty else F.lit(None).cast("double")
    return F.when(v.isNotNull() & y.isNotNull(), F.struct(v.alias("value"), y.alias("year"), extra.alias("plus_minus")))


def outcomes(rows: DataFrame, known: DataFrame, payload: Column, apply: bool = False) -> DataFrame:
    """rows (poly_uuid, ...) with a status: error, unmatched, or what would be (dryrun) or was to be (sent) patched."""
    ids = known.select(F.col("poly_uuid").cast("string").alias("poly_uuid")).distinct().withColumn("there", F.lit(True))
    keyed = rows.withColumn("payload", payload).withColumn("poly_uuid", F.coalesce(F.col("poly_uuid").cast("string"), F.lit("")))
    # Rows without an id are judged before the join: they would all be one key of it.
    nameless = keyed.where("poly_uuid = ''").withColumn("status", F.lit("error"))
    keyed = keyed.where("poly_uuid <> ''")
    status = (
        F.when(F.col("poly_uuid") == "", "error").when(F.col("there").isNull(), "unmatched").when(F.col("payload").isNull(), "error").otherwise("sent" if apply else "dryrun")
    )
    return keyed.join(ids, "poly_uuid", "left").withColumn("status", status).drop("there").unionByName(nameless)


def first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows to patch, by id."""
    return rows.orderBy("poly_uuid").limit(n)


def drop_reasons(expected: DataFrame, produced: DataFrame, reason: Column) -> DataFrame:
    """(reason, n) of the expected polygons that results lack, the commonest first."""
    return dropped(expected, produced).groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def outcome_counts(found: DataFrame) -> DataFrame:
    """All statuses with their number, 0 included."""
    domain = found.sparkSession.createDataFrame([(s,) for s in OUTCOMES], "status string")
    return domain.join(found.groupBy("status").agg(F.count("*").alias("n")), "status", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def dropped(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Expected polygons that results lack; ids are compared as text."""
    there = produced.select(F.col("poly_uuid").cast("string").alias("poly_uuid"))
    return expected.withColumn("poly_uuid", F.col("poly_uuid").cast("string")).join(there, "poly_uuid", "left_anti")
