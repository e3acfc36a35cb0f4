"""Reports on job results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ranked

STATES = ["success", "partial", "failed", "skipped", "running"]
GOOD = ("success", "partial")
#: Codes and words in an error's text, and in the name of its kind, that make it worth another try.
RETRY_CODES = ("429", "500", "502", "503", "504", "408")
RETRY_WORDS = (
    "timeout", "timed out", "connection", "reset", "refused", "temporary", "throttl", "rate limit", "too many requests",
    "service unavailable", "bad gateway", "internal server error", "network", "socket", "ssl", "eof",
)
RETRY_KINDS = ("timeout", "connection", "http", "urllib", "ssl")
#: Dollars for a GB-second and for a request.
PER_GB_SECOND, PER_REQUEST = 0.0000166667, 0.0000002


def status_by(jobs: DataFrame, *keys: str) -> DataFrame:
    """Jobs by status, a column for each of STATES, with total and the share that succeeded in per cent."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATES]
    return jobs.groupBy(*keys).agg(F.count("*").alias("total"), *counts).withColumn("pct", F.round(100.0 * F.col("success") / F.col("total"), 1))


def overall(jobs: DataFrame) -> DataFrame:
    """One row: n_failed is all that neither succeeded nor did so in part; n_status_failed says 'failed' itself."""
    return jobs.agg(
        F.count("*").alias("n_jobs"), F.count_if(F.col("status") == "success").alias("n_success"), F.count_if(F.col("status") == "partial").alias("n_partial"),
        F.count_if(~F.col("status").isin(*GOOD)).alias("n_failed"), F.count_if(F.col("status") == "failed").alias("n_status_failed"),
    )


def dominant_task(jobs: DataFrame) -> DataFrame:
    """The task type with the most jobs; of several the first in order."""
    return jobs.groupBy("task_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "task_type").limit(1)


def durations(jobs: DataFrame) -> DataFrame:
    """Mean, least and greatest duration by task, without jobs that have none or 0."""
    d = jobs.where("duration_sec is not null and duration_sec <> 0")
    return d.groupBy("task_type").agg(F.count("*").alias("n"), F.round(F.avg("duration_sec"), 6).alias("avg_sec"), F.min("duration_sec").alias("min_sec"), F.max("duration_sec").alias("max_sec"))


def phase_percentiles(jobs: DataFrame, phase: str = "task_type", seconds: str = "duration_sec") -> DataFrame:
    """n, mean and percentiles of each phase at the nearest place, round(q (n - 1)) with halves to even: no interpolation."""
    at = lambda q: F.bround(q * (F.col("n") - 1)).cast("long")
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = ranked(jobs, [phase], seconds, F.array_distinct(F.array(*map(at, shares.values()))))
    points = found.groupBy(phase, "n").agg(*[F.round(F.max(F.when(F.col("rank") == at(q), F.col(seconds))), 4).alias(name) for name, q in shares.items()])
    means = jobs.groupBy(phase).agg(F.round(F.avg(seconds), 4).alias("mean"))
    return points.join(means, phase).select(phase, "n", "mean", *shares)


def phases_wide(jobs: DataFrame, phases: list[str]) -> DataFrame:
    """A row for each tile-year with the seconds of each phase."""
    return jobs.groupBy("year", "x_tile", "y_tile").pivot("task_type", phases).agg(F.round(F.sum("duration_sec"), 4))


def tile_verdicts(jobs: DataFrame) -> DataFrame:
    """A row for each tile-year: any bad job makes it failed; seconds are summed, the first error kept."""
    return jobs.groupBy("year", "x_tile", "y_tile").agg(
        F.when(F.bool_or(~F.col("status").isin(*GOOD)), "failed").otherwise("success").alias("verdict"),
        F.round(F.sum(F.coalesce("duration_sec", F.lit(0.0))), 4).alias("seconds"),
        F.min(F.when(F.col("error").isNotNull(), F.struct("seq", "error"))).getField("error").alias("first_error"),
    )


def exit_code(jobs: DataFrame) -> DataFrame:
    """0: all jobs are good; 2: none is; 1: some are."""
    bad = F.count_if(~F.col("status").isin(*GOOD))
    return jobs.agg(F.when((bad == F.count("*")) & (bad > 0), 2).when(bad > 0, 1).otherwise(0).alias("exit_code"))


def retryable(error: Column, kind: Column | None = None) -> Column:
    """Whether an error's text, or the name of its kind, says that another try may go well; null is no."""
    said = F.lower(error).rlike("|".join((*RETRY_CODES, *RETRY_WORDS)))
    named = F.lower(kind).rlike("|".join(RETRY_KINDS)) if kind is not None else F.lit(False)
    return F.coalesce(said, F.lit(False)) | F.coalesce(named, F.lit(False))


def billed_cost(memory_mb: Column, seconds: Column) -> Column:
    """struct(gb_sec, compute_usd, request_usd, total_usd) of one call of a worker."""
    gb_sec = memory_mb / 1024.0 * seconds
    return F.struct(gb_sec.alias("gb_sec"), (gb_sec * PER_GB_SECOND).alias("compute_usd"), F.lit(PER_REQUEST).alias("request_usd"), (gb_sec * PER_GB_SECOND + PER_REQUEST).alias("total_usd"))


def failed_tiles(jobs: DataFrame) -> DataFrame:
    """Tile-years with a job that is neither a success nor one in part, each once; jobs without a tile are left out."""
    bad = jobs.where(~F.col("status").isin(*GOOD) & F.col("x_tile").isNotNull() & F.col("y_tile").isNotNull())
    return bad.select("year", "x_tile", "y_tile").distinct()


def first_failures(jobs: DataFrame, n: int = 20) -> DataFrame:
    """The first n failed jobs by their number, with the first 200 characters of the error."""
    bad = jobs.where(~F.col("status").isin(*GOOD))
    return bad.orderBy("seq").limit(n).select("seq", "job_id", "task_type", "region", "status", "year", "x_tile", "y_tile", F.substring(F.coalesce("error", F.lit("Unknown")), 1, 200).alias("error"))


def benchmark_summary(calls: DataFrame, workers: int) -> DataFrame:
    """One row for a batch of calls (seq, ok, seconds, done_at): counts, percentiles at the nearest place, mean and deviation,
    calls a minute, and medians of the `workers` quickest and of the others, by which warm and cold starts are told.
    """
    good = calls.where("ok")
    n = good.agg(F.count("*").alias("good")).crossJoin(calls.agg(F.count("*").alias("calls")))
    place = lambda q: F.bround(q * (F.col("n") - 1)).cast("long")
    head = F.least(F.lit(workers).cast("long"), F.col("n"))
    middle = lambda start, size: (start + F.floor((size - 1) / 2).cast("long"), start + F.floor(size / 2).cast("long"))
    first, rest = middle(F.lit(0).cast("long"), head), middle(head, F.col("n") - head)
    wanted = F.array_distinct(F.array(*[place(q) for q in (0.5, 0.95, 0.99)], *first, *[F.least(x, F.col("n") - 1) for x in rest]))
    found = ranked(good, [], "seconds", wanted)
    at = lambda rank: F.max(F.when(F.col("rank") == rank, F.col("seconds")))
    half = lambda pair: (at(pair[0]) + at(pair[1])) / 2
    points = found.groupBy("n").agg(at(place(0.5)).alias("p50"), at(place(0.95)).alias("p95"), at(place(0.99)).alias("p99"), half(first).alias("quick_median"), half(rest).alias("slow_median"))
    points = points.withColumn("slow_median", F.when(F.col("n") > workers, F.col("slow_median"))).drop("n")
    plain = good.agg(F.avg("seconds").alias("mean"), F.when(F.count("*") > 1, F.stddev_samp("seconds")).alias("deviation"), F.max("done_at").alias("elapsed"))
    return n.join(plain).join(points).withColumn("per_minute", F.try_divide(F.col("good"), F.col("elapsed") / 60))


def retries(jobs: DataFrame) -> DataFrame:
    """By task: errors worth another try, the others, and attempts beyond the first."""
    return jobs.groupBy("task_type").agg(
        F.count_if(F.col("error").isNotNull() & retryable(F.col("error"))).alias("retryable"),
        F.count_if(F.col("error").isNotNull() & ~retryable(F.col("error"))).alias("permanent"),
        F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))).alias("retries"),
    )


def pending(tiles: DataFrame, jobs: DataFrame, step: str) -> DataFrame:
    """Tile-years that no good job of a step has."""
    done = jobs.where((F.col("task_type") == step) & F.col("status").isin(*GOOD)).select("year", "x_tile", "y_tile")
    return tiles.join(done, ["year", "x_tile", "y_tile"], "left_anti")
