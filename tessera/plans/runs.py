"""Records of runs: reports of their jobs, and the state of each tile's steps, as files that Spark reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.scalars import ARD_SOURCES, prediction_key, source_key, tile_tag
from tessera.operators import tracking

from .report import markdown

STATE = "run_id string, version int, tile string, step string, status string, detail string"


def run_summary(jobs: DataFrame, run_id: str, step: str | None = None) -> DataFrame:
    """One row: run_id, step (else the commonest task, in lower case), the numbers of jobs by outcome, and of failed tiles."""
    named = F.lit(step) if step else F.lower("task_type")
    return tracking.overall(jobs).join(tracking.dominant_task(jobs)).join(tracking.failed_tiles(jobs).agg(F.count("*").alias("n_failed_tiles"))).select(
        F.lit(run_id).alias("run_id"), named.alias("step"), "n_jobs", "n_success", "n_partial", "n_failed", "n_failed_tiles"
    )


def write_report(jobs: DataFrame, folder: str, run_id: str, step: str | None = None) -> str:
    """Write summary (JSON), jobs, failed and phase_stats (CSV) and report (Markdown text) below folder/run_id; returns that folder.

    jobs and failed are written by Spark's tasks; the others have a row for each phase or task.
    """
    at = f"{folder}/{run_id}"
    run_summary(jobs, run_id, step).coalesce(1).write.json(f"{at}/summary")
    jobs.write.csv(f"{at}/jobs", header=True)
    tracking.failed_tiles(jobs).write.csv(f"{at}/failed", header=True)
    tracking.phase_percentiles(jobs).coalesce(1).write.csv(f"{at}/phase_stats", header=True)
    text = "\n".join([
        markdown(run_summary(jobs, run_id, step), f"Run {run_id}"), markdown(tracking.status_by(jobs, "task_type").orderBy("task_type"), "By task"),
        markdown(tracking.durations(jobs).orderBy("task_type"), "Seconds"), markdown(tracking.first_failures(jobs), "First failed jobs"),
    ])
    jobs.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{at}/report")
    return at


def write_state(state: DataFrame, folder: str, run_id: str, version: int = 0) -> None:
    """Write a run's state (tile, step, status, detail) as a version of its own."""
    state.select("tile", "step", "status", "detail").write.parquet(f"{folder}/run_id={run_id}/version={version}")


def states(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(folder)


def load_state(spark: SparkSession, folder: str, run_id: str) -> DataFrame:
    """The last version of a run's state, with its number."""
    own = states(spark, folder).where(F.col("run_id") == run_id)
    return own.join(own.agg(F.max("version").alias("version")), "version").select("tile", "step", "status", "detail", "version")


def run_ids(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """(run_id, version) of all runs, the newest id first."""
    found = states(spark, folder).groupBy("run_id").agg(F.max("version").alias("version")).orderBy(F.desc("run_id"))
    return found.limit(limit) if limit is not None else found


def update_state(spark: SparkSession, folder: str, run_id: str, updates: DataFrame) -> None:
    """Write the next version of a run's state: updates (tile, step, status, detail) take the place of what their step said.

    Tiles that the run doesn't have are left out.
    """
    now = load_state(spark, folder, run_id)
    version = now.agg(F.max("version")).first()[0]
    known = updates.join(now.select("tile").distinct(), "tile", "left_semi").withColumn("new", F.lit(1))
    both = now.drop("version").withColumn("new", F.lit(0)).unionByName(known.select("tile", "step", "status", "detail", "new"))
    last = F.row_number().over(Window.partitionBy("tile", "step").orderBy(F.desc("new"), "status"))
    write_state(both.withColumn("rank", last).where("rank = 1"), folder, run_id, version + 1)


def availability_text(presence: DataFrame, place: str) -> DataFrame:
    """(year, x_tile, y_tile, text): which sources of each tile are there. presence: those and a boolean for each source
    (ARD_SOURCES) and `prediction`, as far as it has them."""
    c = [F.col(x) for x in ("year", "x_tile", "y_tile")]
    sources = [s for s in ARD_SOURCES if s in presence.columns]
    named = [(s, source_key(s, *c)) for s in sources] + ([("prediction", prediction_key(*c))] if "prediction" in presence.columns else [])
    width = max((len(n) for n, _ in named), default=0)
    # The wording and widths of the text.
    mark = lambda s: F.rpad(F.when(F.col(s), "present").otherwise("MISSING"), 8, " ")
    head = F.concat(F.lit("Tile "), tile_tag(c[1], c[2]), F.lit("  |  year "), c[0].cast("string"), F.lit(f"  |  {place}"))
    rule = F.expr("repeat('-', greatest(48, length(head)))")
    lines = [F.concat(F.lit(f"  {n:<{width}}  "), mark(n), F.lit("  "), key) for n, key in named]
    there = sum((F.col(s).cast("int") for s in sources), F.lit(0))
    tail = [F.concat(F.lit("Raw ARD:    "), there.cast("string"), F.lit(f"/{len(sources)} sources present"))]
    if "prediction" in presence.columns:
        tail.append(F.when(F.col("prediction"), "Prediction: present").otherwise("Prediction: not generated"))
    return presence.withColumn("head", head).select("year", "x_tile", "y_tile", F.concat_ws("\n", "head", rule, *lines, rule, *tail).alias("text"))
