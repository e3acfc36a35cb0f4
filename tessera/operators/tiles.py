"""Requests to tiles: decoding, the grid join, the covering-cell join of boxes, filters and chunking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import token_x, token_y
from tessera.schemas import REQUEST

from . import geometry
from .shared import numbered

#: Units of 1/3600 degree on a side of a tile.
SIDE = 200
#: Rows in the first chunks of a run, then in each of the others.
LADDER, STEADY = (100, 200, 400, 800), 1600


def decoded(df: DataFrame, token: str = "token") -> DataFrame:
    """df with x_tile and y_tile of a token like 1035X727Y; null where it isn't one."""
    return df.withColumns({"x_tile": token_x(F.col(token)), "y_tile": token_y(F.col(token))})


def request_tiles(documents: DataFrame, column: str = "document") -> DataFrame:
    """Distinct (year, token) of nested requests {project: {year: {missing_tiles: [token]}}}.

    Years that aren't numbers and nodes of other shapes are skipped; tokens are trimmed.
    """
    parsed = documents.select(F.from_json(column, REQUEST).alias("projects"))
    years = parsed.select(F.explode("projects").alias("project", "years")).select(F.explode("years").alias("year", "node"))
    tokens = years.select(F.col("year").try_cast("int").alias("year"), F.explode("node.missing_tiles").alias("token"))
    return tokens.where("year is not null and token is not null").select("year", F.trim("token").alias("token")).distinct()


def on_grid(tiles: DataFrame, grid: DataFrame) -> DataFrame:
    """Requested tiles (year, x_tile, y_tile) that the grid has, with its other columns."""
    return tiles.join(grid, ["x_tile", "y_tile"])


def covering_cells(low: str, high: str) -> Column:
    """Indices of the tiles along an axis that an interval meets, touching edges included."""
    return F.sequence(F.ceil(F.col(low) / SIDE).cast("int") - 1, F.floor(F.col(high) / SIDE).cast("int"))


def boxes_on_grid(boxes: DataFrame, grid: DataFrame) -> DataFrame:
    """boxes (with x0, y0, x1, y1) joined to the grid tiles that they meet or touch.

    Each box is spread over its covering cells, so the join is by equality of cells and shuffles on them.
    """
    cells = boxes.select("*", F.explode(covering_cells("x0", "x1")).alias("x_tile")).select("*", F.explode(covering_cells("y0", "y1")).alias("y_tile"))
    return cells.join(grid, ["x_tile", "y_tile"])


def polygons_on_grid(polygons: DataFrame, grid: DataFrame, geom: str = "geom") -> DataFrame:
    """polygons (well-known binary) joined to the grid tiles that they meet or touch.

    A quadtree over each polygon gives its tiles (see geometry.cover), so the join is by equality of tiles and needs no
    test; a geometry goes along only where the result's columns are asked for it.
    """
    cells = polygons.select("*", F.explode(geometry.cells_met(F.col(geom), SIDE)).alias("_cell"))
    return cells.select(*polygons.columns, F.col("_cell.i").alias("x_tile"), F.col("_cell.j").alias("y_tile")).join(grid, ["x_tile", "y_tile"])


def valid_only(polygons: DataFrame, geom: str = "geom") -> DataFrame:
    """polygons whose geometry is a sound polygon with an area (geometry.diagnosis says ok)."""
    kept = geometry.described(polygons.select(F.struct(*polygons.columns).alias("_row"), F.col(geom).alias("geom")))
    return kept.where("status = 'ok'").select("_row.*")


def lacks_coverage(ttc: str = "ttc") -> Column:
    """No value for any year: a null or an empty map."""
    return F.col(ttc).isNull() | (F.size(F.map_keys(ttc)) == 0)


def prediction_year(override: int | None = None) -> Column:
    return F.coalesce(F.lit(override).cast("int"), F.year("plantstart") - 1)


def dated(polygons: DataFrame) -> DataFrame:
    """polygons with their prediction year, without those that have no date; an error where none has one."""
    found = polygons.withColumn("year", prediction_year()).where("year is not null")
    if found.isEmpty() and not polygons.isEmpty():
        raise ValueError("no polygon has a date to take its year from")
    return found


def needed_tiles(polygons: DataFrame, grid: DataFrame, only_missing: bool = True) -> DataFrame:
    """Distinct (year, x_tile, y_tile) that valid polygons without coverage meet; polygons without a date are dropped, and it is
    an error if none has one.

    With a column geom (well-known binary) validity and meeting are the polygon's own; else `valid` says, and boxes meet.
    """
    own = "geom" in polygons.columns
    wanted = dated(polygons if own else polygons.where("valid"))
    wanted = wanted.where(lacks_coverage()) if only_missing else wanted
    if own:
        return polygons_on_grid(valid_only(wanted).select("year", "geom"), grid).select("year", "x_tile", "y_tile").distinct()
    return boxes_on_grid(wanted.select("year", "x0", "y0", "x1", "y1"), grid).select("year", "x_tile", "y_tile").distinct()


def requested_any_year(polygons: DataFrame, requests: DataFrame) -> DataFrame:
    """Polygons that some request (project_id, plantstart_year) names; a request without a year means any."""
    r = requests.select(F.col("project_id").alias("r_project"), "plantstart_year").distinct()
    fits = (F.col("project_id") == F.col("r_project")) & (F.col("plantstart_year").isNull() | (F.col("plantstart_year") == F.year("plantstart")))
    return polygons.join(r, fits, "left_semi")


def requested_pairs(polygons: DataFrame, requests: DataFrame) -> DataFrame:
    """Polygons whose (project, year) is requested; requests without a year name none."""
    r = requests.select("project_id", F.col("plantstart_year").alias("r_year")).distinct()
    return polygons.withColumn("r_year", F.year("plantstart")).join(r, ["project_id", "r_year"], "left_semi").drop("r_year")


#: The keywords that a free predicate must not hold.
FORBIDDEN = ("DROP", "DELETE", "INSERT", "UPDATE", "ALTER", "CREATE", "TRUNCATE", "GRANT", "REVOKE", "ATTACH", "COPY", "PRAGMA")
#: The column that each list of alternatives is about.
LISTS = {"projects": "project_id", "short_names": "short_name", "frameworks": "framework_key", "ids": "poly_uuid"}


def checked_predicate(text: str) -> str:
    """A free predicate, refused where it holds a semicolon or a statement's keyword."""
    words = set("".join(c if c.isalnum() or c == "_" else " " for c in text.upper()).split())
    if ";" in text or words & set(FORBIDDEN):
        raise ValueError(f"not a predicate: {text!r}")
    return text


def single_tests(cohorts=(), where: str | None = None, **lists) -> list[tuple[str, str, Column]]:
    """(condition, value, test) for each value of each condition; lists are named as in LISTS."""
    tests = [(LISTS[name], v, F.col(LISTS[name]) == v) for name, values in lists.items() for v in values]
    tests += [("cohort", v, F.array_contains("cohort", v)) for v in cohorts]
    return tests + ([("predicate", where, F.expr(checked_predicate(where)))] if where else [])


def all_tests(**filters) -> Column:
    """Whether all conditions hold: a list's by any one of its values, cohorts by any one of a polygon's."""
    by_condition: dict[str, Column] = {}
    for condition, _, test in single_tests(**filters):
        by_condition[condition] = by_condition[condition] | test if condition in by_condition else test
    if not by_condition:
        raise ValueError("give at least one condition")
    return reduce(lambda a, b: a & b, by_condition.values())


def filtered(polygons: DataFrame, projects=(), short_names=(), frameworks=(), ids=(), cohorts=(), where: str | None = None) -> DataFrame:
    """Polygons for which all given conditions hold: lists are alternatives, cohorts any one of a polygon's."""
    return polygons.where(all_tests(projects=projects, short_names=short_names, frameworks=frameworks, ids=ids, cohorts=cohorts, where=where))


def without_year(polygons: DataFrame) -> DataFrame:
    """Polygons without a value for their own prediction year (but perhaps for others); undated ones count."""
    return polygons.where(~F.coalesce(F.map_contains_key("ttc", prediction_year()), F.lit(False)))


def chunk_of(n: Column, size: int | None = None) -> Column:
    """The chunk (from 1) of row n: chunks grow along the ladder, then stay; or all have `size` rows."""
    if size:
        return (F.floor(n / size) + 1).cast("int")
    out, start = None, 0
    for i, rows in enumerate(LADDER, 1):
        start += rows
        test = n < start
        out = F.when(test, i) if out is None else out.when(test, i)
    return out.otherwise((F.floor((n - start) / STEADY) + len(LADDER) + 1).cast("int"))


def write_chunks(tiles: DataFrame, path: str, size: int | None = None) -> None:
    """Tiles as CSV files with headers, one folder for each chunk."""
    chunked = numbered(tiles, "year", "x_tile", "y_tile").withColumn("chunk", chunk_of(F.col("n"), size)).drop("n")
    chunked.repartition("chunk").sortWithinPartitions("chunk", "year", "x_tile", "y_tile").write.partitionBy("chunk").option("header", True).csv(path)


def upserted(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """current with rows of new put in place of those of the same key, or added; outcome says which."""
    there = F.lit(True)
    both = current.withColumn("old_row", there).alias("o").join(new.withColumn("new_row", there).alias("n"), key, "full")
    columns = [F.when(F.col("n.new_row"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in current.columns if c != key]
    outcome = F.when(F.col("n.new_row").isNull(), "untouched").when(F.col("o.old_row").isNull(), "added").otherwise("replaced")
    return both.select(key, *columns, outcome.alias("outcome"))
