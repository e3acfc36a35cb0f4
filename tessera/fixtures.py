"""Relations of the domain made from the star-schema tables, as SQL that Spark and DuckDB both run.

Distances are whole units of 1/3600 degree; a tile has 200 of them on a side. Where the two dialects differ (maps,
arrays, series), a name between @ stands for the dialect's own spelling.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DIALECT = {
    "spark": {
        "one": "map(cast({k} as int), cast({v} as double))",
        "none": "cast(map() as map<int, double>)",
        "list": "array({a})",
        "pixels": "select vec_id, label, cast(pos as int) as i, cast(v as double) as v from (select vec_id, label, posexplode(embedding) as (pos, v) from embeddings)",
    },
    "duckdb": {
        "one": "map {cast({k} as int): cast({v} as double)}",
        "none": "cast(map {} as map(int, double))",
        "list": "[{a}]",
        "pixels": "select vec_id, label, cast(i - 1 as int) as i, cast(embedding[i] as double) as v from embeddings, lateral (select unnest(range(1, 65)) as i)",
    },
}

VIEWS = {
    "v_grid": "select distinct cast(p_partkey % 50 as int) as x_tile, cast(cast(floor(p_partkey / 50) as bigint) % 50 as int) as y_tile from part",
    "v_polys": """
        select cast(o_orderkey as string) as poly_uuid, o_orderkey as k, cast(c_custkey % 97 as string) as project_id,
          case when o_orderkey % 29 = 0 then null else n_name end as short_name, r_name as framework_key,
          case when o_orderkey % 41 = 0 then null else cast(o_orderdate as date) end as plantstart, o_totalprice / 100000 as calc_area,
          case when o_orderstatus = 'P' then null when o_orderstatus = 'O' then @none@
            else @one:year(o_orderdate) - 1 - cast(o_orderkey % 2 as int)|o_totalprice / 6000@ end as ttc,
          @list:n_name, r_name, c_mktsegment@ as cohort, o_orderkey % 53 <> 0 as valid,
          cast(o_orderkey * 7919 % 10000 as int) as x0, cast(o_orderkey * 104729 % 10000 as int) as y0,
          cast(o_orderkey * 7919 % 10000 + 20 + o_orderkey % 300 as int) as x1, cast(o_orderkey * 104729 % 10000 + 20 + o_custkey % 300 as int) as y1
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "v_request": "select cast(c_custkey % 97 as string) as project_id, case when c_custkey % 5 = 0 then null else cast(1995 + c_custkey % 7 as int) end as plantstart_year from customer",
    "v_tiles": "select distinct cast(1995 + l_orderkey % 7 as int) as year, cast(l_partkey % 50 as int) as x_tile, cast(l_suppkey % 50 as int) as y_tile from lineitem",
    "v_inventory": """
        select distinct concat(cast(1995 + l_orderkey % 7 as string), '/raw/', cast(l_partkey % 50 as string), '/', cast(l_suppkey % 50 as string), '/raw/s1/',
          cast(l_partkey % 50 as string), 'X', cast(l_suppkey % 50 as string), 'Y.hkl') as object_key from lineitem where l_linenumber <> 2
        union select distinct concat(cast(1995 + l_orderkey % 7 as string), '/raw/', cast(l_partkey % 50 as string), '/', cast(l_suppkey % 50 as string), '/raw/misc/dem_',
          cast(l_partkey % 50 as string), 'X', cast(l_suppkey % 50 as string), 'Y.hkl') as object_key from lineitem where l_linenumber < 5""",
    "v_jobs": """
        select event_id as seq, cast(event_id as string) as job_id,
          case event_type when 'click' then 'DEM' when 'view' then 'S1_RTC' when 'purchase' then 'S2' else 'predict' end as task_type,
          case event_id % 2 when 0 then 'us-west-2' else 'eu-central-1' end as region,
          case event_id % 11 when 0 then 'failed' when 1 then 'partial' when 2 then 'skipped' when 3 then 'running' else 'success' end as status,
          cast(2020 + user_id % 3 as int) as year, cast(user_id % 50 as int) as x_tile, cast(user_id % 37 as int) as y_tile,
          case when event_id % 13 = 0 then null when event_id % 17 = 0 then 0 else round(value, 4) end as duration_sec,
          case event_id % 11 when 0 then case event_id % 3 when 0 then 'HTTP 503 slow down' when 1 then 'connection timeout' else 'bad geometry' end end as error,
          cast(event_id % 4 as int) as attempts from events""",
    "v_scenes": """
        select l_orderkey * 10 + l_linenumber as scene_id, cast(l_suppkey as int) as tile, cast(l_shipdate as date) as acquired, l_discount * 6 as cloud,
          l_tax * 8 as local_cloud, round(1 - l_tax / 2, 4) as coverage, case l_linestatus when 'O' then 'ascending' else 'descending' end as orbit from lineitem""",
    "v_series": "select user_id as pixel, cast(event_id % 24 as int) as t, event_id as seq, cast(cast(floor(value * 7) as bigint) % 365 as int) as doy, round(value / 1000, 6) as v from events",
    "v_pixels": "@pixels@",
    "v_patch": "select vec_id as tile, label, cast(floor(i / 8) as int) as r, cast(i % 8 as int) as c, cast(floor((v + 1) * 50) as int) as u8 from (@pixels@) p",
    "v_bands": "select vec_id as pixel, cast(floor(i / 10) as int) as t, cast(i % 10 as int) as band, round(abs(v), 6) as v from (@pixels@) p",
}


def text_of(view: str, dialect: str) -> str:
    """A view's SQL in a dialect."""
    words = DIALECT[dialect]

    def own(found: re.Match) -> str:
        name, _, args = found[1].partition(":")
        first, _, second = args.partition("|")
        return words[name].replace("{k}", first).replace("{v}", second).replace("{a}", args)

    text = re.sub("@([^@]+)@", own, VIEWS[view])
    if dialect == "duckdb":
        text = text.replace("as string", "as varchar")
    return text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = text_of(name, "spark")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "orders", "customer", "nation", "region", "lineitem", "events", "embeddings") if f" {t}" in text}
    for t in tables:
        text = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **tables)


def with_views(sql: str) -> str:
    """A DuckDB query with the views that it names before it."""
    names = [v for v in VIEWS if v in sql]
    head = ", ".join(f"{v} as ({text_of(v, 'duckdb')})" for v in names)
    sql = sql.strip()
    if not names:
        return sql
    if sql.lower().startswith("with recursive "):
        return f"with recursive {head}, {sql[15:]}"
    return f"with {head}, {sql[5:]}" if sql.lower().startswith("with ") else f"with {head} {sql}"
