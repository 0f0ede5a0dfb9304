"""Adapter views: the driver's test tables seen as marine inputs.

Each view is one SQL text accepted by both Spark SQL (UTC session) and
DuckDB, so a Spark query and its DuckDB oracle read identical rows. The views
are plain projections/aggregations of the base tables; Spark folds them into
the calling query's plan (column pruning and filters still reach the scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# The adapter view texts (FIXTURES.md section 2).
VIEW_SQL = {
    "v_individuals": (
        "select user_id as id, 'Shark#' || cast(user_id as string) as name, "
        "case when user_id % 7 = 0 then 'Prionace glauca' else 'Carcharodon carcharias' end as species, "
        "case user_id % 5 when 0 then 'Male' when 1 then 'f' when 2 then 'FEMALE' when 3 then 'm' else '' end as sex, "
        "case when user_id % 11 = 0 then null else cast(20 + (user_id * 13) % 35 as double) / 10 end as length_m, "
        "cast(300 + user_id * 3 as double) as weight_kg from (select distinct user_id from events) u"),
    "v_tracks": (
        "select event_id, user_id as shark_id, ts, "
        "cast(-130 as double) + cast((user_id * 131 + event_id * 17) % 2000 as double) / 100 as lon, "
        "cast(25 as double) + cast((user_id * 57 + event_id * 29) % 2000 as double) / 100 as lat from events"),
    "v_occurrences": (
        "select o_orderkey as occ_id, case o_custkey % 5 when 0 then 'Zalophus californianus' "
        "when 1 then 'Mirounga angustirostris' when 2 then 'Arctocephalus pusillus' when 3 then 'Phoca vitulina' "
        "else 'Orcinus orca' end as species_name, case when o_orderkey % 2 = 0 then 'OBIS' else 'GBIF' end as source, "
        "o_orderdate as event_date, case when o_orderkey % 13 = 0 then null else cast(-130 as double) + "
        "cast((o_custkey * 211) % 2000 as double) / 100 + cast((o_orderkey * 7) % 11 as double) / 100 end as lon, "
        "case when o_orderkey % 17 = 0 then null else cast(25 as double) + cast((o_custkey * 487) % 2000 as double) / 100 "
        "+ cast((o_orderkey * 3) % 11 as double) / 100 end as lat from orders"),
    "v_cube": (
        "select o_orderdate as time, cast(25 as double) + cast(o_custkey % 9 as double) * 2.5 as lat, "
        "cast(-130 as double) + cast(cast(floor(o_custkey / 9) as bigint) % 9 as double) * 2.5 as lon, "
        "max(o_totalprice) / 20000 as value from orders group by 1, 2, 3"),
    # the ocean variables of the whole calendar at all places of the cube; sst is the cube's value
    "v_granules": (
        "select o_orderdate as date, cast(25 as double) + cast(o_custkey % 9 as double) * 2.5 as latitude, "
        "cast(-130 as double) + cast(cast(floor(o_custkey / 9) as bigint) % 9 as double) * 2.5 as longitude, "
        "max(o_totalprice) / 20000 as sst, case when max(o_orderkey) % 11 = 0 then null "
        "else min(o_totalprice) / 100000 end as chlor_a, cast(max(o_orderkey) % 201 - 100 as double) / 100 as sla, "
        "case when min(o_orderkey) % 13 = 0 then null else cast(32 as double) + cast(min(o_orderkey) % 300 as double) / 100 end "
        "as sss_smap from orders group by 1, 2, 3"),
    # daily granules of the tracks' season, named as their providers do
    "v_ocean": (
        "select date '2024-01-01' + cast((o_orderkey * 7 + o_custkey) % 91 as int) as date, cast(25 as double) "
        "+ cast(o_custkey % 5 as double) * 5.0 as latitude, cast(-130 as double) + cast(cast(floor(o_custkey / 5) as bigint) % 5 "
        "as double) * 5.0 as longitude, max(o_totalprice) / 20000 as sst, case when max(o_orderkey) % 11 = 0 then null "
        "else min(o_totalprice) / 100000 end as chlor_a, cast(max(o_orderkey) % 201 - 100 as double) / 100 as sla, "
        "case when min(o_orderkey) % 13 = 0 then null else cast(32 as double) + cast(min(o_orderkey) % 300 as double) / 100 end "
        "as sss_smap from orders group by 1, 2, 3"),
    "v_effort_season": (
        "select date '2024-01-01' + cast((l_orderkey * 5 + l_linenumber) % 91 as int) as ts, case l_returnflag when 'A' then "
        "'tuna_purse_seines' when 'N' then 'drifting_longlines' else 'trawlers' end as gear, "
        "cast(-130 as double) + cast((l_suppkey * 191 + l_orderkey) % 2000 as double) / 100 as lon, "
        "cast(25 as double) + cast((l_partkey * 37) % 2000 as double) / 100 as lat, l_quantity as hours from lineitem"),
    "v_surface": (
        "select p_partkey % 40 as lon_idx, cast(floor(p_partkey / 40) as bigint) as lat_idx, "
        "cast(-130 as double) + cast(p_partkey % 40 as double) * 0.5 as lon, "
        "cast(25 as double) + cast(floor(p_partkey / 40) as double) * 0.5 as lat, "
        "cast(150 - (p_partkey % 40 - 20) * (p_partkey % 40 - 20) - (cast(floor(p_partkey / 40) as bigint) % 25 - 12) "
        "* (cast(floor(p_partkey / 40) as bigint) % 25 - 12) - p_size as double) as elevation, "
        "case when p_partkey % 19 = 0 then null else 10 + cast(p_partkey % 40 as double) / 4 end as sst, "
        "p_retailprice / 1000 as chl from part"),
    "v_lane_vertices": (
        "select s_suppkey as lane_id, v as vertex_no, "
        "cast(-130 as double) + cast((s_suppkey * 397 + v * 23) % 2000 as double) / 100 as lon, "
        "cast(25 as double) + cast((s_suppkey * 611 + v * 41) % 2000 as double) / 100 as lat "
        "from supplier cross join (select 0 as v union all select 1 union all select 2 union all select 3 "
        "union all select 4) k"),
    "v_oxygen": (
        "select l_suppkey % 20 as lon_idx, l_partkey % 20 as lat_idx, (l_linenumber - 1) * 500 as depth_m, "
        "max(case when l_linenumber >= 5 and ((l_suppkey % 20) + (l_partkey % 20) + l_linenumber) % 3 = 0 "
        "then null else l_quantity / 10 end) as o_an from lineitem group by 1, 2, 3"),
    "v_effort": (
        "select l_shipdate as ts, case l_returnflag when 'A' then 'tuna_purse_seines' "
        "when 'N' then 'drifting_longlines' else 'trawlers' end as gear, "
        "cast(-130 as double) + cast((l_suppkey * 191 + l_orderkey) % 2000 as double) / 100 as lon, "
        "cast(25 as double) + cast((l_partkey * 37) % 2000 as double) / 100 as lat, l_quantity as hours from lineitem"),
    "v_series_a": (
        "select cast(date_trunc('day', ts) as date) as day, event_type, avg(cast(event_id as double)) as value "
        "from events group by 1, 2"),
}

# Spark-side text where the shared one would plan a nested-loop join: the five
# vertex numbers come from a generator instead of a cross join (same rows).
SPARK_VIEW_SQL = {
    "v_lane_vertices": (
        "select s_suppkey as lane_id, v as vertex_no, "
        "cast(-130 as double) + cast((s_suppkey * 397 + v * 23) % 2000 as double) / 100 as lon, "
        "cast(25 as double) + cast((s_suppkey * 611 + v * 41) % 2000 as double) / 100 as lat "
        "from supplier lateral view explode(array(0, 1, 2, 3, 4)) k as v"),
}

# Which base tables each view reads (so only those are registered).
VIEW_TABLES = {
    "v_individuals": ("events",), "v_tracks": ("events",), "v_occurrences": ("orders",),
    "v_cube": ("orders",), "v_granules": ("orders",), "v_ocean": ("orders",), "v_surface": ("part",), "v_lane_vertices": ("supplier",),
    "v_oxygen": ("lineitem",), "v_effort": ("lineitem",), "v_effort_season": ("lineitem",), "v_series_a": ("events",),
}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def register_views(spark: SparkSession, sf_dir: str, views=None) -> None:
    """Register base tables then the adapter views (lazy; nothing is read yet)."""
    views = list(views or VIEW_SQL)
    tables = sorted({t for v in views for t in VIEW_TABLES[v]})
    register_tables(spark, sf_dir, tables)
    for v in views:
        spark.sql(SPARK_VIEW_SQL.get(v, VIEW_SQL[v])).createOrReplaceTempView(v)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_views(spark, sf_dir, [name])
    return spark.table(name)


def with_views(sql: str, views) -> str:
    """Prefix an oracle query with the adapter views it uses, as CTEs."""
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in views)
    body = sql.lstrip()
    if body[:15].lower() == "with recursive ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].lower() == "with ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
