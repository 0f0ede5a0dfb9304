"""Checked queries for projections, filters, generators and set operations.

Survey rows P1-P21, G1-G5, U1, U3, A16.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from .. import functions as tf
from ..operators import columns as C
from ..operators import grid as G
from ..operators import sets as U
from .registry import register, report

BBOX = tf.DEFAULT_BBOX
R9 = "round({0}, 9) + 0.0"


def r(x: str) -> str:
    return R9.format(x)


@register("drop_missing_coords", ["v_occurrences"],
          "select occ_id, species_name, lon, lat from v_occurrences where lon is not null and lat is not null")
def q_drop_missing(spark, sf):
    return C.drop_missing_coords(spark.table("v_occurrences")).select("occ_id", "species_name", "lon", "lat")


@register("clip_points_bbox", ["v_occurrences"],
          "select occ_id, lon, lat from v_occurrences where lon between -130.0 and -110.0 "
          "and lat between 25.0 and 45.0")
def q_clip_points(spark, sf):
    return C.clip_points_bbox(spark.table("v_occurrences"), BBOX).select("occ_id", "lon", "lat")


SUB_BBOX = {"min_lon": -125.0, "max_lon": -115.0, "min_lat": 30.0, "max_lat": 40.0}


@register("clip_grid_bbox", ["v_cube"],
          f"select time, lat, lon, {r('value')} as value from v_cube "
          "where lon between -125.0 and -115.0 and lat between 30.0 and 40.0")
def q_clip_grid(spark, sf):
    return report(C.clip_grid_bbox(spark.table("v_cube"), SUB_BBOX))


@register("filter_dates_table", ["v_tracks"],
          "select event_id, shark_id, ts from v_tracks where ts >= timestamp '2024-01-05 00:00:00' "
          "and ts <= timestamp '2024-01-20 00:00:00'")
def q_filter_dates_table(spark, sf):
    return C.filter_dates_table(spark.table("v_tracks"), "2024-01-05", "2024-01-20", "ts").select(
        "event_id", "shark_id", "ts")


@register("filter_dates_cube", ["v_cube"],
          f"select time, lat, lon, {r('value')} as value from v_cube where time >= timestamp '1996-01-01' "
          "and time < timestamp '1997-01-01'")
def q_filter_dates_cube(spark, sf):
    return report(C.filter_dates_cube(spark.table("v_cube"), "1996-01-01", "1996-12-31", "time"))


@register("filter_species", ["v_individuals"],
          "select id, name, species from v_individuals where species = 'Carcharodon carcharias'")
def q_filter_species(spark, sf):
    return C.filter_species(spark.table("v_individuals"), "Carcharodon carcharias").select("id", "name", "species")


STAGE_SQL = ("case when length_m is null then 'Unknown' when length_m >= 3.5 then "
             "case when lower(coalesce(sex, '')) in ('male', 'm') then 'Adult_Male' "
             "when lower(coalesce(sex, '')) in ('female', 'f') then 'Adult_Female' else 'Adult' end "
             "else 'Juvenile' end")


@register("classify_life_stage", ["v_individuals"],
          f"select id, sex, length_m, {STAGE_SQL} as life_stage from v_individuals")
def q_classify(spark, sf):
    return report(C.classify_life_stage(spark.table("v_individuals"), "length_m", "sex").select(
        "id", "sex", "length_m", "life_stage"))


@register("filter_life_stage", ["v_individuals"],
          f"select id, life_stage from (select id, {STAGE_SQL} as life_stage from v_individuals) s "
          "where life_stage = 'Juvenile'")
def q_filter_stage(spark, sf):
    df = C.classify_life_stage(spark.table("v_individuals"), "length_m", "sex")
    return C.filter_life_stage(df, "Juvenile").select("id", "life_stage")


@register("split_by_life_stage", ["v_individuals"],
          f"select id, life_stage from (select id, {STAGE_SQL} as life_stage from v_individuals) s "
          "where life_stage in ('Adult_Male', 'Adult_Female', 'Juvenile')")
def q_split_stage(spark, sf):
    df = C.classify_life_stage(spark.table("v_individuals"), "length_m", "sex")
    return C.split_by_life_stage(df).select("id", "life_stage")


@register("filter_gear", ["v_effort"],
          f"select ts, gear, {r('lon')} as lon, {r('lat')} as lat, {r('hours')} as hours from v_effort "
          "where gear in ('tuna_purse_seines', 'drifting_longlines')")
def q_filter_gear(spark, sf):
    return report(C.filter_gear(spark.table("v_effort")))


@register("is_summer_month", ["v_cube"],
          "select time, lat, lon, month(time) in (6, 7, 8) as is_summer from v_cube")
def q_is_summer(spark, sf):
    return C.add_is_summer(spark.table("v_cube"), "time").select("time", "lat", "lon", "is_summer")


@register("normalize_columns", ["v_tracks"],
          "select event_id, ts as time, lon, lat from v_tracks")
def q_normalize(spark, sf):
    raw = spark.table("v_tracks").select("event_id", F.col("ts").alias("Date"),
                                         F.col("lon").alias("longitude"), F.col("lat").alias("latitude"))
    return C.normalize_columns(raw).select("event_id", "time", "lon", "lat")


@register("make_points", ["v_tracks"],
          "select event_id, lon, lat, 'POINT (' || cast(lon as varchar) || ' ' || cast(lat as varchar) || ')' "
          "as geom_wkt from v_tracks")
def q_make_points(spark, sf):
    return C.make_points(spark.table("v_tracks"), wkt=True).select("event_id", "lon", "lat", "geom_wkt")


@register("tag_constants", ["v_tracks"],
          "select event_id, 1 as Shark_Presence_Status, 'Presence' as Point_Type, "
          "'Carcharodon carcharias' as species, 'telemetry' as source from v_tracks")
def q_tag(spark, sf):
    return C.tag_constants(spark.table("v_tracks").select("event_id"), Shark_Presence_Status=1,
                           Point_Type="Presence", species="Carcharodon carcharias", source="telemetry")


@register("bbox_polygon", ["v_tracks"],
          "select shark_id, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0 || ', ' || x1 || ' ' || y1 "
          "|| ', ' || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' as bbox_wkt from ("
          "select shark_id, cast(min(lon) as varchar) x0, cast(max(lon) as varchar) x1, "
          "cast(min(lat) as varchar) y0, cast(max(lat) as varchar) y1 from v_tracks group by shark_id) b")
def q_bbox_polygon(spark, sf):
    b = U.track_extents(spark.table("v_tracks"), "shark_id")
    return b.select("shark_id", tf.bbox_wkt("min_lon", "max_lon", "min_lat", "max_lat").alias("bbox_wkt"))


@register("add_temporal_features", ["v_tracks"],
          "select event_id, ts, cast(month(ts) as int) as Month, cast(weekofyear(ts) as int) as Week_of_Year "
          "from v_tracks")
def q_temporal_features(spark, sf):
    return C.add_temporal_features(spark.table("v_tracks").select("event_id", "ts"), "ts")


@register("add_season", ["v_occurrences"],
          "select occ_id, event_date, cast(month(event_date) as int) as Month, "
          "cast(weekofyear(event_date) as int) as Week_of_Year, "
          "case when month(event_date) in (12, 1, 2) then 'Winter' when month(event_date) in (3, 4, 5) then 'Spring' "
          "when month(event_date) in (6, 7, 8) then 'Summer' else 'Autumn' end as Season from v_occurrences")
def q_season(spark, sf):
    return C.add_season(spark.table("v_occurrences").select("occ_id", "event_date"), "event_date")


@register("elevation_to_depth", ["v_surface"],
          f"select lat_idx, lon_idx, elevation, {r('case when elevation < 0 then -elevation else 0.0 end')} "
          "as depth_m from v_surface")
def q_depth(spark, sf):
    return report(C.add_depth(spark.table("v_surface")).select("lat_idx", "lon_idx", "elevation", "depth_m"))


@register("deg_km", ["v_tracks"],
          f"select event_id, {r('(lon - -130.0) * 111.0')} as x_km, {r('(lat - 25.0) * 111.0')} as y_km, "
          f"{r('((lon - -130.0) * 111.0) / 111.0')} as x_deg from v_tracks")
def q_deg_km(spark, sf):
    t = spark.table("v_tracks")
    x_km = tf.deg_to_km(F.col("lon") - F.lit(-130.0))
    return report(t.select("event_id", x_km.alias("x_km"), tf.deg_to_km(F.col("lat") - F.lit(25.0)).alias("y_km"),
                           (x_km / F.lit(tf.KM_PER_DEG)).alias("x_deg")))


@register("cap_distance", ["v_tracks"],
          f"select event_id, {r('least(sqrt((lon + 120.0) * (lon + 120.0) + (lat - 35.0) * (lat - 35.0)) * 111.0, 500.0)')}"
          " as dist_km from v_tracks")
def q_cap(spark, sf):
    t = spark.table("v_tracks")
    d = tf.deg_to_km(F.sqrt((F.col("lon") + 120.0) ** 2 + (F.col("lat") - 35.0) ** 2))
    return report(t.select("event_id", tf.cap(d, 500.0).alias("dist_km")))


@register("clamp_criteria", ["v_surface"],
          "select lat_idx, lon_idx, "
          "coalesce((case when elevation < 0 then -elevation else 0.0 end) > 0 and "
          "(case when elevation < 0 then -elevation else 0.0 end) < 100.0, false) as depth_ok, "
          "coalesce(sst > 16.0, false) as sst_ok from v_surface")
def q_clamp(spark, sf):
    df = C.add_depth(spark.table("v_surface"))
    df = C.clamp_criteria(df, {"depth_ok": (F.col("depth_m") > 0) & (F.col("depth_m") < 100.0),
                               "sst_ok": F.col("sst") > 16.0})
    return df.select("lat_idx", "lon_idx", "depth_ok", "sst_ok")


@register("target_grid", ["v_tracks"],
          "with b as (select floor(min(lon) / 0.1 + 1e-9) * 0.1 as x0, ceil(max(lon) / 0.1 - 1e-9) * 0.1 as x1, "
          "floor(min(lat) / 0.1 + 1e-9) * 0.1 as y0, ceil(max(lat) / 0.1 - 1e-9) * 0.1 as y1 from v_tracks), "
          "n as (select x0, y0, cast(round((x1 - x0) / 0.1) as bigint) + 1 as nx, "
          "cast(round((y1 - y0) / 0.1) as bigint) + 1 as ny from b), "
          "ids as (select x0, y0, nx, unnest(range(0, nx * ny)) as id from n) "
          "select cast(id // nx as int) as lat_idx, cast(id % nx as int) as lon_idx, "
          f"{r('y0 + cast(id // nx as double) * 0.1')} as lat, {r('x0 + cast(id % nx as double) * 0.1')} as lon from ids")
def q_target_grid(spark, sf):
    bbox = G.data_bbox(spark.table("v_tracks"), 0.1)
    return report(G.target_grid(spark, bbox, 0.1))


@register("weekly_mondays", ["v_tracks"],
          "select cast(unnest(generate_series(cast(min(ts) as date) + cast((7 - isodow(min(ts)) + 1) % 7 as int), "
          "cast(max(ts) as date), interval 7 day)) as date) as week_start from v_tracks")
def q_weekly_mondays(spark, sf):
    b = spark.table("v_tracks").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    return G.weekly_mondays(spark, str(b["lo"].date()), str(b["hi"].date()))


@register("week_spine", ["v_cube"],
          "select cast(unnest(generate_series(min(w), max(w), interval 7 day)) as date) as week from "
          "(select cast(date_trunc('week', time) as date) + 6 as w from v_cube) s")
def q_week_spine(spark, sf):
    weeks = spark.table("v_cube").select(tf.week_label("time").alias("week"))
    return G.week_spine(weeks, "week")


UNIFORM_SQL = "cast(('0x' || substr(md5('42:' || stage || ':' || cast(attempt as varchar) || ':{axis}'), 1, 8)) as ubigint) / 4294967296"

STAGE_TARGETS_SQL = (
    f"targets as (select life_stage as stage, count(*) as n_target from (select t.event_id, {STAGE_SQL} as life_stage "
    "from v_tracks t join v_individuals i on t.shark_id = i.id where i.species = 'Carcharodon carcharias') p "
    "where life_stage in ('Adult_Male', 'Adult_Female', 'Juvenile') group by life_stage)")


@register("absence_candidates", ["v_tracks", "v_individuals"],
          f"with {STAGE_TARGETS_SQL}, c as (select stage, n_target, unnest(range(0, n_target * 10)) as attempt "
          "from targets) select stage, attempt, "
          f"{r('-130.0 + ' + UNIFORM_SQL.format(axis='lon') + ' * 20.0')} as lon, "
          f"{r('25.0 + ' + UNIFORM_SQL.format(axis='lat') + ' * 20.0')} as lat from c")
def q_absence_candidates(spark, sf):
    from ..operators import synthetic as S
    presence = S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))
    targets = S.stage_targets(presence, 1.0)
    return report(G.absence_candidates(spark, targets, BBOX).select("stage", "attempt", "lon", "lat"))


@register("buffer_ring", ["v_lane_vertices"],
          "select lane_id, vertex_no, cast(k as int) as k, "
          f"{r('lon + (10.0 / 111.0) * cos(cast(k as double) * (2 * pi() / 64))')} as x, "
          f"{r('lat + (10.0 / 111.0) * sin(cast(k as double) * (2 * pi() / 64))')} as y "
          "from v_lane_vertices, range(0, 65) t(k)")
def q_buffer_ring(spark, sf):
    df = G.buffer_ring(spark.table("v_lane_vertices"), 10.0)
    return report(G.buffer_vertices(df))


@register("union_sources", ["v_occurrences"],
          "select occ_id, species_name, source, event_date, lon, lat from v_occurrences where source = 'OBIS' "
          "union all select occ_id, species_name, source, null as event_date, lon, lat from v_occurrences "
          "where source = 'GBIF'")
def q_union(spark, sf):
    occ = spark.table("v_occurrences")
    obis = occ.filter(F.col("source") == "OBIS")
    gbif = occ.filter(F.col("source") == "GBIF").drop("event_date")
    return U.union_sources([obis, gbif]).select("occ_id", "species_name", "source", "event_date", "lon", "lat")


@register("limit_records", ["v_occurrences"],
          "select occ_id, species_name from (select occ_id, species_name, row_number() over "
          "(partition by species_name order by occ_id) as rn from v_occurrences) s where rn <= 300")
def q_limit(spark, sf):
    return U.limit_records(spark.table("v_occurrences"), 300, "species_name", "occ_id").select(
        "occ_id", "species_name")


@register("stage_counts", ["v_tracks", "v_individuals"],
          f"select life_stage, count(*) as n_points, count(distinct shark_id) as n_individuals from "
          f"(select t.shark_id, {STAGE_SQL} as life_stage from v_tracks t join v_individuals i on t.shark_id = i.id "
          "where i.species = 'Carcharodon carcharias') p "
          "group by life_stage")
def q_stage_counts(spark, sf):
    from ..operators import synthetic as S
    presence = S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))
    return U.stage_counts(presence, "life_stage")
