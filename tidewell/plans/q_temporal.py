"""Checked queries for weekly aggregation, climatology and time alignment.

Survey rows A1-A8, A17-A19, W3, W6, J7 and product Q9.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import columns as C
from ..operators import temporal as T
from .registry import register, report

AREA_KM2 = (0.1 * tf.KM_PER_DEG) ** 2


def _weekly_sql(agg: str) -> str:
    return (
        "with wk as (select cast(date_trunc('week', time) as date) + 6 as week, lat, lon, value from v_cube), "
        f"agg as (select week, lat, lon, {agg} as value from wk group by 1, 2, 3), "
        "b as (select min(week) as lo, max(week) as hi from agg), "
        "cells as (select distinct lat, lon from agg), "
        "spine as (select c.lat, c.lon, cast(unnest(generate_series(b.lo, b.hi, interval 7 day)) as date) as week "
        "from cells c, b) "
        "select s.week, s.lat, s.lon, round(a.value, 9) + 0.0 as value from spine s left join agg a "
        "on s.week = a.week and s.lat = a.lat and s.lon = a.lon")


def _weekly(method):
    def q(spark, sf):
        return report(T.aggregate_weekly(spark.table("v_cube"), "value", method, "time", ("lat", "lon")))
    return q


for _key, _method, _agg in (("weekly_mean", "mean", "avg(value)"),
                            ("weekly_sum", "sum", "coalesce(sum(value), 0.0)"),
                            ("weekly_median", "median", "median(value)"),
                            ("weekly_max", "max", "max(value)"),
                            ("weekly_min", "min", "min(value)")):
    register(_key, ["v_cube"], _weekly_sql(_agg))(_weekly(_method))


@register("climatology_month", ["v_cube"],
          "select cast(month(time) as int) as month, lat, lon, round(avg(value), 9) + 0.0 as value "
          "from v_cube group by 1, 2, 3")
def q_clim_month(spark, sf):
    return report(T.climatology(spark.table("v_cube"), "value", "month"))


@register("climatology_week", ["v_cube"],
          "select cast(weekofyear(time) as int) as week, lat, lon, round(avg(value), 9) + 0.0 as value "
          "from v_cube group by 1, 2, 3")
def q_clim_week(spark, sf):
    return report(T.climatology(spark.table("v_cube"), "value", "week"))


@register("climatology_season", ["v_cube"],
          "select case when month(time) in (12, 1, 2) then 'DJF' when month(time) in (3, 4, 5) then 'MAM' "
          "when month(time) in (6, 7, 8) then 'JJA' else 'SON' end as season, lat, lon, "
          "round(avg(value), 9) + 0.0 as value from v_cube group by 1, 2, 3")
def q_clim_season(spark, sf):
    return report(T.climatology(spark.table("v_cube"), "value", "season"))


@register("fill_empty_weeks", ["v_tracks"],
          "with agg as (select cast(date_trunc('week', ts) as date) + 6 as week, shark_id, count(*) as n_pings "
          "from v_tracks group by 1, 2), b as (select min(week) as lo, max(week) as hi from agg), "
          "cells as (select distinct shark_id from agg), "
          "spine as (select c.shark_id, cast(unnest(generate_series(b.lo, b.hi, interval 7 day)) as date) as week "
          "from cells c, b) "
          "select s.week, s.shark_id, a.n_pings from spine s left join agg a on s.week = a.week "
          "and s.shark_id = a.shark_id")
def q_fill_weeks(spark, sf):
    t = spark.table("v_tracks")
    agg = (t.select(tf.week_label("ts").alias("week"), "shark_id")
            .groupBy("week", "shark_id").agg(F.count(F.lit(1)).alias("n_pings")))
    return T.fill_empty_weeks(agg, ["shark_id"])


@register("interpolate_weekly", ["v_series_a"],
          "with s as (select event_type, cast(day as timestamp) as t, value as v, "
          "lead(cast(day as timestamp)) over (partition by event_type order by day) as t2, "
          "lead(value) over (partition by event_type order by day) as v2, "
          "row_number() over (partition by event_type order by day) as rn from v_series_a), "
          "m as (select cast(unnest(generate_series(date '2024-01-01', date '2024-01-31', interval 7 day)) as date) "
          "as week_start) "
          "select s.event_type, m.week_start, round(s.v + (s.v2 - s.v) * (epoch(cast(m.week_start as timestamp)) "
          "- epoch(s.t)) / (epoch(s.t2) - epoch(s.t)), 9) + 0.0 as value "
          "from s join m on (cast(m.week_start as timestamp) > s.t or (s.rn = 1 and cast(m.week_start as timestamp) = s.t)) "
          "and cast(m.week_start as timestamp) <= s.t2 where s.t2 is not null")
def q_interp(spark, sf):
    return report(T.interpolate_weekly(spark.table("v_series_a"), "2024-01-01", "2024-01-31", "value",
                                       "day", ["event_type"]))


@register("align_series", ["v_series_a"],
          "select coalesce(a.day, b.day) as day, round(a.value, 9) + 0.0 as value_a, "
          "round(b.value, 9) + 0.0 as value_b from (select day, value from v_series_a where event_type = 'click') a "
          "full outer join (select day, value from v_series_a where event_type = 'view') b on a.day = b.day")
def q_align(spark, sf):
    s = spark.table("v_series_a")
    a = s.filter(F.col("event_type") == "click").select("day", F.col("value").alias("value_a"))
    b = s.filter(F.col("event_type") == "view").select(F.col("day").alias("date"), F.col("value").alias("value_b"))
    return report(T.align_series(a, b, ["day"], "outer", time_a="day", time_b="date"))


def _effort_sql(where: str) -> str:
    return ("select cast(date_trunc('week', ts) as date) + 6 as week, "
            "cast(floor((lat - 25.0) / 0.1 + 0.5) as int) as lat_idx, "
            "cast(floor((lon - -130.0) / 0.1 + 0.5) as int) as lon_idx, "
            f"round(coalesce(sum(hours), 0.0) / {AREA_KM2!r}, 9) + 0.0 as Fishing_Effort_h_km2, "
            f"count(*) as n_records from v_effort {where} group by 1, 2, 3")


@register("effort_grid", ["v_effort"], _effort_sql(""))
def q_effort_grid(spark, sf):
    return report(T.effort_grid(spark.table("v_effort")))


@register("product_fishing_effort", ["v_effort"],
          _effort_sql("where gear in ('tuna_purse_seines', 'drifting_longlines')"))
def q_product_effort(spark, sf):
    """Q9: P9 gear filter -> A17 weekly effort per km^2."""
    return report(T.effort_grid(C.filter_gear(spark.table("v_effort"))))


@register("bottom_value", ["v_oxygen"],
          "select lat_idx, lon_idx, round(max_by(o_an, depth_m) filter (where o_an is not null), 9) + 0.0 "
          "as Oxygen_bottom_ml_L, max(depth_m) filter (where o_an is not null) as bottom_depth_m "
          "from v_oxygen group by 1, 2")
def q_bottom(spark, sf):
    return report(T.bottom_value(spark.table("v_oxygen")))


@register("block_mean", ["v_effort"],
          "select ts, cast(floor((lat - 25.0) / 1.0 + 0.5) as int) as lat_idx, "
          "cast(floor((lon - -130.0) / 1.0 + 0.5) as int) as lon_idx, round(avg(hours), 9) + 0.0 as hours, "
          "count(hours) as n_pixels from v_effort group by 1, 2, 3")
def q_block_mean(spark, sf):
    return report(T.block_mean(spark.table("v_effort"), "hours", 1.0, time_col="ts"))
