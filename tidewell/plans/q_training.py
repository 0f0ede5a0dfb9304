"""Checked queries for the training table.

The products write their layers once (``operators.store``): static ones by
cell, weekly ones by grid line. Stacking joins them bucket to bucket (J12);
presence and absence points are combined with temporal features (U2, P15,
P16), snapped to their cell and week, and sent to the layers' buckets (J11).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import columns as C
from ..operators import features as FE
from ..operators import grid as G
from ..operators import resample as RS
from ..operators import spatial as SP
from ..operators import synthetic as S
from ..operators import lines as LN
from ..operators import store
from ..operators import temporal as T
from .q_cluster import rookery_layer
from .q_density import NURSERY_SQL, _nursery, orca_layer
from .q_grid import (CELL, GRID01, H_KM_01, OCEAN, STRIP, bathymetry_layer, linear_map_sql, nearest_map_sql, ocean_layer,
                     ocean_sql, oxygen_layer, week_strips)
from .q_spatial import PRESENCE_SQL
from .registry import RAW_ORACLES, register, report

BBOX = tf.DEFAULT_BBOX
#: Static layers and the checked products that they come from.
SOURCES = {"lane_distance": ("Dist_to_Shipping_Lane_km",), "product_bathymetry": ("Depth_m", "Slope_deg"),
           "product_oxygen": ("Oxygen_bottom_ml_L",), "product_rookery_distance": ("Dist_to_Rookery_km",),
           "product_orca_density": ("Orca_Density_Index",), "nursery_layer": ("Nursery_Index",)}
LAYERS = tuple(v for values in SOURCES.values() for v in values)
#: Weekly variables, in the order of their layers.
WEEKLY = tuple(v for columns, _ in OCEAN.values() for v in columns)
EFFORT = "Fishing_Effort_h_km2"
STATIC_VIEWS = ["v_lane_vertices", "v_surface", "v_oxygen", "v_occurrences"]


@register("nursery_layer", ["v_surface"],
          NURSERY_SQL + f", {GRID01}, nur as (select 25.0 + cast(lat_idx as double) * 0.5 as lat, "
          "-130.0 + cast(lon_idx as double) * 0.5 as lon, cast(Nursery_Index as double) as v from idx), "
          f"{nearest_map_sql('lat_', 'nur', 'lat', 'grid', 'lat_idx')}, "
          f"{nearest_map_sql('lon_', 'nur', 'lon', 'grid', 'lon_idx')} "
          "select g.lat_idx, g.lon_idx, nur.v as Nursery_Index from grid g left join lat_m la on g.lat_idx = la.idx "
          "left join lon_m lo on g.lon_idx = lo.idx left join nur on nur.lat = la.s and nur.lon = lo.s")
def q_nursery_layer(spark, sf):
    """Q13 on the target grid (J8), as the training table uses it."""
    grid = G.target_grid(spark, BBOX, 0.1)
    index = _nursery(spark).select((F.lit(25.0) + F.col("lat_idx").cast("double") * F.lit(0.5)).alias("lat"),
                                   (F.lit(-130.0) + F.col("lon_idx").cast("double") * F.lit(0.5)).alias("lon"),
                                   F.col("Nursery_Index").cast("double").alias("Nursery_Index"))
    return RS.resample(index, grid, ["Nursery_Index"], "nearest")


def _static_layers(spark, sf):
    """All static layers, one row per cell."""
    spine = store.layer(spark, sf, "cells", CELL, lambda: G.target_grid(spark, BBOX, 0.1).select(*CELL))
    lanes = store.layer(spark, sf, "lane_distance", CELL, lambda: SP.nearest_distance(
        G.target_grid(spark, BBOX, 0.1), spark.table("v_lane_vertices"), 500.0, out="Dist_to_Shipping_Lane_km")
        .select(*CELL, "Dist_to_Shipping_Lane_km"))
    nursery = store.layer(spark, sf, "nursery", CELL, lambda: q_nursery_layer.__wrapped__(spark, sf))
    return store.side_by_side(spine, [lanes, bathymetry_layer(spark, sf), oxygen_layer(spark, sf), rookery_layer(spark, sf),
                                      orca_layer(spark, sf), nursery], CELL)


def effort_layer(spark, sf):
    """Q9 as a stored layer of strips."""
    return store.layer(spark, sf, "effort", STRIP, lambda: LN.as_strips(
        T.effort_grid(C.filter_gear(spark.table("v_effort_season"))).drop("n_records"), EFFORT))


def stack_weekly(spark, sf):
    """Every strip of the grid in every week that any layer has, with all weekly layers."""
    effort, ocean = effort_layer(spark, sf), ocean_layer(spark, sf)

    def build():
        both = week_strips(spark, sf).select("week").unionByName(effort.select("week"))
        span = both.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
        return LN.every_strip(span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week")), BBOX, 0.1)

    return store.side_by_side(store.layer(spark, sf, "stack_weeks", STRIP, build), [ocean, effort], STRIP)


def _stack_sql(alias: str) -> str:
    """The stack as a grouped union; ``with recursive`` parts stay inside their own subquery."""
    parts = []
    for n, (key, values) in enumerate(SOURCES.items()):
        cols = ", ".join(v if v in values else f"cast(null as double) as {v}" for v in LAYERS)
        parts.append(f"select lat_idx, lon_idx, {cols} from ({RAW_ORACLES[key]}) {alias}{n}")
    return (f"select lat_idx, lon_idx, {', '.join(f'max({v}) as {v}' for v in LAYERS)} from ("
            + " union all ".join(parts) + ") u group by 1, 2")


@register("stack_layers", STATIC_VIEWS, _stack_sql("l"))
def q_stack(spark, sf):
    """All static layers as one row per cell."""
    return report(_static_layers(spark, sf))


def _stack_weekly_sql() -> str:
    n_cells = 201 * 201
    parts, joins = [], []
    for i, (name, (columns, _)) in enumerate(OCEAN.items()):
        joins.append(f"left join (select week, {', '.join(f'count({v}) as n_{v}, round(avg({v}), 9) + 0.0 as {v}_mean' for v in columns)} "
                     f"from ({ocean_sql(name)}) o group by week) l{i} on w.week = l{i}.week")
        parts += [f"coalesce(l{i}.n_{v}, 0) as n_{v}, l{i}.{v}_mean" for v in columns]
    return (f"with {EFFORT_LAYER_SQL}, oc_span as (select min(date) + 6 as lo, max(date) + 6 as hi from v_ocean), "
            "span as (select least(o.lo, e.lo) as lo, greatest(o.hi, e.hi) as hi from oc_span o, "
            "(select min(week) as lo, max(week) as hi from eff) e), "
            "w as (select cast(unnest(generate_series(lo, hi, interval 7 day)) as date) as week from span), "
            f"ef as (select week, count(*) as n, round(avg({EFFORT}), 9) + 0.0 as m from eff group by week) "
            f"select w.week, cast({n_cells} as bigint) as n_cells, {', '.join(parts)}, coalesce(ef.n, 0) as n_{EFFORT}, "
            f"ef.m as {EFFORT}_mean from w {' '.join(joins)} left join ef on w.week = ef.week")


def _points(spark, buffer_km: float = 5.0):
    presence = S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))
    absence = S.generate_absence(presence, BBOX, buffer_km)
    p = presence.select(F.col("event_id").cast("string").alias("point_id"), F.col("life_stage").alias("Life_Stage"),
                        F.col("ts").alias("Date"), "lon", "lat")
    a = absence.select(F.concat_ws(":", "Life_Stage", F.col("attempt").cast("string")).alias("point_id"),
                       "Life_Stage", "lon", "lat")
    return FE.combine_presence_absence(p, a)


COMBINED_SQL = (
    "pa as (select cast(event_id as varchar) as point_id, 1 as Shark_Presence_Status, life_stage as Life_Stage, "
    "ts as Date, lon, lat from presence union all select Life_Stage || ':' || cast(attempt as varchar), "
    "0, Life_Stage, null, lon, lat from ({absence}) ab), "
    "pf as (select *, cast(month(Date) as int) as Month, cast(weekofyear(Date) as int) as Week_of_Year, "
    "case when month(Date) in (12, 1, 2) then 'Winter' when month(Date) in (3, 4, 5) then 'Spring' "
    "when month(Date) in (6, 7, 8) then 'Summer' when month(Date) is null then null else 'Autumn' end as Season from pa)")


def _combined_sql() -> str:
    return COMBINED_SQL.format(absence=RAW_ORACLES["product_absence"])


@register("combine_presence_absence", ["v_tracks", "v_individuals"],
          f"with {PRESENCE_SQL}, {_combined_sql()} select point_id, Shark_Presence_Status, Life_Stage, Date, "
          "round(lon, 9) + 0.0 as lon, round(lat, 9) + 0.0 as lat, Month, Week_of_Year, Season from pf")
def q_combine(spark, sf):
    """U2 (+P15, P16): presence and 5 km absence points with temporal features."""
    return report(_points(spark).select("point_id", "Shark_Presence_Status", "Life_Stage", "Date", "lon", "lat",
                                        "Month", "Week_of_Year", "Season"))


EFFORT_LAYER_SQL = ("eff as (select cast(date_trunc('week', ts) as date) + 6 as week, "
                    "cast(floor((lat - 25.0) / 0.1 + 0.5) as int) as lat_idx, "
                    "cast(floor((lon - -130.0) / 0.1 + 0.5) as int) as lon_idx, "
                    f"coalesce(sum(hours), 0.0) / {(0.1 * tf.KM_PER_DEG) ** 2!r} as Fishing_Effort_h_km2 "
                    "from v_effort_season where gear in ('tuna_purse_seines', 'drifting_longlines') group by 1, 2, 3)")


@register("stack_weekly_layers", ["v_ocean", "v_effort_season"], _stack_weekly_sql())
def q_stack_weekly(spark, sf):
    """J12 on the weekly layers, reported week by week: values, means, and the hours of effort."""
    sums = [x for v in WEEKLY for x in (LN.count(v).alias(f"n_{v}"), LN.total(F.col(v)).alias(f"s_{v}"))]
    sums += [F.coalesce(F.size(EFFORT), F.lit(0)).cast("long").alias(f"n_{EFFORT}"), LN.total(F.map_values(EFFORT)).alias(f"s_{EFFORT}")]
    names, (n_lat, n_lon) = (*WEEKLY, EFFORT), G.grid_shape(BBOX, 0.1)
    weeks = stack_weekly(spark, sf).select("week", *sums).groupBy("week").agg(*[F.sum(f"{p}_{v}").alias(f"{p}_{v}") for v in names for p in "ns"])
    means = [c for v in names for c in (F.col(f"n_{v}"), F.when(F.col(f"n_{v}") > 0, F.col(f"s_{v}") / F.col(f"n_{v}")).alias(f"{v}_mean"))]
    return report(weeks.select("week", F.lit(n_lat * n_lon).cast("long").alias("n_cells"), *means))


@register("extract_features", ["v_tracks", "v_individuals", "v_effort_season"],
          f"with {PRESENCE_SQL}, {EFFORT_LAYER_SQL} select p.event_id, p.lat_idx, p.lon_idx, "
          "round(e.Fishing_Effort_h_km2, 9) + 0.0 as Fishing_Effort_h_km2 from (select event_id, "
          "cast(date_trunc('week', ts) as date) + 6 as week, cast(floor((lat - 25.0) / 0.1 + 0.5) as int) as lat_idx, "
          "cast(floor((lon - -130.0) / 0.1 + 0.5) as int) as lon_idx from presence) p left join eff e "
          "on p.week = e.week and p.lat_idx = e.lat_idx and p.lon_idx = e.lon_idx")
def q_extract(spark, sf):
    """Weekly fishing effort at each presence point (snap to cell, match week)."""
    presence = S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))
    pts = presence.select("event_id", F.col("ts").alias("Date"), "lon", "lat")
    effort = T.effort_grid(C.filter_gear(spark.table("v_effort_season"))).drop("n_records")
    out = FE.extract_features(pts, dynamic=[effort], static=[], date_col="Date")
    return report(out.select("event_id", "lat_idx", "lon_idx", "Fishing_Effort_h_km2"))


def _weekly_at_points_sql() -> str:
    """CTEs ending in ``wk``: the weekly variables at the cells of ``pts`` (and, for the gradient, their neighbours)."""
    names = {aliases[0]: columns[0] for columns, aliases in OCEAN.values()}
    return (
        "need as (select distinct p.week, p.lat_idx + dy as lat_idx, p.lon_idx + dx as lon_idx from pts p, "
        "(values (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) o(dy, dx) where p.week is not null), "
        f"{GRID01}, oc as (select date as time, latitude as lat, longitude as lon, {', '.join(names)} from v_ocean), "
        f"{linear_map_sql('lat_', 'oc', 'lat', 'grid', 'lat_idx')}, {linear_map_sql('lon_', 'oc', 'lon', 'grid', 'lon_idx')}, "
        "rr as (select oc.time, n.week, n.lat_idx, n.lon_idx, "
        + ", ".join(f"case when count({v}) = 4 then sum(la.w * lo.w * {v}) end as {v}" for v in names)
        + " from oc join lat_m la on oc.lat = la.s join lon_m lo on oc.lon = lo.s join need n on n.lat_idx = la.idx "
        "and n.lon_idx = lo.idx and n.week = cast(date_trunc('week', oc.time) as date) + 6 group by 1, 2, 3, 4), "
        f"wv as (select week, lat_idx, lon_idx, {', '.join(f'avg({v}) as {v}' for v in names)} from rr group by 1, 2, 3), "
        "wg as (select c.*, case when c.lon_idx = 0 then (e.sst - c.sst) / {h!r} when c.lon_idx = 200 then (c.sst - w.sst) / {h!r} "
        "else (e.sst - w.sst) / {h2!r} end as dx, case when c.lat_idx = 0 then (n.sst - c.sst) / {h!r} "
        "when c.lat_idx = 200 then (c.sst - s.sst) / {h!r} else (n.sst - s.sst) / {h2!r} end as dy from wv c "
        "left join wv e on e.week = c.week and e.lat_idx = c.lat_idx and e.lon_idx = c.lon_idx + 1 "
        "left join wv w on w.week = c.week and w.lat_idx = c.lat_idx and w.lon_idx = c.lon_idx - 1 "
        "left join wv n on n.week = c.week and n.lat_idx = c.lat_idx + 1 and n.lon_idx = c.lon_idx "
        "left join wv s on s.week = c.week and s.lat_idx = c.lat_idx - 1 and s.lon_idx = c.lon_idx), ".format(h=H_KM_01, h2=2.0 * H_KM_01)
        + "wk as (select week, lat_idx, lon_idx, " + ", ".join(f"round({v}, 9) + 0.0 as {out}" for v, out in names.items())
        + ", round(sqrt(dx * dx + dy * dy), 9) + 0.0 as SST_grad_C_km from wg)")


@register("product_training_table", ["v_tracks", "v_individuals", "v_effort_season", "v_ocean", *STATIC_VIEWS],
          f"with {PRESENCE_SQL}, {_combined_sql()}, {EFFORT_LAYER_SQL}, st as ({_stack_sql('s')}), "
          "pts as (select *, cast(date_trunc('week', Date) as date) + 6 as week, "
          "cast(floor((lat - 25.0) / 0.1 + 0.5) as int) as lat_idx, "
          "cast(floor((lon - -130.0) / 0.1 + 0.5) as int) as lon_idx from pf), "
          f"{_weekly_at_points_sql()} "
          "select p.point_id, p.Shark_Presence_Status, p.Life_Stage, p.Date, round(p.lon, 9) + 0.0 as lon, "
          "round(p.lat, 9) + 0.0 as lat, p.Month, p.Week_of_Year, p.Season, p.lat_idx, p.lon_idx, "
          f"{', '.join(f'st.{v}' for v in LAYERS)}, {', '.join(f'wk.{v}' for v in WEEKLY)}, "
          f"round(e.{EFFORT}, 9) + 0.0 as {EFFORT} from pts p "
          "left join st on p.lat_idx = st.lat_idx and p.lon_idx = st.lon_idx "
          "left join eff e on p.week = e.week and p.lat_idx = e.lat_idx and p.lon_idx = e.lon_idx "
          "left join wk on p.week = wk.week and p.lat_idx = wk.lat_idx and p.lon_idx = wk.lon_idx")
def q_training(spark, sf):
    """Q14: presence + absence points with temporal features and all 13 variables: seven static ones of
    their cell; five ocean variables and fishing effort of their cell and week."""
    pts = FE.extract_features(_points(spark), date_col="Date")
    # static values are rounded by cell: the columns of all layers in one projection make a method too long to compile
    placed = pts.join(report(_static_layers(spark, sf)).hint("merge"), CELL, "left")
    out = LN.at_places(placed, [ocean_layer(spark, sf), effort_layer(spark, sf)])
    out = out.select("point_id", "Shark_Presence_Status", "Life_Stage", "Date", "lon", "lat", "Month",
                     "Week_of_Year", "Season", "lat_idx", "lon_idx", *LAYERS, *WEEKLY, EFFORT)
    return report(out, keep=LAYERS)
