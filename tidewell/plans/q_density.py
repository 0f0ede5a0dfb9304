"""Checked queries for density, scaling and the nursery index.

Survey rows C3, A10-A15, P21 and products Q8, Q13.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import density as D
from ..operators import grid as G
from ..operators import store
from ..operators import synthetic as S
from ..operators import terrain as TR
from .q_grid import CELL, H_M_05, SURFACE_GRID_SQL, _surface_grid
from .registry import register, report

BBOX = tf.DEFAULT_BBOX
GRID01 = ("grid as (select cast(id // 201 as int) as lat_idx, cast(id % 201 as int) as lon_idx, "
          "25.0 + cast(id // 201 as double) * 0.1 as lat, -130.0 + cast(id % 201 as double) * 0.1 as lon "
          "from range(0, 201 * 201) t(id))")
ORCA_SQL = ("o as (select lon, lat from v_occurrences where species_name = 'Orcinus orca' "
            "and lon is not null and lat is not null), "
            "st as (select count(*) as n, var_samp(lon) * (pow(count(*), -1.0 / 6.0) * pow(count(*), -1.0 / 6.0)) as a, "
            "covar_samp(lon, lat) * (pow(count(*), -1.0 / 6.0) * pow(count(*), -1.0 / 6.0)) as b, "
            "var_samp(lat) * (pow(count(*), -1.0 / 6.0) * pow(count(*), -1.0 / 6.0)) as d from o), "
            "inv as (select n, a * d - b * b as det, d / (a * d - b * b) as i11, -b / (a * d - b * b) as i12, "
            "a / (a * d - b * b) as i22 from st), "
            "pts as (select lon, lat, count(*) as w from o group by 1, 2), "
            "s as (select g.lat_idx, g.lon_idx, sum(p.w * exp(-0.5 * (i.i11 * (g.lon - p.lon) * (g.lon - p.lon) + "
            "(2.0 * i.i12) * (g.lon - p.lon) * (g.lat - p.lat) + i.i22 * (g.lat - p.lat) * (g.lat - p.lat)))) as s "
            "from grid g, pts p, inv i group by 1, 2)")


def _orca(spark):
    return spark.table("v_occurrences").filter(F.col("species_name") == tf.ORCA)


@register("sample_covariance", ["v_occurrences"],
          "select count(*) as n, round(var_samp(lon), 9) + 0.0 as var_lon, round(var_samp(lat), 9) + 0.0 as var_lat, "
          "round(covar_samp(lon, lat), 9) + 0.0 as cov_lon_lat, round(pow(count(*), -1.0 / 6.0), 9) + 0.0 "
          "as scott_factor from v_occurrences where species_name = 'Orcinus orca' and lon is not null and lat is not null")
def q_cov(spark, sf):
    """Orca sighting covariance and Scott's factor."""
    return report(D.sample_covariance(_orca(spark)))


@register("kde_density", ["v_occurrences"],
          f"with {GRID01}, {ORCA_SQL} select s.lat_idx, s.lon_idx, round(s.s / (i.n * 2.0 * pi() * sqrt(i.det)), 9) "
          "+ 0.0 as density from s, inv i")
def q_kde(spark, sf):
    """Orca sighting density on the 0.1-degree grid (Gaussian KDE, Scott)."""
    cells = G.target_grid(spark, BBOX, 0.1)
    return report(D.kde_density(cells, _orca(spark)).select("lat_idx", "lon_idx", "density"))


@register("product_orca_density", ["v_occurrences"],
          f"with {GRID01}, {ORCA_SQL}, mm as (select min(s) as lo, max(s) as hi from s) "
          "select s.lat_idx, s.lon_idx, round((s.s - mm.lo) / (mm.hi - mm.lo), 9) + 0.0 as Orca_Density_Index "
          "from s, mm")
def q_orca_density(spark, sf):
    """Q8: U1 -> P1 -> C3 scaled to [0, 1]."""
    return report(orca_layer(spark, sf))


def orca_layer(spark, sf):
    def build():
        return (D.density_index(G.target_grid(spark, BBOX, 0.1), _orca(spark))
                 .select("lat_idx", "lon_idx", "Orca_Density_Index"))

    return store.layer(spark, sf, "orca_density", CELL, build)


@register("minmax_scale", ["v_surface"],
          "select lat_idx, lon_idx, round((chl - (select min(chl) from v_surface)) / "
          "((select max(chl) from v_surface) - (select min(chl) from v_surface)), 9) + 0.0 as chl_scaled from v_surface")
def q_minmax(spark, sf):
    """A13 on surface chlorophyll."""
    s = spark.table("v_surface").select("lat_idx", "lon_idx", "chl")
    return report(D.minmax_scale(s, "chl", "chl_scaled").select("lat_idx", "lon_idx", "chl_scaled"))


@register("global_mean", ["v_surface"],
          "select lat_idx, lon_idx, coalesce(chl > (select avg(chl) from v_surface), false) as chl_above_mean, "
          "round((select avg(chl) from v_surface), 9) + 0.0 as chl_mean from v_surface")
def q_global_mean(spark, sf):
    """A10: grid mean as a threshold (one scalar, applied to every cell)."""
    s = spark.table("v_surface")
    m = S.global_mean(s, "chl")
    return report(s.select("lat_idx", "lon_idx", F.coalesce(F.col("chl") > F.lit(m), F.lit(False)).alias("chl_above_mean"),
                           F.lit(m).alias("chl_mean")))


@register("summer_mean", ["v_cube"],
          "select lat, lon, round(avg(m), 9) + 0.0 as sst_summer from (select year(time) as f, lat, lon, "
          "avg(value) as m from v_cube where month(time) in (6, 7, 8) group by 1, 2, 3) q group by 1, 2")
def q_summer(spark, sf):
    """Per-year ('file') summer mean per cell, then mean over years."""
    c = spark.table("v_cube").withColumn("file", F.year("time"))
    return report(S.per_file_mean(c, "value", "file", months=tf.SUMMER_MONTHS, out="sst_summer"))


@register("chlorophyll_mean", ["v_cube"],
          "select lat, lon, round(avg(m), 9) + 0.0 as chl_mean from (select year(time) as f, lat, lon, "
          "avg(value) as m from v_cube group by 1, 2, 3) q group by 1, 2")
def q_chl_mean(spark, sf):
    """Per-year mean per cell, then mean over years."""
    c = spark.table("v_cube").withColumn("file", F.year("time"))
    return report(S.per_file_mean(c, "value", "file", out="chl_mean"))


NURSERY_SQL = (
    f"with {SURFACE_GRID_SQL}, d as (select g.lat_idx, g.lon_idx, g.n_lat, g.n_lon, "
    "case when s.elevation < 0 then -s.elevation else 0.0 end as v, s.sst, s.chl "
    "from sgrid g left join v_surface s on g.lat_idx = s.lat_idx and g.lon_idx = s.lon_idx), "
    "dd as (select lat_idx, lon_idx, v, sst, chl, "
    f"case when lon_idx = 0 then (lead(v) over wr - v) / {H_M_05!r} when lon_idx = n_lon - 1 then "
    f"(v - lag(v) over wr) / {H_M_05!r} else (lead(v) over wr - lag(v) over wr) / {2.0 * H_M_05!r} end as dx, "
    f"case when lat_idx = 0 then (lead(v) over wc - v) / {H_M_05!r} when lat_idx = n_lat - 1 then "
    f"(v - lag(v) over wc) / {H_M_05!r} else (lead(v) over wc - lag(v) over wc) / {2.0 * H_M_05!r} end as dy "
    "from d window wr as (partition by lat_idx order by lon_idx), wc as (partition by lon_idx order by lat_idx)), "
    "cm as (select avg(chl) as m from dd), "
    "crit as (select lat_idx, lon_idx, coalesce(v > 0 and v < 100.0, false) as depth_ok, "
    "coalesce(degrees(atan(sqrt(dx * dx + dy * dy))) < 5.0, false) as slope_ok, coalesce(sst > 16.0, false) as sst_ok, "
    "coalesce(chl > cm.m, false) as chl_ok, cm.m as chl_mean from dd, cm), "
    "idx as (select *, cast(cast(depth_ok as int) * 0.25 + cast(slope_ok as int) * 0.25 + cast(sst_ok as int) * 0.25 "
    "+ cast(chl_ok as int) * 0.25 as float) as Nursery_Index from crit)")


def _nursery(spark):
    grid, n_lat, n_lon = _surface_grid(spark)
    s = spark.table("v_surface").select(F.col("lat_idx").cast("int"), F.col("lon_idx").cast("int"),
                                        "elevation", F.col("sst").alias("sst_summer"), "chl")
    dense = TR.densify(s, grid).withColumn("depth_m", tf.elevation_to_depth("elevation"))
    layers = TR.slope_degrees(dense, "depth_m", 0.5, n_lat, n_lon, out="slope_deg")
    return S.nursery_index(layers)


@register("product_nursery_index", ["v_surface"],
          NURSERY_SQL + " select lat_idx, lon_idx, depth_ok, slope_ok, sst_ok, chl_ok, Nursery_Index from idx")
def q_nursery(spark, sf):
    """Q13 on the 0.5-degree surface (depth, slope, summer SST, chlorophyll)."""
    return _nursery(spark).select("lat_idx", "lon_idx", "depth_ok", "slope_ok", "sst_ok", "chl_ok", "Nursery_Index")


@register("index_summary", ["v_surface"],
          NURSERY_SQL + " select cast(count_if(depth_ok) as bigint) as n_depth_ok, "
          "cast(count_if(slope_ok) as bigint) as n_slope_ok, cast(count_if(sst_ok) as bigint) as n_sst_ok, "
          "cast(count_if(chl_ok) as bigint) as n_chl_ok, min(Nursery_Index) as index_min, "
          "max(Nursery_Index) as index_max, cast(count_if(Nursery_Index >= 0.75) as bigint) as n_high, "
          "round(first(chl_mean), 9) + 0.0 as chl_mean from idx")
def q_index_summary(spark, sf):
    """A15 over the Q13 result."""
    return report(S.index_summary(_nursery(spark)))


@register("clamp_criteria_index", ["v_surface"],
          NURSERY_SQL + " select Nursery_Index, count(*) as n_cells from idx group by 1")
def q_index_hist(spark, sf):
    """P21 outcome: cells per index level (0, .25, .5, .75, 1)."""
    return _nursery(spark).groupBy("Nursery_Index").agg(F.count(F.lit(1)).alias("n_cells"))
