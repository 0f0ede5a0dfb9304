"""Checked queries for clustering and the rookery distance product.

Survey rows C1, C2, A9, J2, Q7. The oracle is a textbook DBSCAN in SQL:
brute-force neighbour pairs, core flags, a recursive CTE for reachability
between core points, border = smallest neighbouring cluster.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import cluster as CL
from ..operators import grid as G
from ..operators import spatial as SP
from ..operators import store
from .q_grid import CELL
from .q_spatial import GRID_SQL, _rd2
from .registry import register, report

BBOX = tf.DEFAULT_BBOX
EPS_KM = 10.0
MIN_SAMPLES = 10

DBSCAN_SQL = (
    "p as (select occ_id, lon, lat from v_occurrences where species_name <> 'Orcinus orca' "
    "and lon is not null and lat is not null), "
    "nb as (select a.occ_id as a, b.occ_id as b from p a join p b on "
    f"(a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat) <= {_rd2(EPS_KM)}), "
    f"core as (select a as id from nb group by a having count(*) >= {MIN_SAMPLES}), "
    "ce as (select nb.a, nb.b from nb join core c1 on nb.a = c1.id join core c2 on nb.b = c2.id), "
    "reach(id, comp) as (select id, id from core union select ce.b, reach.comp from reach join ce on reach.id = ce.a), "
    "comp as (select id, min(comp) as c from reach group by id), "
    "lab as (select id, dense_rank() over (order by c) - 1 as cluster from comp), "
    "border as (select nb.a as id, min(lab.cluster) as cluster from nb join lab on nb.b = lab.id "
    "where nb.a not in (select id from core) group by nb.a), "
    "labels as (select p.occ_id, p.lon, p.lat, cast(coalesce(lab.cluster, border.cluster, -1) as bigint) as cluster "
    "from p left join lab on p.occ_id = lab.id left join border on p.occ_id = border.id)")

ROOKERY_SQL = ("rook as (select cluster, avg(lon) as lon, avg(lat) as lat, "
               "count(*) as Observation_Count from labels where cluster <> -1 group by cluster)")


def _prey(spark):
    return spark.table("v_occurrences").filter(F.col("species_name") != tf.ORCA)


@register("dbscan_labels", ["v_occurrences"], f"with recursive {DBSCAN_SQL} select occ_id, cluster from labels")
def q_dbscan(spark, sf):
    """DBSCAN on prey sightings, eps 10 km, min_samples 10 (pipeline setting)."""
    return CL.dbscan(_prey(spark), EPS_KM, MIN_SAMPLES, "occ_id")


@register("filter_rookeries", ["v_occurrences"],
          f"with recursive {DBSCAN_SQL}, {ROOKERY_SQL} select cluster, round(lon, 9) + 0.0 as lon, "
          "round(lat, 9) + 0.0 as lat, Observation_Count from rook")
def q_rookeries(spark, sf):
    """C2 (with A9/J2): rookery centroids and observation counts."""
    return report(CL.filter_rookeries(_prey(spark), MIN_SAMPLES, EPS_KM, "occ_id"))


@register("product_rookery_distance", ["v_occurrences"],
          f"with recursive {DBSCAN_SQL}, {ROOKERY_SQL}, {GRID_SQL} "
          "select g.lat_idx, g.lon_idx, round(least(sqrt(min((g.lon - r.lon) * (g.lon - r.lon) + "
          "(g.lat - r.lat) * (g.lat - r.lat))) * 111.0, 500.0), 9) + 0.0 as Dist_to_Rookery_km "
          "from grid g, rook r group by 1, 2")
def q_rookery_distance(spark, sf):
    """Q7: U1 -> P1 -> C2 -> J3 -> P20 on the 0.1-degree grid."""
    return report(rookery_layer(spark, sf))


def rookery_layer(spark, sf):
    def build():
        rook = CL.filter_rookeries(_prey(spark), MIN_SAMPLES, EPS_KM, "occ_id")
        out = SP.nearest_distance(G.target_grid(spark, BBOX, 0.1), rook, 500.0, out="Dist_to_Rookery_km")
        return out.select("lat_idx", "lon_idx", "Dist_to_Rookery_km")

    return store.layer(spark, sf, "rookery_distance", CELL, build)


@register("cluster_centroids", ["v_occurrences"],
          f"with recursive {DBSCAN_SQL} select cluster, round(avg(lon), 9) + 0.0 as lon, round(avg(lat), 9) + 0.0 "
          "as lat, count(*) as Observation_Count from labels group by cluster")
def q_centroids(spark, sf):
    """Mean position and size of every DBSCAN label (noise -1 included)."""
    prey = _prey(spark)
    labels = CL.dbscan(prey, EPS_KM, MIN_SAMPLES, "occ_id")
    pts = prey.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("occ_id", "lon", "lat")
    return report(CL.cluster_centroids(pts.join(labels, "occ_id")))
