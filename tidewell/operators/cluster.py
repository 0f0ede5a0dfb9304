"""Density clustering (C1 DBSCAN, C2 rookeries, A9 centroids).

DBSCAN on (lon, lat) degrees with ``eps = km / 111``, distances ``<= eps``,
``min_samples`` counting the point itself, noise = -1. Labels follow the
textbook sequential order: clusters are numbered by their smallest core
row id, and a border point joins the smallest-numbered cluster among its
core neighbours.

Distributed plan (no all-pairs, no group collected):

1. identical coordinates collapse to one location with a multiplicity;
2. core flags on cells of side ``eps/sqrt(2)`` (one cell lies within eps):
   a cell holding ``>= min_samples`` points is core without pair tests; only
   locations in sparse cells test their 5x5 neighbourhood. Links and borders
   use cells of side ``eps/(2 sqrt 2)``: any two points in the same or
   touching cells are within eps;
3. core cells are graph nodes (id = smallest core row id in the cell);
   touching core cells are linked outright, cells 2..3 apart that no core cell
   touches both are decided by the tight boxes of their quarters;
4. connected components: inside bounded super-tiles of cells with NumPy,
   then min-label propagation with pointer jumping over the edges that cross
   super-tiles (each round checkpointed to the shared checkpoint folder);
5. components are numbered by their smallest core id (block ranking),
   border points take the smallest cluster among core neighbours.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as tf
from . import spatial as SP
from .lineage import materialize
from .ranking import range_rank
from .spatial import _d2, with_tiles


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node",
                         max_rounds: int = 10_000) -> DataFrame:
    """Min-label components. ``nodes(node)``, ``edges(src, dst)`` (undirected).

    Returns ``(node, label)`` with label = smallest node id in the component.
    Each round: every node takes the smallest label among itself and its
    neighbours, then jumps to its label's label. Rounds stop when no row's
    label changes (one count per round, so any 64-bit ids are fine).
    """
    und = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    und = materialize(und.filter(F.col("src") != F.col("dst")).distinct(), "cc-edges")
    labels = materialize(nodes.select(F.col(node).alias("node"), F.col(node).alias("label")), "cc-labels")
    for _ in range(max_rounds):
        nb = (und.join(labels.withColumnRenamed("node", "dst"), "dst")
                 .groupBy("src").agg(F.min("label").alias("_m")))
        step = (labels.join(nb, labels["node"] == nb["src"], "left")
                      .select("node", F.col("label").alias("_was"),
                              F.least("label", F.coalesce("_m", "label")).alias("label")))
        jump = (step.alias("a").join(step.alias("b"), F.col("a.label") == F.col("b.node"), "left")
                    .select(F.col("a.node").alias("node"), F.col("a._was").alias("_was"),
                            F.least(F.col("a.label"), F.coalesce(F.col("b.label"), F.col("a.label"))).alias("label")))
        jump = materialize(jump, "cc-round")
        changed = jump.filter(F.col("label") != F.col("_was")).limit(1).count()
        labels = jump.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError("connected components did not converge")


def _local_min_labels(nodes: np.ndarray, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Smallest node id per connected component of a small graph (NumPy):
    min-label propagation with pointer jumping, all vectorised."""
    order = np.argsort(nodes)
    srt = nodes[order]
    u = order[np.searchsorted(srt, src)]
    v = order[np.searchsorted(srt, dst)]
    lab = nodes.astype(np.int64).copy()
    while True:
        new = lab.copy()
        np.minimum.at(new, u, lab[v])
        np.minimum.at(new, v, lab[u])
        new = np.minimum(new, new[order[np.searchsorted(srt, new)]])
        if np.array_equal(new, lab):
            return lab
        lab = new


def tile_contracted_components(nodes: DataFrame, edges: DataFrame, tile: int = 64) -> DataFrame:
    """Components of a spatial graph, contracted tile by tile first.

    ``nodes(node, _gx, _gy)`` carry grid cells; ``edges(src, dst)``. Inside
    each super-tile of ``tile x tile`` cells (a bounded group) components are
    found with NumPy; only edges that cross super-tiles, between the local
    roots, go to the distributed rounds. Same labels as ``connected_components``.
    """
    nt = nodes.select("node", F.floor(F.col("_gx") / tile).alias("_sx"), F.floor(F.col("_gy") / tile).alias("_sy"))
    e = (edges.join(nt.select(F.col("node").alias("src"), F.col("_sx").alias("_ax"), F.col("_sy").alias("_ay")), "src")
              .join(nt.select(F.col("node").alias("dst"), F.col("_sx").alias("_bx"), F.col("_sy").alias("_by")), "dst"))
    inner = e.filter((F.col("_ax") == F.col("_bx")) & (F.col("_ay") == F.col("_by"))).select(
        F.col("_ax").alias("_sx"), F.col("_ay").alias("_sy"), "src", "dst")

    def local(npdf: pd.DataFrame, epdf: pd.DataFrame) -> pd.DataFrame:
        if npdf.empty:
            return pd.DataFrame({"node": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
        ns = npdf["node"].to_numpy(dtype=np.int64)
        roots = _local_min_labels(ns, epdf["src"].to_numpy(dtype=np.int64), epdf["dst"].to_numpy(dtype=np.int64))
        return pd.DataFrame({"node": ns, "root": roots})

    root_of = materialize(nt.groupBy("_sx", "_sy").cogroup(inner.groupBy("_sx", "_sy"))
                            .applyInPandas(local, "node long, root long"), "cc-local-roots")
    cross = (e.filter((F.col("_ax") != F.col("_bx")) | (F.col("_ay") != F.col("_by"))).select("src", "dst")
              .join(root_of.select(F.col("node").alias("src"), F.col("root").alias("_ra")), "src")
              .join(root_of.select(F.col("node").alias("dst"), F.col("root").alias("_rb")), "dst")
              .select(F.col("_ra").alias("src"), F.col("_rb").alias("dst")))
    roots = root_of.select(F.col("root").alias("node")).distinct()
    glob = connected_components(roots, cross)
    return (root_of.join(glob.select(F.col("node").alias("root"), "label"), "root")
                   .select("node", "label"))


def _offsets(lo: int, hi: int):
    """Cell offsets (dx, dy) with Chebyshev distance in [lo, hi]."""
    return F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                     for dx in range(-hi, hi + 1) for dy in range(-hi, hi + 1)
                     if lo <= max(abs(dx), abs(dy)) <= hi])


def _shift(df: DataFrame, lo: int, hi: int, gx: str = "_gx", gy: str = "_gy",
           ngx: str = "_ngx", ngy: str = "_ngy") -> DataFrame:
    """Replicate rows to the cells at Chebyshev distance lo..hi of their cell."""
    return (df.withColumn("_o", F.explode(_offsets(lo, hi)))
              .withColumn(ngx, F.col(gx) + F.col("_o.dx")).withColumn(ngy, F.col(gy) + F.col("_o.dy"))
              .drop("_o"))


def dbscan(points: DataFrame, eps_km: float = 10.0, min_samples: int = 5, id_col: str = "id",
           lon: str = "lon", lat: str = "lat", out: str = "cluster") -> DataFrame:
    """DBSCAN labels for every point with coordinates: ``(id, cluster)``.

    Core points: on cells of side eps/sqrt(2) (one cell is within eps), a
    cell holding >= min_samples points is core with no pair test; only
    locations in sparse cells test their 5x5 neighbourhood. Links: on cells
    of side eps/(2 sqrt 2), any two points in the same or touching cells are
    within eps, so touching core cells are linked without point tests; core
    cells two or three cells apart are tested only when no core cell touches
    both. Such a pair is decided by the tight boxes of its two cells or, level
    by level, of their quarters (``spatial.square_pairs``); points of small
    squares alone are compared, so two dense clumps about eps apart cost their
    facing edges, not all their pairs. Ids may be of any sortable type;
    their order numbers the clusters.
    """
    eps = tf.km_to_deg(eps_km)
    e2 = F.lit(eps * eps)
    g0 = eps / (2 ** 0.5) * (1 - 1e-9)
    g = g0 / 2.0
    m = int(min_samples)
    pts = (points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
                 .select(F.col(id_col).alias("_id"), F.col(lon).alias("_px"), F.col(lat).alias("_py")))
    numbers = pts.withColumn("_no", F.col("_id"))
    if dict(pts.dtypes)["_id"] not in ("tinyint", "smallint", "int", "bigint"):
        numbers = pts.join(range_rank(pts, "_id", "_no"), "_id", "left")  # any other id by its place in order
    loc = numbers.groupBy("_px", "_py").agg(F.count(F.lit(1)).alias("_w"),
                                            F.min(F.col("_no").cast("bigint")).alias("_min_id"))
    # core flags on cells of side eps/sqrt(2) (same cell -> within eps): a cell
    # with >= min_samples points is core outright; only locations in sparse
    # cells test the 5x5 neighbourhood
    loc = with_tiles(loc, g0, "_px", "_py", "_hx", "_hy")
    cell_n = loc.groupBy("_hx", "_hy").agg(F.sum("_w").alias("_cn"))
    loc = loc.join(cell_n, ["_hx", "_hy"])
    sparse = _shift(loc.filter(F.col("_cn") < m).select("_px", "_py", "_hx", "_hy"), 1, 2, "_hx", "_hy")
    other = loc.select(F.col("_hx").alias("_ngx"), F.col("_hy").alias("_ngy"), F.col("_px").alias("_qx"),
                       F.col("_py").alias("_qy"), F.col("_w").alias("_qw"))
    cross = (sparse.join(other, ["_ngx", "_ngy"]).filter(_d2("_px", "_py", "_qx", "_qy") <= e2)
                   .groupBy("_px", "_py").agg(F.sum("_qw").alias("_cross")))
    loc = (loc.join(cross, ["_px", "_py"], "left")
              .withColumn("_core", (F.col("_cn") + F.coalesce(F.col("_cross"), F.lit(0))) >= m)
              .drop("_cross", "_cn", "_hx", "_hy"))
    loc = with_tiles(loc, g, "_px", "_py", "_gx", "_gy")
    loc = materialize(loc, "dbscan-locations")
    core = loc.filter("_core")
    # graph nodes = core cells, named by their smallest core row id
    node_of = materialize(core.groupBy("_gx", "_gy").agg(F.min("_min_id").alias("_node")), "dbscan-nodes")
    other_nodes = node_of.select(F.col("_gx").alias("_ngx"), F.col("_gy").alias("_ngy"),
                                 F.col("_node").alias("_qnode"))
    touching = (_shift(node_of, 1, 1).join(other_nodes, ["_ngx", "_ngy"])
                .filter(F.col("_node") < F.col("_qnode"))
                .select(F.col("_node").alias("src"), F.col("_qnode").alias("dst")))
    # cell pairs 2..3 apart that share no touching core cell need a point test
    both = touching.unionByName(touching.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    via = (both.alias("a").join(both.alias("b"), F.col("a.dst") == F.col("b.src"))
               .filter(F.col("a.src") < F.col("b.dst"))
               .select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst")).distinct())
    far = (_shift(node_of, 2, 3).join(other_nodes, ["_ngx", "_ngy"]).filter(F.col("_node") < F.col("_qnode"))
           .select(F.col("_node").alias("src"), F.col("_qnode").alias("dst"), "_ngx", "_ngy"))
    far = far.join(via, ["src", "dst"], "left_anti")
    # each such pair is two squares: one look at their tight boxes often decides, else their nearest quarters do
    cells = materialize(SP.squares(core, g), "dbscan-squares")
    ends = far.join(node_of.select(F.col("_node").alias("src"), F.col("_gx").alias("a_x"), F.col("_gy").alias("a_y")), "src")
    ends = ends.withColumnsRenamed({"_ngx": "b_x", "_ngy": "b_y"})
    for p in ("a_", "b_"):
        ends = ends.join(cells.toDF(*[p + c for c in cells.columns]), [p + "x", p + "y"])
    inside, cut, levels = SP.square_pairs(core, ends, g, eps * eps, ["src", "dst"], once=True)
    near = SP.close_points(cut, SP.by_level(core.select("_px", "_py", "_w"), g, levels), eps * eps)
    tested = inside.select("src", "dst").unionByName(near.select("src", "dst")).distinct()
    edges = touching.unionByName(tested)
    comps = tile_contracted_components(node_of.select(F.col("_node").alias("node"), "_gx", "_gy"), edges)
    numbered = range_rank(comps, "label", out="_rank")
    cluster_of = (comps.join(numbered, "label")
                       .select(F.col("node").alias("_node"), F.col("_rank").alias("_cluster")))
    cell_cluster = materialize(node_of.join(cluster_of, "_node").select("_gx", "_gy", "_cluster"),
                               "dbscan-cell-clusters")
    core_lab = core.join(cell_cluster, ["_gx", "_gy"]).select("_px", "_py", "_cluster")
    # border points: smallest cluster among core cells of the block (all within
    # eps) and among core points 2..3 cells away that are within eps
    noncore = loc.filter(~F.col("_core")).select("_px", "_py", "_gx", "_gy")
    in_block = (_shift(noncore, 0, 1).join(cell_cluster.select(F.col("_gx").alias("_ngx"), F.col("_gy").alias("_ngy"),
                                                               "_cluster"), ["_ngx", "_ngy"])
                .select("_px", "_py", "_cluster"))
    ring_core = (core.join(cell_cluster, ["_gx", "_gy"])
                     .select(F.col("_gx").alias("_ngx"), F.col("_gy").alias("_ngy"), F.col("_px").alias("_qx"),
                             F.col("_py").alias("_qy"), "_cluster"))
    in_ring = (_shift(noncore, 2, 3).join(ring_core, ["_ngx", "_ngy"])
               .filter(_d2("_px", "_py", "_qx", "_qy") <= e2).select("_px", "_py", "_cluster"))
    border = in_block.unionByName(in_ring).groupBy("_px", "_py").agg(F.min("_cluster").alias("_cluster"))
    labelled = core_lab.unionByName(border)
    return (pts.join(labelled, ["_px", "_py"], "left")
               .select(F.col("_id").alias(id_col), F.coalesce("_cluster", F.lit(-1)).cast("bigint").alias(out)))


def cluster_centroids(labelled: DataFrame, cluster: str = "cluster", lon: str = "lon",
                      lat: str = "lat") -> DataFrame:
    """Mean lon/lat and Observation_Count per cluster, in one aggregate."""
    return labelled.groupBy(cluster).agg(F.avg(lon).alias("lon"), F.avg(lat).alias("lat"),
                                         F.count(F.lit(1)).alias("Observation_Count"))


def filter_rookeries(points: DataFrame, min_observations: int = 5, cluster_distance_km: float = 10.0,
                     id_col: str = "id") -> DataFrame:
    """DBSCAN -> drop noise -> cluster centroids with counts."""
    labels = dbscan(points, cluster_distance_km, min_observations, id_col)
    pts = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(id_col, "lon", "lat")
    joined = pts.join(labels.filter(F.col("cluster") != -1), id_col)
    return cluster_centroids(joined)
