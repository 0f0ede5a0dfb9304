"""Spatial range joins on a tile grid.

Every "within r" question becomes an equi-join on tile keys: both sides get
``tile = floor(coord / size)``; one side is replicated to its 3x3 neighbour
tiles; the exact ``d^2 <= r^2`` test runs after the equi-join. So Spark plans
a hash/sort-merge join on tile keys (AQE splits hot tiles), never a nested
loop or Cartesian product. Point sets are reduced to distinct locations
first, so piles of identical coordinates cost one row.

Distances are Euclidean in degrees x 111 km (flat), as in the reference.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as tf
from .lineage import materialize

# A tile is a hair wider than the radius, so float noise in x / size can never
# put two points within r more than one tile apart.
_TILE_SLACK = 1.0 + 1e-9


def _tile(c, size: float):
    return F.floor(F.col(c) / F.lit(size)).cast("bigint")


def with_tiles(df: DataFrame, size: float, lon: str = "lon", lat: str = "lat",
               tx: str = "_tx", ty: str = "_ty") -> DataFrame:
    return df.withColumn(tx, _tile(lon, size)).withColumn(ty, _tile(lat, size))


def explode_neighbours(df: DataFrame, size: float, reach: int = 1, lon: str = "lon", lat: str = "lat",
                       tx: str = "_tx", ty: str = "_ty") -> DataFrame:
    """Replicate each row to the (2*reach+1)^2 tiles around its own tile."""
    offs = F.array(*[F.lit(o) for o in range(-reach, reach + 1)])
    return (df.withColumn("_dx", F.explode(offs)).withColumn("_dy", F.explode(offs))
              .withColumn(tx, _tile(lon, size) + F.col("_dx"))
              .withColumn(ty, _tile(lat, size) + F.col("_dy"))
              .drop("_dx", "_dy"))


def distinct_points(points: DataFrame, lon: str = "lon", lat: str = "lat",
                    keys: Sequence[str] = ()) -> DataFrame:
    """Distinct non-missing locations (per key) with their multiplicity ``w``."""
    keys = list(keys)
    return (points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
                  .groupBy(*keys, F.col(lon).alias("_px"), F.col(lat).alias("_py"))
                  .agg(F.count(F.lit(1)).alias("_w")))


def _d2(ax, ay, bx, by):
    return (F.col(ax) - F.col(bx)) * (F.col(ax) - F.col(bx)) + (F.col(ay) - F.col(by)) * (F.col(ay) - F.col(by))


SPLIT = 4  # a tile is cut into SPLIT x SPLIT; a power of two, so that tiles nest exactly
LEAF_POINTS = 32
TILE_POINTS = 4096  # points of a tile that are compared with the cells around it as they are


def nearest_tiles(pairs: DataFrame, pts: DataFrame, x0: float, y0: float, size: float, cell_keys: Sequence[str],
                  leaf: int = LEAF_POINTS) -> list[tuple[DataFrame, float]]:
    """The pairs (cell, tile) that can hold the cell's nearest point, tiles of at most ``leaf`` points, by tile size.

    ``pairs`` has the cells with tiles (``_tx``, ``_ty``) of the first size to look at, and an upper bound ``_ub``. Tiles
    nest: each round cuts those that still hold more points. A tile is known by its tight box: no point of it is nearer
    than the box, and one at least is as near as the farther end of the box's nearer sides. A cell's upper bound is the
    least of these; tiles whose lower bound is above it are dropped. Only the points of tiles that are still cut are
    read again.
    """
    cell_keys = list(cell_keys)
    found = []
    while True:
        at = [F.floor((F.col(c) - F.lit(o)) / F.lit(size)).alias(t) for c, o, t in (("_px", x0, "_tx"), ("_py", y0, "_ty"))]
        tiled = pts.select("_px", "_py", *at)
        tiles = tiled.groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("_n"), F.min("_px").alias("_l"), F.max("_px").alias("_r"),
                                                F.min("_py").alias("_b"), F.max("_py").alias("_t"))
        both = pairs.join(tiles, ["_tx", "_ty"])
        square = lambda c: c * c
        gap = [square(F.greatest(F.col(lo) - F.col(c), F.col(c) - F.col(hi), F.lit(0.0)))
               for c, lo, hi in (("_cx", "_l", "_r"), ("_cy", "_b", "_t"))]
        near, far = ([f(square(F.col(c) - F.col(lo)), square(F.col(c) - F.col(hi))) for c, lo, hi in (("_cx", "_l", "_r"), ("_cy", "_b", "_t"))]
                     for f in (F.least, F.greatest))
        both = both.withColumn("_lb", gap[0] + gap[1]).withColumn("_own", F.least(near[0] + far[1], far[0] + near[1]))
        bound = F.least("_ub", F.min("_own").over(Window.partitionBy(*cell_keys)))
        kept = both.withColumn("_ub", bound).filter(F.col("_lb") <= F.col("_ub") * (1 + 1e-12))
        kept = materialize(kept.select(*cell_keys, "_cx", "_cy", "_ub", "_tx", "_ty", "_n"), "nearest-tiles")
        found.append((kept.filter(F.col("_n") <= leaf), size))
        dense = kept.filter(F.col("_n") > leaf)
        if dense.isEmpty():
            return found
        pts = materialize(tiled.join(dense.select("_tx", "_ty").distinct(), ["_tx", "_ty"], "left_semi").select("_px", "_py"), "nearest-points")
        parts = F.array(*[F.lit(i).cast("long") for i in range(SPLIT)])
        pairs = (dense.drop("_n").withColumn("_i", F.explode(parts)).withColumn("_j", F.explode(parts))
                      .withColumn("_tx", F.col("_tx") * SPLIT + F.col("_i")).withColumn("_ty", F.col("_ty") * SPLIT + F.col("_j")).drop("_i", "_j"))
        size /= SPLIT


def nearest_distance(cells: DataFrame, points: DataFrame, max_distance_km: float | None = None,
                     cell_keys: Sequence[str] = ("lat_idx", "lon_idx"), lon: str = "lon", lat: str = "lat",
                     out: str = "distance_km", point_lon: str = "lon", point_lat: str = "lat") -> DataFrame:
    """Distance (km) from every cell centre to the nearest point, capped.

    Branch and bound on nested tiles (``nearest_tiles``), first around each
    cell, then for cells without a point there from the whole extent down; the
    points of the few tiles that are left for a cell are compared exactly. Work
    follows the cells and the tiles, not cells times the points of a dense
    place, near or far. Cells without a point within the cap get the cap.
    """
    cell_keys = list(cell_keys)
    pts = materialize(distinct_points(points, point_lon, point_lat).select("_px", "_py"), "nearest-all")
    # one aggregate row: how many distinct points and over what extent
    st = pts.agg(F.count(F.lit(1)).alias("n"), F.min("_px").alias("x0"), F.max("_px").alias("x1"),
                 F.min("_py").alias("y0"), F.max("_py").alias("y1")).first()
    if not st["n"]:
        return cells.withColumn(out, F.lit(None).cast("double") if max_distance_km is None
                                else F.lit(float(max_distance_km)))
    placed = F.col(lon).isNotNull() & F.col(lat).isNotNull()  # other cells have no distance
    open_cells = cells.filter(placed).select(*cell_keys, F.col(lon).alias("_cx"), F.col(lat).alias("_cy"))
    x0, y0 = st["x0"], st["y0"]
    extent = max(st["x1"] - x0, st["y1"] - y0, 1e-9)

    def nested(width: float) -> float:
        return 2.0 ** math.ceil(math.log2(width))

    def tiled(width: float) -> DataFrame:
        return pts.select("_px", "_py", *[F.floor((F.col(c) - F.lit(o)) / F.lit(width)).alias(t)
                                          for c, o, t in (("_px", x0, "_tx"), ("_py", y0, "_ty"))])

    def nearest(pairs: DataFrame, width: float) -> DataFrame:
        return pairs.join(tiled(width), ["_tx", "_ty"]).select(*cell_keys, _d2("_cx", "_cy", "_px", "_py").alias("_d2"))

    def searched(pairs: DataFrame, size: float) -> DataFrame:
        return reduce(DataFrame.unionByName, [nearest(*leaves) for leaves in nearest_tiles(pairs, pts, x0, y0, size, cell_keys)])

    # most cells have a point nearby: the tiles around them, at first as wide as points usually lie apart
    cap2 = float("inf") if max_distance_km is None else tf.km_to_deg(max_distance_km) ** 2 * (1 + 1e-9)
    width = nested(max(2 * tf.DEFAULT_RESOLUTION, ((st["x1"] - x0) * (st["y1"] - y0) / st["n"]) ** 0.5))
    sparse = (tiled(4 * width).groupBy("_tx", "_ty").count().agg(F.max("count")).first()[0]) <= TILE_POINTS
    resolved, rest = [], open_cells
    for width in (width, 2 * width, 4 * width) if sparse else (width,):
        around = explode_neighbours(rest.withColumn("_ox", F.col("_cx") - F.lit(x0)).withColumn("_oy", F.col("_cy") - F.lit(y0)),
                                    width, 1, "_ox", "_oy").drop("_ox", "_oy")
        reach2 = width * width * (1 - 1e-9)
        found = nearest(around, width) if sparse else searched(around.withColumn("_ub", F.lit(min(reach2, cap2))), width)
        found = found.filter(F.col("_d2") <= reach2).groupBy(*cell_keys).agg(F.min("_d2").alias("_d2"))
        resolved.append(materialize(found, "nearest-local"))
        rest = materialize(rest.join(resolved[-1], cell_keys, "left_anti"), "nearest-open")
        if reach2 >= cap2 or rest.isEmpty():
            break
    else:  # the others begin with the tiles of the whole extent
        steps = F.array(*[F.lit(i).cast("long") for i in range(SPLIT + 1)])
        pairs = rest.withColumn("_ub", F.lit(cap2)).withColumn("_tx", F.explode(steps)).withColumn("_ty", F.explode(steps))
        resolved.append(searched(pairs, nested(extent / SPLIT)))
    near = reduce(DataFrame.unionByName, resolved)
    dist = near.groupBy(*cell_keys).agg(F.min("_d2").alias("_d2"))
    d_km = tf.deg_to_km(F.sqrt(F.col("_d2")))
    if max_distance_km is not None:
        d_km = F.when(placed, F.coalesce(tf.cap(d_km, max_distance_km), F.lit(float(max_distance_km))))
    return cells.join(dist, cell_keys, "left").withColumn(out, d_km).drop("_d2")


def exclude_buffer(candidates: DataFrame, points: DataFrame, radius_km: float,
                   keys: Sequence[str] = (), lon: str = "lon", lat: str = "lat",
                   point_lon: str = "lon", point_lat: str = "lat") -> DataFrame:
    """Keep candidates farther than ``radius_km`` from every point (same keys).

    Left-anti join on (keys, tile) with the exact ``d^2 <= r^2`` condition;
    the point side (distinct locations) is the one replicated to 3x3 tiles,
    so each candidate is tested once.
    """
    keys = list(keys)
    rd = tf.km_to_deg(radius_km)
    size = rd * _TILE_SLACK
    pts = explode_neighbours(distinct_points(points, point_lon, point_lat, keys).drop("_w"),
                             size, 1, "_px", "_py")
    for k in keys:
        pts = pts.withColumnRenamed(k, f"_k_{k}")
    cand = with_tiles(candidates, size, lon, lat)
    cond = [cand["_tx"] == pts["_tx"], cand["_ty"] == pts["_ty"]]
    cond += [cand[k] == pts[f"_k_{k}"] for k in keys]
    d2 = ((cand[lon] - pts["_px"]) * (cand[lon] - pts["_px"])
          + (cand[lat] - pts["_py"]) * (cand[lat] - pts["_py"]))
    cond.append(d2 <= F.lit(rd * rd))
    return cand.join(pts, cond, "left_anti").drop("_tx", "_ty")


def exclusion_mask(cells: DataFrame, points: DataFrame, radius_km: float,
                   cell_keys: Sequence[str] = ("lat_idx", "lon_idx"), lon: str = "lon", lat: str = "lat",
                   out: str = "excluded") -> DataFrame:
    """Every cell flagged when its centre lies within r of any point."""
    cell_keys = list(cell_keys)
    rd = tf.km_to_deg(radius_km)
    size = rd * _TILE_SLACK
    pts = with_tiles(distinct_points(points).drop("_w"), size, "_px", "_py").alias("p")
    c = explode_neighbours(cells.select(*cell_keys, F.col(lon).alias("_cx"), F.col(lat).alias("_cy")),
                           size, 1, "_cx", "_cy").alias("c")
    # a semi join stops at a cell's first point on a tile
    near = ((F.col("c._tx") == F.col("p._tx")) & (F.col("c._ty") == F.col("p._ty"))
            & (_d2("_cx", "_cy", "_px", "_py") <= F.lit(rd * rd)))
    hit = c.join(pts, near, "left_semi").select(*cell_keys).distinct().withColumn(out, F.lit(True))
    return cells.join(hit, cell_keys, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


# two squares with at most this many pairs of locations are compared point by point
SMALL_PAIR = 256


def squares(loc: DataFrame, side: float, level: int = 0) -> DataFrame:
    """Occupied squares of side ``side / 2^level``: locations ``n``, points ``w`` and the tight box.

    Halving is exact in binary, so each square's parent is at half its indices.
    """
    return (with_tiles(loc, side / 2 ** level, "_px", "_py", "x", "y").groupBy("x", "y")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w"), F.min("_px").alias("x0"), F.max("_px").alias("x1"),
                 F.min("_py").alias("y0"), F.max("_py").alias("y1")))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def _bounds():
    """Least and greatest squared distance of points in the tight boxes ``a`` and ``b``.

    Rounding is monotone, so these bound the computed distance of each pair of points too.
    """
    def near(k):
        return F.greatest(F.lit(0.0), F.col(f"a_{k}0") - F.col(f"b_{k}1"), F.col(f"b_{k}0") - F.col(f"a_{k}1"))

    def far(k):
        return F.greatest(F.col(f"a_{k}1") - F.col(f"b_{k}0"), F.col(f"b_{k}1") - F.col(f"a_{k}0"))

    return near("x") * near("x") + near("y") * near("y"), far("x") * far("x") + far("y") * far("y")


def square_pairs(loc: DataFrame, pairs: DataFrame, side: float, r2: float, keep: Sequence[str] = (), once: bool = False):
    """``(inside, cut, levels)`` for pairs of squares ``a`` and ``b`` of level 0.

    ``inside`` holds pairs of squares all of whose points are within ``r2`` of each other, ``cut`` pairs of at most
    ``SMALL_PAIR`` location pairs that the radius runs through. Larger ones are split into the pairs of their quarters,
    level by level, until none is left; pairs out of reach are dropped. Both carry ``level`` and the columns ``keep``.
    With ``once``, a pair inside settles all others of the same ``keep``.
    """
    inside, cut, level = [], [], 0
    sides = ["level", *keep, "a_x", "a_y", "b_x", "b_y"]
    while True:
        least, most = _bounds()
        seen = materialize(pairs.withColumn("level", F.lit(level)).filter(least <= F.lit(r2))
                                .withColumn("all", most <= F.lit(r2)), "square-pairs")
        small = F.col("a_n") * F.col("b_n") <= SMALL_PAIR
        inside.append(seen.filter("all").select(*sides, "b_w"))
        split = seen.filter(~F.col("all"))
        if once:
            split = split.join(seen.filter("all").select(*keep).distinct(), list(keep), "left_anti")
        cut.append(split.filter(small).select(*sides))
        large = split.filter(~small).select(*sides).drop("level")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, inside), reduce(DataFrame.unionByName, cut), level + 1
        level += 1
        quarters = materialize(squares(loc, side, level), "squares")
        pairs = large
        for p in ("a_", "b_"):
            inner = _prefixed(quarters, p).withColumn("_ux", F.shiftright(p + "x", 1)).withColumn("_uy", F.shiftright(p + "y", 1))
            outer = pairs.withColumnRenamed(p + "x", "_ux").withColumnRenamed(p + "y", "_uy")
            pairs = outer.join(inner, ["_ux", "_uy"]).drop("_ux", "_uy")


def by_level(loc: DataFrame, side: float, levels: int) -> DataFrame:
    """Each location with its square at every level."""
    places = [F.struct(F.lit(k).alias("level"), _tile("_px", side / 2 ** k).alias("x"), _tile("_py", side / 2 ** k).alias("y"))
              for k in range(levels)]
    return loc.withColumn("_s", F.explode(F.array(*places))).select("_s.*", "_px", "_py", "_w")


def close_points(cut: DataFrame, placed: DataFrame, r2: float) -> DataFrame:
    """The pairs of locations within ``r2`` of the pairs of squares ``cut``; ``placed`` is ``by_level``'s."""
    mine = placed.toDF("level", "a_x", "a_y", "_px", "_py", "_w").drop("_w")
    other = placed.toDF("level", "b_x", "b_y", "_qx", "_qy", "_qw")
    return (cut.join(mine, ["level", "a_x", "a_y"]).join(other, ["level", "b_x", "b_y"])
               .filter(_d2("_px", "_py", "_qx", "_qy") <= F.lit(r2)))


def neighbour_counts(points: DataFrame, eps_km: float, id_col: str = "id", lon: str = "lon",
                     lat: str = "lat", out: str = "n_neighbours") -> DataFrame:
    """Number of points within eps of each point (itself included).

    Counting runs on distinct locations with multiplicities, on cells of side
    eps/(2 sqrt 2): any two points in the same or touching cells are within
    eps, so the 3x3 block around a point is counted by aggregation. Cells two
    or three cells away are taken as pairs of squares: one that lies wholly
    within eps of another adds its count at once, one that the circle cuts is
    split into quarters, and only points of small cut squares are compared.
    """
    eps = tf.km_to_deg(eps_km)
    g = eps / (2.0 * 2 ** 0.5) * (1 - 1e-9)
    r2 = eps * eps
    loc = materialize(distinct_points(points, lon, lat), "locations")
    cells = materialize(squares(loc, g), "squares")
    near = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-3, 4) for dy in range(-3, 4)])
    around = (_prefixed(cells, "a_").withColumn("_o", F.explode(near))
              .withColumns({"b_x": F.col("a_x") + F.col("_o.dx"), "b_y": F.col("a_y") + F.col("_o.dy")}))
    touching = F.greatest(F.abs("_o.dx"), F.abs("_o.dy")) < 2
    block = (around.filter(touching).join(_prefixed(cells, "b_"), ["b_x", "b_y"])
                   .groupBy("a_x", "a_y").agg(F.sum("b_w").alias("_add")))
    ring = around.filter(~touching).drop("_o").join(_prefixed(cells, "b_"), ["b_x", "b_y"])
    inside, cut, levels = square_pairs(loc, ring, g, r2)
    placed = by_level(loc, g, levels)
    whole = (inside.groupBy("level", "a_x", "a_y").agg(F.sum("b_w").alias("_add"))
                   .unionByName(block.withColumn("level", F.lit(0)))
                   .groupBy("level", F.col("a_x").alias("x"), F.col("a_y").alias("y")).agg(F.sum("_add").alias("_add")))
    tested = close_points(cut, placed, r2).select("_px", "_py", F.col("_qw").alias("_add"))
    counts = (placed.join(whole, ["level", "x", "y"]).select("_px", "_py", "_add").unionByName(tested)
                    .groupBy("_px", "_py").agg(F.sum("_add").alias(out)))
    return (points.join(counts, (points[lon] == counts["_px"]) & (points[lat] == counts["_py"]), "inner")
                  .drop("_px", "_py"))
