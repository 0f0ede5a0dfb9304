"""Resampling onto the target grid (J8 nearest, J9 bilinear, W5 cubic).

Interpolation is separable, so each axis gets a small *axis map*: one row
per (target index, source coordinate, weight). Axis maps are built from the
distinct coordinates of one axis that are next to a target (bounded by the
target grid's lines, however long the source's axis), so a sorted window over
them is cheap, and they are small enough to broadcast. The data side is never densified first: every source
row is joined to the (at most two per axis) target cells it feeds, and a
``groupBy`` sums the weighted corners. A target cell is missing when any
of its corners is absent or missing (``count = corners`` guard), outside
the source extent, or, for nearest, when the nearest source value is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as tf
from .lineage import materialize


def _up_to(last: int, *order):
    """The rows so far in this order. Such a frame is carried on; one that begins at the current row is read anew for each row."""
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, last)


def _axis_union(source_axis: DataFrame, target_axis: DataFrame) -> DataFrame:
    """Sorted union of source coordinates ``s`` and target rows ``(idx, t)``.

    Target rows sort before source rows at an equal coordinate, so "previous
    source" means strictly below and "next source" means at or above.
    """
    src = source_axis.select(F.col("s").alias("_c"), F.lit(1).alias("_src"), F.lit(None).cast("int").alias("idx"))
    tgt = target_axis.select(F.col("t").alias("_c"), F.lit(0).alias("_src"), F.col("idx").cast("int"))
    return src.unionByName(tgt)


def near_targets(source_axis: DataFrame, target_axis: DataFrame) -> DataFrame:
    """The distinct source coordinates ``s`` that are next to a target: at most four for each target and two more.

    Targets cut the axis into open intervals and the targets themselves; of each such part only the lowest and the highest
    source coordinate can bound a target's bracket. The targets (one per grid line) are shipped with the function.
    """
    cuts = np.array(sorted(r["t"] for r in target_axis.select("t").distinct().collect()), dtype=float)

    @F.pandas_udf("long")
    def part(s: pd.Series) -> pd.Series:
        x = s.to_numpy(dtype=float)
        return pd.Series(np.searchsorted(cuts, x, "left") + np.searchsorted(cuts, x, "right"))

    parts = (source_axis.select("s").filter(F.col("s").isNotNull()).distinct()
                        .groupBy(part("s").alias("_part")).agg(F.min("s").alias("_lo"), F.max("s").alias("_hi")))
    return parts.select(F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("s"))


def nearest_axis_map(source_axis: DataFrame, target_axis: DataFrame) -> DataFrame:
    """(idx, s): nearest source coordinate per target; ties to the lower one.

    Targets outside [min source, max source] get no row (missing).
    """
    u = _axis_union(near_targets(source_axis, target_axis), target_axis)
    s_val = F.when(F.col("_src") == 1, F.col("_c"))
    u = (u.withColumn("_prev", F.last(s_val, ignorenulls=True).over(_up_to(0, "_c", "_src")))
          .withColumn("_next", F.last(s_val, ignorenulls=True).over(_up_to(0, F.desc("_c"), F.desc("_src")))))
    t = u.filter(F.col("_src") == 0)
    pick = (F.when(F.col("_prev").isNull(), F.when(F.col("_next") == F.col("_c"), F.col("_next")))
             .when(F.col("_next").isNull(), F.lit(None))
             .when(F.col("_c") - F.col("_prev") <= F.col("_next") - F.col("_c"), F.col("_prev"))
             .otherwise(F.col("_next")))
    return t.select("idx", pick.alias("s")).filter(F.col("s").isNotNull())


def linear_brackets(source_axis: DataFrame, target_axis: DataFrame) -> DataFrame:
    """(idx, lo, hi, w): bracketing source coordinates of each target and the
    weight of ``hi``.

    Bracket is ``(s_lo, s_hi]``; a target equal to the first source uses the
    first bracket. Targets outside the source extent get no row.
    """
    sa = near_targets(source_axis, target_axis)
    sa = sa.withColumn("s_next", F.lead("s").over(Window.orderBy("s")))
    u = _axis_union(sa, target_axis).join(
        sa.select(F.col("s").alias("_c"), F.col("s_next").alias("_cn")), "_c", "left")
    s_val = F.when(F.col("_src") == 1, F.col("_c"))
    n_val = F.when(F.col("_src") == 1, F.col("_cn"))
    down = _up_to(0, F.desc("_c"), F.desc("_src"))
    u = (u.withColumn("_prev", F.last(s_val, ignorenulls=True).over(_up_to(-1, "_c", "_src")))
          .withColumn("_next", F.last(s_val, ignorenulls=True).over(down))
          .withColumn("_next2", F.last(n_val, ignorenulls=True).over(down)))
    t = u.filter(F.col("_src") == 0)
    first = F.col("_prev").isNull() & (F.col("_next") == F.col("_c"))
    lo = F.when(first, F.col("_next")).otherwise(F.col("_prev"))
    hi = F.when(first, F.col("_next2")).otherwise(F.col("_next"))
    b = t.select("idx", "_c", lo.alias("lo"), hi.alias("hi")).filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    return b.select("idx", "lo", "hi", ((F.col("_c") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("w"))


def _axes(grid: DataFrame):
    lat_t = grid.select(F.col("lat_idx").alias("idx"), F.col("lat").alias("t")).distinct()
    lon_t = grid.select(F.col("lon_idx").alias("idx"), F.col("lon").alias("t")).distinct()
    return lat_t, lon_t


def resample(source: DataFrame, grid: DataFrame, values: Sequence[str], method: str = "bilinear",
             keys: Sequence[str] = (), lat: str = "lat", lon: str = "lon", complete_only: bool = False) -> DataFrame:
    """Resample source rows onto ``grid`` (lat_idx, lon_idx, lat, lon).

    Without ``keys`` the result has every cell of the grid, NULL outside the
    source extent and where a corner is absent or missing. ``keys`` (e.g.
    ``time``) are carried through: then it has a row per (keys, target cell)
    that received any source corner, and the caller lays those onto its own
    spine of times (``densify_weeks``). ``complete_only`` keeps only the cells
    with a value.
    """
    keys, values = list(keys), list(values)
    src = source.select(*keys, F.col(lat).alias("_slat"), F.col(lon).alias("_slon"),
                        *[tf.nan_to_null(v).alias(v) for v in values])
    lat_t, lon_t = _axes(grid)
    s_lat = src.select(F.col("_slat").alias("s")).distinct()
    s_lon = src.select(F.col("_slon").alias("s")).distinct()
    if method in ("nearest",):
        mlat = nearest_axis_map(s_lat, lat_t).select(F.col("idx").alias("lat_idx"), F.col("s").alias("_slat"))
        mlon = nearest_axis_map(s_lon, lon_t).select(F.col("idx").alias("lon_idx"), F.col("s").alias("_slon"))
        out = src.join(F.broadcast(mlat), "_slat").join(F.broadcast(mlon), "_slon").select(*keys, "lat_idx", "lon_idx", *values)
        return out if keys else _whole_grid(out, grid)
    if method not in ("bilinear", "linear"):
        raise ValueError(f"unknown resampling method {method}")
    quads = bilinear_quads(src, lat_t, lon_t, s_lat, s_lon, values, keys)
    cells = quads_to_cells(quads, values, keys, complete_only)
    return cells if keys or complete_only else _whole_grid(cells, grid)


def _whole_grid(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """Every cell of the grid, NULL where nothing reaches it."""
    return grid.select("lat_idx", "lon_idx").join(cells, ["lat_idx", "lon_idx"], "left")


def _corner_table(brackets: DataFrame, name: str) -> DataFrame:
    """Source coordinate -> (bracket, role): role 0 = lo corner, 1 = hi corner."""
    br = brackets.select("lo", "hi").distinct()
    return (br.select(F.col("lo").alias(f"_s{name}"), "lo", "hi", F.lit(0).alias(f"_r{name}"))
              .unionByName(br.select(F.col("hi").alias(f"_s{name}"), "lo", "hi", F.lit(1).alias(f"_r{name}")))
              .withColumnRenamed("lo", f"_{name}lo").withColumnRenamed("hi", f"_{name}hi"))


def bilinear_quads(src: DataFrame, lat_t: DataFrame, lon_t: DataFrame, s_lat: DataFrame, s_lon: DataFrame,
                   values, keys) -> DataFrame:
    """One row per (keys, lat bracket, lon bracket) with its four corner values.

    Every target cell inside the same source square shares the same four
    corners, so corners are gathered once per square (each source row feeds
    at most four squares) and cells are produced afterwards.
    """
    lat_b = linear_brackets(s_lat, lat_t)
    lon_b = linear_brackets(s_lon, lon_t)
    contrib = (src.join(F.broadcast(_corner_table(lat_b, "y")), F.col("_slat") == F.col("_sy"))
                  .join(F.broadcast(_corner_table(lon_b, "x")), F.col("_slon") == F.col("_sx")))
    aggs = []
    for v in values:
        for ry in (0, 1):
            for rx in (0, 1):
                aggs.append(F.max(F.when((F.col("_ry") == ry) & (F.col("_rx") == rx), F.col(v))).alias(f"_{v}{ry}{rx}"))
        aggs.append(F.count(v).alias(f"_n_{v}"))
    quads = contrib.groupBy(*keys, "_ylo", "_yhi", "_xlo", "_xhi").agg(*aggs)
    lat_cells = lat_b.select(F.col("idx").alias("lat_idx"), F.col("lo").alias("_ylo"), F.col("hi").alias("_yhi"),
                             F.col("w").alias("_wy"))
    lon_cells = lon_b.select(F.col("idx").alias("lon_idx"), F.col("lo").alias("_xlo"), F.col("hi").alias("_xhi"),
                             F.col("w").alias("_wx"))
    return quads, lat_cells, lon_cells


def quads_to_cells(quads, values, keys, complete_only: bool = False) -> DataFrame:
    """Expand square corner sets to their target cells with bilinear weights.

    ``complete_only`` keeps only cells whose four corners are all present
    (the rows that carry a value); otherwise every cell touched by any
    corner is returned, NULL where a corner is absent or missing.
    """
    q, lat_cells, lon_cells = quads
    if complete_only:
        cond = None
        for v in values:
            c = F.col(f"_n_{v}") == 4
            cond = c if cond is None else (cond | c)
        q = q.filter(cond)
    cells = (q.join(lat_cells, ["_ylo", "_yhi"]).join(lon_cells, ["_xlo", "_xhi"]))
    wy, wx = F.col("_wy"), F.col("_wx")
    one = F.lit(1.0)
    out = []
    for v in values:
        val = ((one - wy) * (one - wx) * F.col(f"_{v}00") + (one - wy) * wx * F.col(f"_{v}01")
               + wy * (one - wx) * F.col(f"_{v}10") + wy * wx * F.col(f"_{v}11"))
        out.append(F.when(F.col(f"_n_{v}") == 4, val).alias(v))
    return cells.select(*keys, "lat_idx", "lon_idx", *out)


def resample_with_range(source: DataFrame, grid: DataFrame, values, keys, time_col: str,
                        lat: str = "lat", lon: str = "lon"):
    """Bilinear cells that carry a value, plus the first/last ``time_col`` of
    any source square feeding the grid.

    The per-square corner table is checkpointed once; the time range (one
    aggregate row) and the cells both read it, so the source is scanned and
    bracketed a single time.
    """
    keys, values = list(keys), list(values)
    src = source.select(*keys, F.col(lat).alias("_slat"), F.col(lon).alias("_slon"),
                        *[tf.nan_to_null(v).alias(v) for v in values])
    lat_t, lon_t = _axes(grid)
    s_lat = src.select(F.col("_slat").alias("s")).distinct()
    s_lon = src.select(F.col("_slon").alias("s")).distinct()
    q, lat_cells, lon_cells = bilinear_quads(src, lat_t, lon_t, s_lat, s_lon, values, keys)
    q = materialize(q, "bilinear-squares")
    r = q.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    cells = quads_to_cells((q, lat_cells, lon_cells), values, keys, complete_only=True)
    return cells, r["lo"], r["hi"]


# ---- W5: cubic (not-a-knot) spline along each axis, NumPy on workers -------

LINES_PER_GROUP = 64  # grid lines solved together in one task (bounds memory)


def _spline_factor(x: np.ndarray):
    """Tridiagonal factorisation of the not-a-knot system for axis ``x``.

    Unknowns are the second derivatives M0..M_{n-1}; the two not-a-knot
    conditions are folded into the first and last interior rows, so the
    interior system is tridiagonal (Thomas algorithm). Depends on x only, so
    one factorisation serves every line that shares the axis.
    """
    n = len(x)
    h = np.diff(x)
    a = np.zeros(n)
    b = np.zeros(n)
    c = np.zeros(n)
    a[1:-1] = h[:-1]
    b[1:-1] = 2 * (h[:-1] + h[1:])
    c[1:-1] = h[1:]
    # not-a-knot at x1: M0 = ((h0 + h1) M1 - h0 M2) / h1, substituted into row 1
    b[1] += a[1] * (h[0] + h[1]) / h[1]
    c[1] -= a[1] * h[0] / h[1]
    a[1] = 0.0
    # not-a-knot at x_{n-2}: M_{n-1} = ((h_{n-3} + h_{n-2}) M_{n-2} - h_{n-2} M_{n-3}) / h_{n-3}
    hm, hl = h[-2], h[-1]
    b[-2] += c[-2] * (hm + hl) / hm
    a[-2] -= c[-2] * hl / hm
    c[-2] = 0.0
    cp = np.zeros(n)
    den = np.ones(n)
    for i in range(1, n - 1):
        den[i] = b[i] - (a[i] * cp[i - 1] if i > 1 else 0.0)
        cp[i] = c[i] / den[i]
    return h, a, cp, den


def _second_derivs(x: np.ndarray, ys: np.ndarray, fac) -> np.ndarray:
    """Second derivatives for many lines at once (rows of ``ys``)."""
    h, a, cp, den = fac
    n = len(x)
    d = np.diff(ys, axis=1) / h
    r = np.zeros_like(ys)
    r[:, 1:-1] = 6 * (d[:, 1:] - d[:, :-1])
    rp = np.zeros_like(ys)
    for i in range(1, n - 1):
        rp[:, i] = (r[:, i] - (a[i] * rp[:, i - 1] if i > 1 else 0.0)) / den[i]
    m = np.zeros_like(ys)
    for i in range(n - 2, 0, -1):
        m[:, i] = rp[:, i] - (cp[i] * m[:, i + 1] if i < n - 2 else 0.0)
    hm, hl = h[-2], h[-1]
    m[:, 0] = ((h[0] + h[1]) * m[:, 1] - h[0] * m[:, 2]) / h[1]
    m[:, -1] = ((hm + hl) * m[:, -2] - hl * m[:, -3]) / hm
    return m


def cubic_eval_many(x: np.ndarray, ys: np.ndarray, xt: np.ndarray) -> np.ndarray:
    """Not-a-knot cubic splines through (x, each row of ys) at xt.

    A row with any missing value is missing everywhere; targets outside the
    data range are missing; fewer than four points give missing.
    """
    ys = np.atleast_2d(np.asarray(ys, dtype=float))
    out = np.full((ys.shape[0], len(xt)), np.nan)
    if len(x) < 4 or ys.shape[0] == 0:
        return out
    ok = ~np.isnan(ys).any(axis=1)
    if not ok.any():
        return out
    y = ys[ok]
    m = _second_derivs(x, y, _spline_factor(x))
    inside = (xt >= x[0]) & (xt <= x[-1])
    xi = xt[inside]
    k = np.clip(np.searchsorted(x, xi, side="left") - 1, 0, len(x) - 2)
    h = x[k + 1] - x[k]
    t1 = x[k + 1] - xi
    t0 = xi - x[k]
    vals = (m[:, k] * t1 ** 3 / (6 * h) + m[:, k + 1] * t0 ** 3 / (6 * h)
            + (y[:, k] / h - m[:, k] * h / 6) * t1 + (y[:, k + 1] / h - m[:, k + 1] * h / 6) * t0)
    sub = out[ok]
    sub[:, inside] = vals
    out[ok] = sub
    return out


def cubic_eval(x: np.ndarray, y: np.ndarray, xt: np.ndarray) -> np.ndarray:
    """One line: see ``cubic_eval_many``."""
    return cubic_eval_many(x, np.asarray(y, dtype=float)[None, :], xt)[0]


def resample_cubic(source: DataFrame, grid: DataFrame, value: str, keys: Sequence[str] = (),
                   lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Separable cubic interpolation, lon lines first, then lat lines.

    Lines are batched into groups of ``LINES_PER_GROUP`` (one source latitude
    per line in the first pass, one target longitude in the second); each
    task lays its lines onto the full source axis (an absent coordinate is a
    missing value, so that line is missing) and solves all of them with one
    shared tridiagonal factorisation. The source and target axes (one value
    per grid line, bounded by the grid geometry) are read on the driver and
    shipped with the function.
    """
    keys = list(keys)
    lat_t = sorted((r["lat_idx"], r["lat"]) for r in grid.select("lat_idx", "lat").distinct().collect())
    lon_t = sorted((r["lon_idx"], r["lon"]) for r in grid.select("lon_idx", "lon").distinct().collect())
    lon_idx = np.array([i for i, _ in lon_t], dtype=np.int64)
    lon_val = np.array([v for _, v in lon_t])
    lat_idx = np.array([i for i, _ in lat_t], dtype=np.int64)
    lat_val = np.array([v for _, v in lat_t])
    src = source.select(*keys, F.col(lat).alias("_slat"), F.col(lon).alias("_slon"),
                        tf.nan_to_null(value).alias("_v"))
    s_lat = np.array(sorted(r[0] for r in src.select("_slat").distinct().collect()))
    s_lon = np.array(sorted(r[0] for r in src.select("_slon").distinct().collect()))
    spark = source.sparkSession
    lat_rank = spark.createDataFrame([(float(v), i) for i, v in enumerate(s_lat)], "_slat double, _li long")
    key_schema = ", ".join(f"{k} {t}" for k, t in source.select(*keys).dtypes)
    pre = (key_schema + ", ") if key_schema else ""

    def along_lon(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = np.unique(pdf["_slat"].to_numpy(dtype=float))
        ys = np.full((len(lines), len(s_lon)), np.nan)
        ys[np.searchsorted(lines, pdf["_slat"].to_numpy(dtype=float)),
           np.searchsorted(s_lon, pdf["_slon"].to_numpy(dtype=float))] = pdf["_v"].to_numpy(dtype=float)
        vals = cubic_eval_many(s_lon, ys, lon_val)
        out = pd.DataFrame({"_slat": np.repeat(lines, len(lon_idx)), "lon_idx": np.tile(lon_idx, len(lines)),
                            "_v": vals.ravel()})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out

    step1 = (src.join(F.broadcast(lat_rank), "_slat")
                .withColumn("_grp", F.floor(F.col("_li") / LINES_PER_GROUP)).drop("_li")
                .groupBy(*keys, "_grp").applyInPandas(along_lon, f"{pre}_slat double, lon_idx long, _v double"))

    def along_lat(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = np.unique(pdf["lon_idx"].to_numpy())
        ys = np.full((len(lines), len(s_lat)), np.nan)
        ys[np.searchsorted(lines, pdf["lon_idx"].to_numpy()),
           np.searchsorted(s_lat, pdf["_slat"].to_numpy(dtype=float))] = pdf["_v"].to_numpy(dtype=float)
        vals = cubic_eval_many(s_lat, ys, lat_val)
        out = pd.DataFrame({"lon_idx": np.repeat(lines, len(lat_idx)), "lat_idx": np.tile(lat_idx, len(lines)),
                            value: vals.ravel()})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out

    step2 = (step1.withColumn("_grp", F.floor(F.col("lon_idx") / LINES_PER_GROUP))
                  .groupBy(*keys, "_grp").applyInPandas(along_lat, f"{pre}lon_idx long, lat_idx long, {value} double"))
    return step2.select(*keys, F.col("lat_idx").cast("int"), F.col("lon_idx").cast("int"),
                        tf.nan_to_null(value).alias(value))
