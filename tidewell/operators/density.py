"""Kernel density and grid scaling.

Gaussian KDE with full covariance and Scott's factor ``n^(-1/(d+4))``
(``d = 2``): bandwidth matrix = sample covariance x factor^2. The density at
a cell is ``sum_i w_i exp(-q_i / 2) / (n 2 pi sqrt(det))`` with ``q`` the
Mahalanobis distance. Points are grouped into distinct locations with
weights, then matched to cells on tiles sized by the kernel's reach.

The sum is exact to the last bit of a double, in rounds: every cell first
sums the points within 8 standard deviations. What a cell left out is at most
``n * exp(-reach^2 / 2)``; where that could still change the cell's last bit
the cell stays open and is summed anew with twice the reach, up to the reach
beyond which ``exp`` is zero in a double. Cells, bounded by the grid, are
copied to the tiles around them; points, which are not, stay on their own
tile and are cut into blocks there, so no task holds a hot tile whole. The
sums of a tile's block are NumPy matrix products of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import materialize
from .spatial import _tile

# kernel reach by round, in standard deviations; exp(-q / 2) is 0.0 beyond the last
REACHES = (8.0, 16.0, 32.0, 38.62)
# points per kernel task; hotter tiles are cut into blocks
MAX_POINTS_PER_TASK = 100_000
# kernel matrix entries evaluated per NumPy chunk (bounds task memory)
CHUNK_ENTRIES = 2_000_000


def sample_covariance(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """N, sample variances/covariance (n-1) and Scott's factor n^(-1/6)."""
    p = points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    return p.agg(F.count(F.lit(1)).alias("n"), F.var_samp(lon).alias("var_lon"), F.var_samp(lat).alias("var_lat"),
                 F.covar_samp(lon, lat).alias("cov_lon_lat")).withColumn(
        "scott_factor", F.pow(F.col("n").cast("double"), F.lit(-1.0 / 6.0)))


def kde_raw(cells: DataFrame, points: DataFrame, lon: str = "lon", lat: str = "lat",
            cell_keys=("lat_idx", "lon_idx"), bandwidth_km: float | None = None):
    """Return ``(cells with _s = sum w exp(-q/2), stats dict)``; cells None when n < 2 or the points lie on a line."""
    cell_keys = list(cell_keys)
    st = sample_covariance(points, lon, lat).first()
    n = int(st["n"])
    if n < 2:
        return None, {"n": n}
    f = n ** (-1.0 / 6.0)
    if bandwidth_km is not None:
        # isotropic bandwidth given in km (config option); 111 km per degree
        bw = bandwidth_km / 111.0
        a, b, d = bw * bw, 0.0, bw * bw
    else:
        a = st["var_lon"] * (f * f)
        b = st["cov_lon_lat"] * (f * f)
        d = st["var_lat"] * (f * f)
    det = a * d - b * b
    stats = {"n": n, "a": a, "b": b, "d": d, "det": det}
    if not det > 0:
        return None, stats
    coef = (d / det, -2.0 * b / det, a / det)
    loc = materialize(points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
                            .groupBy(F.col(lon).alias("_px"), F.col(lat).alias("_py"))
                            .agg(F.count(F.lit(1)).alias("_w")), "kde-locations")
    open_cells = cells.select(*cell_keys, F.col("lon").alias("_cx"), F.col("lat").alias("_cy"))
    key_types, closed = cells.select(*cell_keys).dtypes, None
    for reach in REACHES:
        parts = _kernel_sums(open_cells, loc, cell_keys, coef, reach * math.sqrt(a), reach * math.sqrt(d), key_types)
        s = materialize(open_cells.join(parts, cell_keys, "left")
                                  .withColumn("_s", F.coalesce(F.col("_s"), F.lit(0.0))), "kde-sums")
        left_out = F.lit(n * math.exp(-reach * reach / 2)) if reach != REACHES[-1] else F.lit(0.0)
        enough = F.col("_s") * F.lit(2.0 ** -53) >= left_out
        done = s.filter(enough).select(*cell_keys, "_s")
        closed = done if closed is None else closed.unionByName(done)
        open_cells = s.filter(~enough).drop("_s")
        if reach == REACHES[-1] or open_cells.isEmpty():
            break
    return cells.join(closed, cell_keys, "left"), stats


def _kernel_sums(c, loc, cell_keys, coef, sx, sy, key_types, reach: int = 2):
    """Kernel sums per point tile with NumPy on Arrow batches.

    Tiles are 1/reach of the kernel's reach; cells are copied to the
    (2*reach+1)^2 tiles around them. A tile with more than MAX_POINTS_PER_TASK
    points is cut into blocks (its cells are copied per block) and the partial
    sums are added up afterwards. Each task evaluates its kernel matrix in
    chunks of CHUNK_ENTRIES.
    """
    c11, c12, c22 = coef
    tx, ty = sx / reach * (1 + 1e-9), sy / reach * (1 + 1e-9)
    offs = F.array(*[F.lit(o) for o in range(-reach, reach + 1)])
    tiled = loc.withColumn("_tx", _tile("_px", tx)).withColumn("_ty", _tile("_py", ty))
    blocks = tiled.groupBy("_tx", "_ty").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(MAX_POINTS_PER_TASK)).cast("int").alias("_nb"))
    tiled = (tiled.join(blocks, ["_tx", "_ty"])
                  .withColumn("_b", F.pmod(F.xxhash64("_px", "_py"), F.col("_nb")).cast("int")).drop("_nb"))
    near = (c.withColumn("_ox", F.explode(offs)).withColumn("_oy", F.explode(offs))
             .withColumn("_tx", _tile("_cx", tx) + F.col("_ox")).withColumn("_ty", _tile("_cy", ty) + F.col("_oy"))
             .drop("_ox", "_oy").join(blocks, ["_tx", "_ty"])
             .withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))).drop("_nb"))
    keys = list(cell_keys)

    def kernel(cpdf: pd.DataFrame, ppdf: pd.DataFrame) -> pd.DataFrame:
        if cpdf.empty or ppdf.empty:
            return pd.DataFrame({**{k: cpdf[k].iloc[:0] for k in keys}, "_s": np.zeros(0)})
        cx = cpdf["_cx"].to_numpy(dtype=float)
        cy = cpdf["_cy"].to_numpy(dtype=float)
        px = ppdf["_px"].to_numpy(dtype=float)
        py = ppdf["_py"].to_numpy(dtype=float)
        w = ppdf["_w"].to_numpy(dtype=float)
        out = np.empty(len(cx))
        step = max(1, CHUNK_ENTRIES // len(px))
        for i in range(0, len(cx), step):
            dx = cx[i:i + step, None] - px[None, :]
            dy = cy[i:i + step, None] - py[None, :]
            out[i:i + step] = np.exp(-0.5 * (c11 * dx * dx + c12 * dx * dy + c22 * dy * dy)) @ w
        return pd.DataFrame({**{k: cpdf[k].to_numpy() for k in keys}, "_s": out})

    schema = ", ".join(f"{k} {t}" for k, t in key_types) + ", _s double"
    parts = (near.groupBy("_tx", "_ty", "_b").cogroup(tiled.groupBy("_tx", "_ty", "_b"))
                 .applyInPandas(kernel, schema))
    return parts.groupBy(*keys).agg(F.sum("_s").alias("_s"))


def kde_density(cells: DataFrame, points: DataFrame, out: str = "density", **kw) -> DataFrame:
    """C3 (unscaled): probability density at each cell centre."""
    raw, st = kde_raw(cells, points, **kw)
    if raw is None:
        val = F.lit(0.0) if st["n"] < 2 else F.lit(None).cast("double")
        return cells.withColumn(out, val)
    norm = st["n"] * 2.0 * math.pi * math.sqrt(st["det"])
    return raw.withColumn(out, F.col("_s") / F.lit(norm)).drop("_s")


def minmax_scale(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    """(x - min) / (max - min) over the whole layer; NULL when constant.

    The two extremes are one aggregate row read on the driver.
    """
    out = out or value
    mm = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if mm["lo"] is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    lo, hi = float(mm["lo"]), float(mm["hi"])
    return df.withColumn(out, F.try_divide(F.col(value) - F.lit(lo), F.lit(hi - lo) if hi != lo
                                           else F.lit(None).cast("double")))


def density_index(cells: DataFrame, points: DataFrame, out: str = "Orca_Density_Index", **kw) -> DataFrame:
    """Q8 core: KDE scaled to [0, 1] over the grid; zeros when n < 2."""
    raw, st = kde_raw(cells, points, **kw)
    if raw is None:
        val = F.lit(0.0) if st["n"] < 2 else F.lit(None).cast("double")
        return cells.withColumn(out, val)
    # the kernel sums feed both the extremes and the output: compute them once
    raw = materialize(raw, "kde-sums")
    return minmax_scale(raw, "_s", out).drop("_s")
