"""Weekly layers as strips of grid lines (Q1-Q4 on any grid, W1 on weekly cubes).

A row is a week, a line of the grid, a strip of ``STRIP`` cells along it and
the array of their values. Three things make it cheap:

* Bilinear interpolation is linear, and whether a cell has a value depends on
  its source square alone. So the weekly mean is taken over the corners of
  each square, on the source's resolution, and only then laid out on the grid.
* Squares are dealt to blocks of ``BLOCK`` lines once, also to the block whose
  neighbour line they reach. A task lays out its block with one line more on
  either side, and both derivatives of the gradient come from that: one
  exchange, no window.
* Nothing is laid out for weeks without a square.

Memory of a task: one block of lines of one week.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as tf
from . import grid as G
from . import resample as RS

BLOCK = 64
STRIP = 32
KEYS = ("week", "lat_idx", "strip")
CORNERS = ("00", "01", "10", "11")


def weekly_squares(source: DataFrame, grid: DataFrame, values: Sequence[str], time_col: str = "time") -> DataFrame:
    """``(week, ylo, yhi, xlo, xhi, y0, x0, <value>00..11)`` for each week and square of the source.

    Corners are means over the week's times at which all four have a value, NULL if there is none. ``y0`` and ``x0`` are
    the source's first coordinates: there alone a square holds its lower edge.
    """
    edge = source.agg(F.min("lat").alias("y0"), F.min("lon").alias("x0")).first()
    src = source.select(F.col(time_col).alias("_time"), F.col("lat").alias("_slat"), F.col("lon").alias("_slon"),
                        *[tf.nan_to_null(v).alias(v) for v in values])
    lat_t, lon_t = RS._axes(grid)
    quads, _, _ = RS.bilinear_quads(src, lat_t, lon_t, src.select(F.col("_slat").alias("s")).distinct(),
                                    src.select(F.col("_slon").alias("s")).distinct(), list(values), ["_time"])
    return quads.groupBy(tf.week_label("_time").alias("week"), F.col("_ylo").alias("ylo"), F.col("_yhi").alias("yhi"),
                         F.col("_xlo").alias("xlo"), F.col("_xhi").alias("xhi")).agg(
        *[F.avg(F.when(F.col(f"_n_{v}") == 4, F.col(f"_{v}{c}"))).alias(f"{v}{c}") for v in values for c in CORNERS],
        F.lit(edge["y0"]).cast("double").alias("y0"), F.lit(edge["x0"]).cast("double").alias("x0"))


def _as_lists(values: np.ndarray) -> pa.ListArray:
    flat = pa.array(values.ravel(), mask=np.isnan(values).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), flat)


def derivative(before: np.ndarray, at: np.ndarray, after: np.ndarray, h: float) -> np.ndarray:
    """Centred difference; one-sided where a neighbour is not there (``None``)."""
    if before is None:
        return (after - at) / h
    return (at - before) / h if after is None else (after - before) / (2.0 * h)


def gradient_of(block: np.ndarray, first: int, lines: range, n_lat: int, h: float) -> np.ndarray:
    """W1 for ``lines``, whose neighbours are in ``block``, the grid's lines from ``first``."""
    own = block[lines.start - first:lines.stop - first]
    dx = np.empty_like(own)
    dx[:, 1:-1] = derivative(own[:, :-2], own[:, 1:-1], own[:, 2:], h)
    dx[:, 0] = derivative(None, own[:, 0], own[:, 1], h)
    dx[:, -1] = derivative(own[:, -2], own[:, -1], None, h)
    dy = np.stack([derivative(block[i - first - 1] if i else None, block[i - first],
                              block[i - first + 1] if i + 1 < n_lat else None, h) for i in lines])
    return np.sqrt(dx * dx + dy * dy)


def lay_out(squares: DataFrame, bbox: dict, res: float, layers: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """``(week, lat_idx, strip, columns)`` from ``weekly_squares``: arrays of ``STRIP`` cells, NULL where there is no value.

    ``layers`` names, for each value, its column and that of its gradient (or None). Strips without any value are not
    written; the last strip of a line is padded with NULL.
    """
    n_lat, n_lon = G.grid_shape(bbox, res)
    if any(g for *_, g in layers) and min(n_lat, n_lon) < 2:
        raise ValueError("gradient needs at least two cells along each axis")
    lat0, lon0, h = bbox["min_lat"], bbox["min_lon"], res * tf.KM_PER_DEG
    n_strips = -(-n_lon // STRIP)
    columns = [c for _, *outs in layers for c in outs if c]

    def block_of(line: Column) -> Column:
        return F.floor(F.greatest(F.lit(0), F.least(F.lit(n_lat - 1), line)) / BLOCK).cast("int")

    dealt = squares.withColumn("block", F.explode(F.sequence(block_of(F.floor((F.col("ylo") - lat0) / res) - 2),
                                                             block_of(F.ceil((F.col("yhi") - lat0) / res) + 2))))

    def within(axis: np.ndarray, lo: float, hi: float, least: float) -> tuple[slice, np.ndarray]:
        a, b = np.searchsorted(axis, lo, "left" if lo == least else "right"), np.searchsorted(axis, hi, "right")
        return slice(a, b), (axis[a:b] - lo) / (hi - lo)

    def block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number = key[1].as_py()
        lines = range(number * BLOCK, min((number + 1) * BLOCK, n_lat))
        first, stop = max(0, lines.start - 1), min(n_lat, lines.stop + 1)
        lat, lon = lat0 + np.arange(first, stop) * res, lon0 + np.arange(n_lon) * res
        edges = list(zip(*[table.column(c).to_numpy() for c in ("ylo", "yhi", "xlo", "xhi", "y0", "x0")], strict=True))
        places = [(within(lat, ylo, yhi, y0), within(lon, xlo, xhi, x0)) for ylo, yhi, xlo, xhi, y0, x0 in edges]
        found = []
        for value, out, gradient in layers:
            laid = np.full((stop - first, n_lon), np.nan)
            corners = [table.column(value + c).to_numpy(zero_copy_only=False) for c in CORNERS]  # NULL becomes NaN
            for ((y, wy), (x, wx)), v00, v01, v10, v11 in zip(places, *corners, strict=True):
                up = wy[:, None]
                laid[y, x] = (1.0 - up) * (1.0 - wx) * v00 + (1.0 - up) * wx * v01 + up * (1.0 - wx) * v10 + up * wx * v11
            found.append(laid[lines.start - first:lines.stop - first])
            if gradient:
                found.append(gradient_of(laid, first, lines, n_lat, h))
        strips = [np.pad(f, ((0, 0), (0, n_strips * STRIP - n_lon)), constant_values=np.nan).reshape(-1, STRIP) for f in found]
        some = ~np.all([np.isnan(f).all(axis=1) for f in strips], axis=0)
        lat_idx, strip = np.repeat(np.arange(lines.start, lines.stop), n_strips)[some], np.tile(np.arange(n_strips), len(lines))[some]
        return pa.Table.from_arrays([pa.repeat(key[0], len(lat_idx)), pa.array(lat_idx, pa.int32()), pa.array(strip, pa.int32()),
                                     *[_as_lists(f[some]) for f in strips]], ["week", "lat_idx", "strip", *columns])

    # a few squares become thousands of cells: dealt to all tasks, whatever their size
    tasks = int(squares.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "week", "block").groupBy("week", "block").applyInArrow(
        block, "week date, lat_idx int, strip int, " + ", ".join(f"`{c}` array<double>" for c in columns))


def every_strip(weeks: DataFrame, bbox: dict, res: float) -> DataFrame:
    """``(week, lat_idx, strip)``: all strips of the grid for each week."""
    n_lat, n_lon = G.grid_shape(bbox, res)
    lines = weeks.select("week", F.explode(F.sequence(F.lit(0), F.lit(n_lat - 1))).alias("lat_idx"))
    return lines.select("week", "lat_idx", F.explode(F.sequence(F.lit(0), F.lit(-(-n_lon // STRIP) - 1))).alias("strip"))


def as_strips(layer: DataFrame, value: str) -> DataFrame:
    """A sparse layer of ``(week, lat_idx, lon_idx, value)`` as strips: a map from the place in the strip to the value."""
    place = F.pmod("lon_idx", F.lit(STRIP))
    return layer.groupBy("week", "lat_idx", F.floor(F.col("lon_idx") / STRIP).cast("int").alias("strip")).agg(
        F.map_from_entries(F.collect_list(F.struct(place.alias("place"), value))).alias(value))


def at_places(points: DataFrame, layers: Sequence[DataFrame], lon_idx: str = "lon_idx") -> DataFrame:
    """J11 on stored strips: each point of ``(week, lat_idx, lon_idx)`` with the layers' values at its cell."""
    out = points.withColumn("strip", F.floor(F.col(lon_idx) / STRIP).cast("int")).withColumn("_place", F.pmod(F.col(lon_idx), F.lit(STRIP)))
    for one in layers:
        kinds = dict(one.dtypes)
        out = out.join(one.hint("merge"), list(KEYS), "left")
        for v in (c for c in one.columns if c not in KEYS):
            out = out.withColumn(v, F.col(v)[F.col("_place")] if kinds[v].startswith("map") else F.get(v, F.col("_place")))
    return out.drop("strip", "_place")


def total(values: Column) -> Column:
    """Sum of an array's values, missing ones as zero."""
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def count(value: str) -> Column:
    """Number of values in a strip, none where there is no strip."""
    return F.coalesce(F.size(F.filter(value, lambda x: x.isNotNull())), F.lit(0)).cast("long")


def placed(value: str) -> Column:
    """Sum of a strip's values, each times its place on the line (from 1)."""
    return total(F.transform(value, lambda x, i: x * (F.col("strip") * STRIP + i + 1)))
