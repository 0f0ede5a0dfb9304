"""Neighbourhood operators on the dense grid (W1 gradient, W2 slope).

Gradient follows the centred-difference rule on a regular grid: interior
``(f[i+1] - f[i-1]) / 2h``, first/last cell one-sided ``/ h``, with the
spacing ``h = res * 111`` (km for gradients, x1000 m for slope). Missing
values propagate; a missing centre with present neighbours still gets an
interior value. Rows must be dense (every cell of the grid present, value
possibly NULL): ``densify`` left-joins a layer to the grid first.

The x derivative is a window over one grid row (``partitionBy(keys,
lat_idx)``), the y derivative one over a grid column, so a window partition
never exceeds one grid line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as tf

# Fixed value: metres per degree used for slope spacing.
M_PER_DEG = 111000.0


def densify(layer: DataFrame, grid: DataFrame) -> DataFrame:
    """Left-join a static sparse layer onto every grid cell."""
    return grid.select("lat_idx", "lon_idx").join(layer, ["lat_idx", "lon_idx"], "left")


def densify_weeks(layer: DataFrame, grid: DataFrame, week_col: str = "week", lo=None, hi=None) -> DataFrame:
    """Every (week, cell) between the layer's first and last week, left-joined.

    The week range is two scalars; each grid cell explodes its own week
    sequence (a generator, no Cartesian product), then one equi-join brings
    the values. Cells are dealt to as many tasks as the session has shuffle
    partitions first: a row of cells becomes hundreds of weeks. ``lo``/``hi`` (Sundays)
    override the range taken from the layer.
    """
    if lo is None or hi is None:
        b = layer.agg(F.min(week_col).alias("lo"), F.max(week_col).alias("hi")).first()
        lo, hi = b["lo"], b["hi"]
    if lo is None:
        return layer
    tasks = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grid.select("lat_idx", "lon_idx").repartition(tasks, "lat_idx", "lon_idx")
    spine = dealt.select("lat_idx", "lon_idx", F.explode(F.sequence(
        F.lit(lo), F.lit(hi), F.expr("interval 7 days"))).alias(week_col))
    return spine.join(layer, [week_col, "lat_idx", "lon_idx"], "left")


def _axis_derivative(df: DataFrame, value: str, along: str, across: str, keys, h: float, n: int):
    w = Window.partitionBy(*keys, across).orderBy(along)
    prev = F.lag(value).over(w)
    nxt = F.lead(value).over(w)
    cur = F.col(value)
    i = F.col(along)
    return (F.when(i == 0, (nxt - cur) / F.lit(h))
             .when(i == n - 1, (cur - prev) / F.lit(h))
             .otherwise((nxt - prev) / F.lit(2.0 * h)))


def gradient_components(df: DataFrame, value: str, h: float, n_lat: int, n_lon: int,
                        keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``_dx`` (along lon) and ``_dy`` (along lat) to a dense layer; spacing h."""
    if n_lat < 2 or n_lon < 2:
        raise ValueError("gradient needs at least two cells along each axis")
    keys = list(keys)
    df = df.withColumn("_dx", _axis_derivative(df, value, "lon_idx", "lat_idx", keys, h, n_lon))
    return df.withColumn("_dy", _axis_derivative(df, value, "lat_idx", "lon_idx", keys, h, n_lat))


def gradient_magnitude(df: DataFrame, value: str, res: float, n_lat: int, n_lon: int,
                       keys: Sequence[str] = (), out: str = "gradient") -> DataFrame:
    """|grad f| per cell (per key, e.g. per week), units value/km."""
    g = gradient_components(df, value, res * tf.KM_PER_DEG, n_lat, n_lon, keys)
    return g.withColumn(out, F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))).drop("_dx", "_dy")


def slope_degrees(df: DataFrame, value: str, res: float, n_lat: int, n_lon: int,
                  keys: Sequence[str] = (), out: str = "Slope_deg") -> DataFrame:
    """Slope in degrees from a height/depth raster (spacing in metres)."""
    g = gradient_components(df, value, res * M_PER_DEG, n_lat, n_lon, keys)
    mag = F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))
    return g.withColumn(out, F.degrees(F.atan(mag))).drop("_dx", "_dy")
