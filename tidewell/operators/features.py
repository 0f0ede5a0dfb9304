"""Training-table assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as tf
from .columns import add_season
from .sets import union_sources


def stack_layers(layers: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Merge layers sharing ``keys`` into one row per key.

    Union with missing columns as NULL, then one ``groupBy`` taking each
    layer's value (max of one non-null value): a single shuffle instead of
    an N-way chain of full outer joins.
    """
    keys = list(keys)
    value_cols = [c for df in layers for c in df.columns if c not in keys]
    u = union_sources([df.select(*keys, *[c for c in df.columns if c not in keys]) for df in layers])
    return u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in value_cols])


def combine_presence_absence(presence: DataFrame, absence: DataFrame, status: str = "Shark_Presence_Status",
                             date_column: str = "Date", add_temporal: bool = True) -> DataFrame:
    """Presence (status 1) and absence (status 0) points in one frame.

    All columns of both frames are kept, NULL where a frame has none.
    ``add_temporal`` adds Month, Week_of_Year and Season from ``date_column``,
    NULL for undated points.
    """
    both = union_sources([presence.withColumn(status, F.lit(1)), absence.withColumn(status, F.lit(0))])
    if not add_temporal:
        return both
    if date_column not in both.columns:
        raise ValueError(f"no column {date_column} to take months, weeks and seasons from")
    both = add_season(both, date_column)
    return both.withColumn("Season", F.when(F.col("Month").isNull(), F.lit(None)).otherwise(F.col("Season")))


def extract_features(points: DataFrame, dynamic: Sequence[DataFrame] = (), static: Sequence[DataFrame] = (),
                     date_col: str = "Date", res: float = tf.DEFAULT_RESOLUTION,
                     origin_lon: float = tf.DEFAULT_BBOX["min_lon"], origin_lat: float = tf.DEFAULT_BBOX["min_lat"]
                     ) -> DataFrame:
    """Snap points to their cell (and week) and left-join layer values.

    Dynamic layers are keyed by (week, lat_idx, lon_idx), static ones by
    (lat_idx, lon_idx). Each join is an equi-join on the snapped keys.
    """
    pts = (points.withColumn("lat_idx", tf.snap_index("lat", origin_lat, res))
                 .withColumn("lon_idx", tf.snap_index("lon", origin_lon, res))
                 .withColumn("week", tf.week_label(date_col)))
    for layer in static:
        pts = pts.join(layer, ["lat_idx", "lon_idx"], "left")
    for layer in dynamic:
        pts = pts.join(layer, ["week", "lat_idx", "lon_idx"], "left")
    return pts
