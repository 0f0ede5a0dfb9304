"""Weekly mean of live pings as a Structured Streaming query (A1 on a stream).

Event-time windows of 7 days aligned to Monday 00:00 UTC (the epoch is a
Thursday, so ``startTime = 4 days``), labelled by their Sunday like the
batch operator. ``late`` has no default: in append mode a week is emitted once,
``late`` after its end, and what comes later than that is not in it, so the
caller has to state how late its source can be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as tf


def weekly_mean_stream(pings: DataFrame, value: str, late: str, time_col: str = "ts",
                       keys: Sequence[str] = ("lat_idx", "lon_idx"), out: str | None = None) -> DataFrame:
    """Streaming weekly mean per key; ``pings`` is a streaming DataFrame."""
    out = out or value
    keys = list(keys)
    ts = F.col(time_col).cast("timestamp")
    agg = (pings.withColumn("_et", ts).withWatermark("_et", late)
                .groupBy(F.window("_et", "7 days", "7 days", "4 days").alias("_w"), *keys)
                .agg(F.avg(tf.nan_to_null(value)).alias(out), F.count(F.lit(1)).alias("n_pings")))
    return agg.select(F.date_sub(F.to_date(F.col("_w.end")), 1).alias("week"), *keys, out, "n_pings")


def snap_pings(pings: DataFrame, res: float = tf.DEFAULT_RESOLUTION, origin_lon: float = tf.DEFAULT_BBOX["min_lon"],
               origin_lat: float = tf.DEFAULT_BBOX["min_lat"]) -> DataFrame:
    """Grid cell of each ping (works on batch and streaming frames)."""
    return (pings.withColumn("lat_idx", tf.snap_index("lat", origin_lat, res))
                 .withColumn("lon_idx", tf.snap_index("lon", origin_lon, res)))
