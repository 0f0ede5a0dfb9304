"""Grid and sequence generators.

The target grid is generated distributed from ``spark.range`` (no driver
arrays), with integer indices so the axis length never suffers from float
``arange`` drift: ``n = round((max - min) / res) + 1`` and
``coord = min + idx * res``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as tf


def axis_length(lo: float, hi: float, res: float) -> int:
    return int(round((hi - lo) / res)) + 1


def target_grid(spark: SparkSession, bbox: dict = tf.DEFAULT_BBOX,
                res: float = tf.DEFAULT_RESOLUTION, num_partitions: int | None = None) -> DataFrame:
    """G1: one row per cell ``(lat_idx, lon_idx, lat, lon)``, both ends included."""
    n_lat = axis_length(bbox["min_lat"], bbox["max_lat"], res)
    n_lon = axis_length(bbox["min_lon"], bbox["max_lon"], res)
    n = n_lat * n_lon
    parts = num_partitions or n // 250_000 + 1
    return (spark.range(0, n, 1, parts)
            .select((F.col("id") / n_lon).cast("int").alias("lat_idx"),
                    (F.col("id") % n_lon).cast("int").alias("lon_idx"))
            .select("lat_idx", "lon_idx",
                    tf.axis_coord("lat_idx", bbox["min_lat"], res).alias("lat"),
                    tf.axis_coord("lon_idx", bbox["min_lon"], res).alias("lon")))


def grid_shape(bbox: dict, res: float) -> tuple[int, int]:
    return (axis_length(bbox["min_lat"], bbox["max_lat"], res),
            axis_length(bbox["min_lon"], bbox["max_lon"], res))


def data_bbox(df: DataFrame, res: float, lon: str = "lon", lat: str = "lat") -> dict:
    """Extent of a point table snapped outwards to the grid step.

    One aggregate row (four numbers) comes back to the driver; the data stays
    distributed.
    """
    # 1e-9 absorbs float noise of x / res for coordinates already on the grid
    r = df.agg(F.floor(F.min(lon) / res + 1e-9).alias("a"), F.ceil(F.max(lon) / res - 1e-9).alias("b"),
               F.floor(F.min(lat) / res + 1e-9).alias("c"), F.ceil(F.max(lat) / res - 1e-9).alias("d")).first()
    return {"min_lon": r["a"] * res, "max_lon": r["b"] * res,
            "min_lat": r["c"] * res, "max_lat": r["d"] * res}


def weekly_mondays(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every Monday within [start, end] (one column ``week_start`` date)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.next_day(F.date_sub(F.to_date(F.lit(start)), 1), "MO"), F.to_date(F.lit(end)),
        F.expr("interval 7 days"))).alias("week_start"))


def week_spine(df: DataFrame, week_col: str = "week") -> DataFrame:
    """Contiguous Sunday labels from the first to the last data week."""
    bounds = df.agg(F.min(week_col).alias("lo"), F.max(week_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias(week_col))


def absence_candidates(spark: SparkSession, targets: DataFrame, bbox: dict,
                       seed: int = tf.DEFAULT_SEED, attempts_per_target: int = 10) -> DataFrame:
    """Up to ``attempts_per_target * n`` uniform candidates per stage.

    ``targets`` has one row per stage ``(stage, n_target)`` (a handful of
    rows, read on the driver). Each stage gets its own distributed
    ``spark.range`` of attempt numbers; coordinates are hashed uniforms, so
    the result does not depend on partitioning or task order.
    """
    frames = []
    for row in targets.select("stage", "n_target").collect():
        n = int(row["n_target"]) * attempts_per_target
        if n <= 0:
            continue
        parts = n // 200_000 + 1
        frames.append(spark.range(0, n, 1, parts).select(
            F.lit(row["stage"]).alias("stage"), F.col("id").alias("attempt"),
            F.lit(int(row["n_target"])).cast("bigint").alias("n_target")))
    if not frames:
        return spark.createDataFrame([], "stage string, attempt bigint, n_target bigint, lon double, lat double")
    cand = frames[0]
    for f in frames[1:]:
        cand = cand.unionByName(f)
    ux = tf.hashed_uniform(seed, F.col("stage"), F.col("attempt"), "lon")
    uy = tf.hashed_uniform(seed, F.col("stage"), F.col("attempt"), "lat")
    return cand.select(
        "stage", "attempt", "n_target",
        (F.lit(bbox["min_lon"]) + ux * F.lit(bbox["max_lon"] - bbox["min_lon"])).alias("lon"),
        (F.lit(bbox["min_lat"]) + uy * F.lit(bbox["max_lat"] - bbox["min_lat"])).alias("lat"))


def buffer_ring(df: DataFrame, km: float, segments: int = 64, lon: str = "lon", lat: str = "lat",
                out: str = "buffer_wkt") -> DataFrame:
    """Buffer of radius km/111 degrees as a closed polygon ring (WKT)."""
    r = tf.km_to_deg(km)
    verts = F.transform(F.sequence(F.lit(0), F.lit(segments)), lambda i: F.concat_ws(
        " ",
        (F.col(lon) + F.lit(r) * F.cos(i.cast("double") * F.lit(2 * 3.141592653589793 / segments))).cast("string"),
        (F.col(lat) + F.lit(r) * F.sin(i.cast("double") * F.lit(2 * 3.141592653589793 / segments))).cast("string")))
    return df.withColumn("radius_deg", F.lit(r)).withColumn(
        out, F.concat(F.lit("POLYGON (("), F.array_join(verts, ", "), F.lit("))")))


def buffer_vertices(df: DataFrame, segments: int = 64, lon: str = "lon", lat: str = "lat",
                    keys=("lane_id", "vertex_no")) -> DataFrame:
    """G5 as rows: the ring's vertices ``(keys.., k, x, y)``; k = 0..segments."""
    step = 2 * 3.141592653589793 / segments
    return df.select(*keys, F.col(lon), F.col(lat), F.col("radius_deg"),
                     F.explode(F.sequence(F.lit(0), F.lit(segments))).alias("k")).select(
        *keys, "k",
        (F.col(lon) + F.col("radius_deg") * F.cos(F.col("k").cast("double") * F.lit(step))).alias("x"),
        (F.col(lat) + F.col("radius_deg") * F.sin(F.col("k").cast("double") * F.lit(step))).alias("y"))
