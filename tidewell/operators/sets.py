"""Set operations, limits and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames with differing columns; duplicates kept."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def limit_records(df: DataFrame, n: int, by: str | None, order: str) -> DataFrame:
    """First ``n`` records (by ``order``) per ``by`` group, or overall.

    ``row_number() <= n`` lets Spark insert a partial per-partition group limit
    before the shuffle, so a hot group never ships more than n rows per task.
    """
    if by is None:
        return df.orderBy(order).limit(n)
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def stage_counts(df: DataFrame, by: str = "life_stage", id_col: str = "shark_id") -> DataFrame:
    """Rows and distinct individuals per group."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_points"),
                              F.countDistinct(id_col).alias("n_individuals"))


def track_extents(df: DataFrame, by: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Per-group bounding box (input of P14)."""
    return df.groupBy(by).agg(F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
                              F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"))


def enrich_tracks(tracks: DataFrame, individuals: DataFrame, track_id: str = "shark_id",
                  ind_id: str = "id", fallback_id: str | None = "shark_id") -> DataFrame:
    """Attach individual attributes to pings (inner equi-join).

    The individual key is ``coalesce(id, shark_id)`` when both exist; name and
    sex default to ''. Individuals without pings vanish. Spark picks the join
    (the individuals table is small and AQE broadcasts it at run time).
    """
    key = F.col(ind_id)
    if fallback_id and fallback_id in individuals.columns and fallback_id != ind_id:
        key = F.coalesce(F.col(ind_id), F.col(fallback_id))
    ind = individuals.select(
        key.alias("_ind_key"),
        F.coalesce(F.col("name"), F.lit("")).alias("name"),
        F.coalesce(F.col("sex"), F.lit("")).alias("sex"),
        *[F.col(c) for c in individuals.columns if c not in (ind_id, fallback_id, "name", "sex")])
    return tracks.join(ind, tracks[track_id] == ind["_ind_key"], "inner").drop("_ind_key")
