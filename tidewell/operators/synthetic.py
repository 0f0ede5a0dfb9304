"""Synthetic variables: presence points, absence points, nursery index.

Survey rows Q11, Q12 (G4, J5, W4), Q13 (A10-A12, A15, P21).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as tf
from .sets import enrich_tracks


def presence_points(tracks: DataFrame, individuals: DataFrame,
                    species: str | None = "Carcharodon carcharias") -> DataFrame:
    """Q11 core: pings of one species with individual attributes and stage.

    P6 (species) -> J1 (enrich) -> P17 (stage) -> P13 (status 1).
    """
    ind = individuals if species is None else individuals.filter(F.col("species") == species)
    df = enrich_tracks(tracks, ind, track_id="shark_id", ind_id="id")
    return (df.withColumn("life_stage", tf.life_stage("length_m", "sex"))
              .withColumn("Shark_Presence_Status", F.lit(1)))


def stage_targets(presence: DataFrame, ratio: float = 1.0, stages=tf.STAGES) -> DataFrame:
    """Per stage: n_absence = int(n_presence * ratio) (a tiny table)."""
    return (presence.filter(F.col("life_stage").isin(*stages))
                    .groupBy(F.col("life_stage").alias("stage"))
                    .agg(F.floor(F.count(F.lit(1)) * F.lit(float(ratio))).cast("bigint").alias("n_target")))


def generate_absence(presence: DataFrame, bbox: dict = tf.DEFAULT_BBOX, buffer_km: float = tf.DEFAULT_BUFFER_KM,
                     ratio: float = 1.0, stages=tf.STAGES, seed: int = tf.DEFAULT_SEED,
                     attempts_per_target: int = 10) -> DataFrame:
    """Q12: absence points for every life stage.

    Per stage: n = int(n_presence * ratio) targets; up to 10n hashed-uniform
    candidates in the bbox (G4); candidates within ``buffer_km`` of that
    stage's presence points are rejected (J5, tile anti-join); the first n
    accepted in attempt order are kept (W4). Fewer than n is allowed.
    """
    from .grid import absence_candidates
    from .ranking import first_n
    from .spatial import exclude_buffer

    spark = presence.sparkSession
    staged = presence.filter(F.col("life_stage").isin(*stages))
    targets = stage_targets(staged, ratio, stages)
    cand = absence_candidates(spark, targets, bbox, seed, attempts_per_target)
    pts = staged.select(F.col("life_stage").alias("stage"), "lon", "lat")
    free = exclude_buffer(cand, pts, buffer_km, keys=["stage"])
    kept = first_n(free, "attempt", "n_target", ["stage"])
    return kept.select(F.col("stage").alias("Life_Stage"), "attempt", "lon", "lat",
                       F.lit(0).alias("Shark_Presence_Status"), F.lit("Absence").alias("Point_Type"))


# ---- Q13: nursery suitability index --------------------------------------

def global_mean(df: DataFrame, value: str) -> float | None:
    """A10: mean over the grid ignoring missing values (one scalar)."""
    return df.agg(F.avg(tf.nan_to_null(value)).alias("m")).first()["m"]


def per_file_mean(df: DataFrame, value: str, file_col: str, keys=("lat", "lon"), months=None,
                  time_col: str = "time", out: str | None = None) -> DataFrame:
    """Mean per (file, cell) over (optionally summer) steps, then the
    mean of those means over files per cell."""
    out = out or value
    keys = list(keys)
    src = df
    if months:
        src = src.filter(tf.is_summer(time_col, months))
    per = src.groupBy(file_col, *keys).agg(F.avg(tf.nan_to_null(value)).alias("_m"))
    return per.groupBy(*keys).agg(F.avg("_m").alias(out))


def nursery_index(layers: DataFrame, depth: str = "depth_m", slope: str = "slope_deg", sst: str = "sst_summer",
                  chl: str = "chl", max_depth: float = tf.NURSERY_MAX_DEPTH, max_slope: float = tf.NURSERY_MAX_SLOPE,
                  min_sst: float = tf.NURSERY_MIN_SST, out: str = "Nursery_Index") -> DataFrame:
    """Q13: 0.25 for each passed test (depth in (0, max), slope < max,
    summer SST > min, chlorophyll > grid mean); missing input fails a test.
    The index is single precision, as in the reference."""
    chl_mean = global_mean(layers, chl)
    crit = {
        "depth_ok": (F.col(depth) > 0) & (F.col(depth) < F.lit(max_depth)),
        "slope_ok": F.col(slope) < F.lit(max_slope),
        "sst_ok": F.col(sst) > F.lit(min_sst),
        "chl_ok": (F.col(chl) > F.lit(chl_mean)) if chl_mean is not None else F.lit(False),
    }
    df = layers
    for name, cond in crit.items():
        df = df.withColumn(name, F.coalesce(cond, F.lit(False)))
    score = sum(F.col(n).cast("float") * F.lit(0.25).cast("float") for n in crit)
    return df.withColumn(out, score.cast("float")).withColumn("chl_mean", F.lit(chl_mean).cast("double"))


def index_summary(idx: DataFrame, out: str = "Nursery_Index") -> DataFrame:
    """Cells passing each test, index range, high-suitability cells."""
    return idx.agg(F.count_if("depth_ok").alias("n_depth_ok"), F.count_if("slope_ok").alias("n_slope_ok"),
                   F.count_if("sst_ok").alias("n_sst_ok"), F.count_if("chl_ok").alias("n_chl_ok"),
                   F.min(out).alias("index_min"), F.max(out).alias("index_max"),
                   F.count_if(F.col(out) >= 0.75).alias("n_high"), F.first("chl_mean").alias("chl_mean"))
