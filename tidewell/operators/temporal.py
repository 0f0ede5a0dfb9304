"""Weekly aggregation, climatology, temporal interpolation and alignment.

Survey rows A1-A8, A17-A19, W3, W6, J7, G3. Long form throughout: one row
per (time, cell). Aggregations are plain ``groupBy`` so Spark does the
map-side partial aggregate before the shuffle; the exact median first
collapses equal values into counts and ranks values only inside the value
bin that holds the middle, so no group is gathered or sorted whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as tf
from .lineage import materialize

WEEKLY_METHODS = ("mean", "sum", "median", "max", "min")


MEDIAN_BINS = 256
# groups with at most this many distinct values are ranked by one window
MEDIAN_DIRECT = 10_000


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str,
                 bins: int = MEDIAN_BINS, direct: int = MEDIAN_DIRECT) -> DataFrame:
    """Exact median per group (even counts averaged), with bounded tasks.

    Equal values are pre-counted (map-side combine), once. A group with at
    most ``direct`` distinct values is ranked by one window. The distinct
    values of any larger group are cut into ``bins`` ranges at approximate
    quantiles (a mergeable, bounded sketch; the answer stays exact because
    any monotone split works); exact running counts over the bins locate the
    one(s) holding the middle position(s), and only those are ranked, so no
    task sorts a whole hot group.
    """
    keys = list(keys)
    counts = materialize(df.filter(F.col(value).isNotNull())
                           .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), "median-counts")
    sizes = materialize(counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d")), "median-sizes")
    small = counts.join(sizes.filter(F.col("_d") <= direct), keys).withColumn("_lo", F.lit(1).cast("bigint"))
    picked = _middle_values(small, keys, [], value)
    large = sizes.filter(F.col("_d") > direct)
    if not large.isEmpty():
        picked = picked.unionByName(_middle_values(_middle_bins(counts.join(large, keys), keys, value, bins),
                                                   keys, ["_bin"], value))
    return picked.groupBy(*keys).agg(((F.max("_v1") + F.max("_v2")) / 2).alias(out))


def _middle_positions():
    """1-based positions of the middle element(s) of ``_n``."""
    return F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1


def _middle_values(rows: DataFrame, keys: list[str], within: list[str], value: str) -> DataFrame:
    """``_v1`` and ``_v2`` where a value covers a middle position; ``_lo`` is the first position of the rows' part."""
    p1, p2 = _middle_positions()
    w = Window.partitionBy(*keys, *within).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (rows.withColumn("_vhi", F.col("_lo") - 1 + F.sum("_c").over(w))
                  .withColumn("_vlo", F.col("_vhi") - F.col("_c") + 1))
    return ranked.select(*keys,
                         F.when((F.col("_vlo") <= p1) & (F.col("_vhi") >= p1), F.col(value)).alias("_v1"),
                         F.when((F.col("_vlo") <= p2) & (F.col("_vhi") >= p2), F.col(value)).alias("_v2"))


def _middle_bins(counts: DataFrame, keys: list[str], value: str, bins: int) -> DataFrame:
    """Of each group the bins that hold its middle, with ``_lo``, the bin's first position."""
    bounds = counts.groupBy(*keys).agg(F.percentile_approx(value, [i / bins for i in range(1, bins)], 10000).alias("_b"))
    binned = (counts.join(bounds, keys)
                    .withColumn("_bin", F.size(F.filter("_b", lambda b: b < F.col(value)))).drop("_b"))
    per_bin = binned.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_bc"), F.first("_n").alias("_n"))
    wb = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    p1, p2 = _middle_positions()
    per_bin = (per_bin.withColumn("_hi", F.sum("_bc").over(wb)).withColumn("_lo", F.col("_hi") - F.col("_bc") + 1)
                      .filter(((F.col("_lo") <= p1) & (F.col("_hi") >= p1)) | ((F.col("_lo") <= p2) & (F.col("_hi") >= p2))))
    return binned.join(per_bin.select(*keys, "_bin", "_lo"), [*keys, "_bin"])


def _agg_expr(method: str, value: str, out: str):
    if method == "mean":
        return F.avg(value).alias(out)
    if method == "sum":
        # an all-missing group sums to 0 (pandas/xarray skipna semantics)
        return F.coalesce(F.sum(value), F.lit(0.0)).alias(out)
    if method == "max":
        return F.max(value).alias(out)
    if method == "min":
        return F.min(value).alias(out)
    raise ValueError(f"method {method!r} is none of {WEEKLY_METHODS}")


def aggregate_weekly(df: DataFrame, value: str = "value", method: str = "mean",
                     time_col: str = "time", keys: Sequence[str] = ("lat", "lon"),
                     out: str | None = None, fill: bool = True) -> DataFrame:
    """A1-A5: weekly aggregate per cell, labelled by the closing Sunday.

    With ``fill`` every cell gets every week between the first and last data
    week (W6); empty weeks carry NULL.
    """
    if method not in WEEKLY_METHODS:
        raise ValueError(f"method {method!r} is none of {WEEKLY_METHODS}")
    out = out or value
    keys = list(keys)
    wk = df.select(*keys, tf.week_label(time_col).alias("week"), tf.nan_to_null(value).alias(value))
    span = wk.agg(F.min("week").alias("lo"), F.max("week").alias("hi")).first() if fill else None
    if method == "median":
        agg = exact_median(wk, ["week", *keys], value, out)
        # groups whose values are all missing still exist (NULL median)
        agg = wk.select("week", *keys).distinct().join(agg, ["week", *keys], "left")
    else:
        agg = wk.groupBy("week", *keys).agg(_agg_expr(method, value, out))
    return fill_empty_weeks(agg, keys, lo=span["lo"], hi=span["hi"]) if fill else agg


def fill_empty_weeks(agg: DataFrame, keys: Sequence[str], week_col: str = "week", lo=None, hi=None) -> DataFrame:
    """Materialise missing weeks per cell as NULL rows.

    The week range is two scalars, ``lo`` and ``hi`` where the caller knows
    them from its source, else read from ``agg``. Each row then makes the
    empty weeks before it (a cell's last row also those behind), so the
    aggregate runs once and nothing is joined.
    """
    keys = list(keys)
    if lo is None:
        span = agg.agg(F.min(week_col).alias("lo"), F.max(week_col).alias("hi")).first()
        lo, hi = span["lo"], span["hi"]
        if lo is None:
            return agg
    w = Window.partitionBy(*keys).orderBy(week_col)
    begin = F.coalesce(F.date_add(F.lag(week_col).over(w), 7), F.lit(lo))
    end = F.when(F.lead(week_col).over(w).isNull(), F.lit(hi)).otherwise(F.col(week_col))
    weeks = agg.withColumn("_begin", begin).withColumn("_end", end).withColumn(
        "_week", F.explode(F.sequence("_begin", "_end", F.expr("interval 7 days"))))
    own = F.col("_week") == F.col(week_col)
    return weeks.select(*[F.col("_week").alias(c) if c == week_col else F.col(c) if c in keys
                          else F.when(own, F.col(c)).alias(c) for c in agg.columns])


def climatology(df: DataFrame, value: str = "value", by: str = "month", time_col: str = "time",
                keys: Sequence[str] = ("lat", "lon"), out: str | None = None) -> DataFrame:
    """Mean per (month | ISO week | season) and cell over all years."""
    out = out or value
    if by == "month":
        k = F.month(time_col).cast("int")
    elif by == "week":
        k = tf.iso_week(time_col)
    elif by == "season":
        k = tf.season_code(time_col)
    else:
        raise ValueError(f"by={by!r} is none of month, week, season")
    return (df.select(k.alias(by), *keys, tf.nan_to_null(value).alias("_v"))
              .groupBy(by, *keys).agg(F.avg("_v").alias(out)))


def _epoch_micros(c):
    """Whole microseconds of a wall-clock time since 1970, without any time zone."""
    t = F.col(c).cast("timestamp_ntz")
    minutes = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long") * 1440 + F.hour(t) * 60 + F.minute(t)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")


def interpolate_weekly(df: DataFrame, start: str, end: str, value: str = "value",
                       time_col: str = "time", keys: Sequence[str] = ("lat", "lon"),
                       out: str | None = None) -> DataFrame:
    """Linear interpolation in time at the Mondays of [start, end].

    Per series, each observation is paired with the next one (``lead``); the
    Mondays inside the bracket ``(t, t_next]`` (the first bracket also takes
    ``t``) are exploded from that row, so there is no theta join. No
    extrapolation; a bracket touching a missing value yields missing. A time
    that a series repeats counts once, with the mean of its values.
    """
    out = out or value
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("_t")
    series = df.select(*keys, F.col(time_col).cast("timestamp_ntz").alias("_t"), tf.nan_to_null(value).alias("_v"))
    if keys:  # one shuffle by series serves the mean per time and the window
        series = series.repartition(*keys)
    br = (series.groupBy(*keys, "_t").agg(F.avg("_v").alias("_v"))
            .withColumn("_t2", F.lead("_t").over(w))
            .withColumn("_v2", F.lead("_v").over(w))
            .withColumn("_first", F.row_number().over(w) == 1)
            .filter(F.col("_t2").isNotNull()))
    # first day whose midnight is inside the bracket's lower bound
    day0 = F.to_date("_t")
    at_midnight = day0.cast("timestamp_ntz") == F.col("_t")
    start_day = F.when(F.col("_first") & at_midnight, day0).otherwise(F.date_add(day0, 1))
    first_mon = F.next_day(F.date_sub(start_day, 1), "MO")
    lo = F.greatest(first_mon, F.next_day(F.date_sub(F.to_date(F.lit(start)), 1), "MO"))
    hi = F.least(F.to_date("_t2"), F.to_date(F.lit(end)))
    mondays = F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 7 days"))).otherwise(
        F.array().cast("array<date>"))
    ex = br.select(*keys, "_t", "_t2", "_v", "_v2", F.explode(mondays).alias("week_start"))
    frac = ((_epoch_micros("week_start") - _epoch_micros("_t"))
            / (_epoch_micros("_t2") - _epoch_micros("_t")))
    return ex.select(*keys, "week_start", (F.col("_v") + (F.col("_v2") - F.col("_v")) * frac).alias(out))


def align_series(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "outer",
                 time_a: str | None = None, time_b: str | None = None) -> DataFrame:
    """Align two series on all shared coordinates; both values kept.

    ``time_b`` is renamed to ``time_a`` first (the reference renames the
    second series' time coordinate). ``how`` in inner/outer/left/right.
    """
    if how not in ("inner", "outer", "left", "right"):
        raise ValueError(f"Unknown alignment: {how}")
    if time_a and time_b and time_a != time_b:
        b = b.withColumnRenamed(time_b, time_a)
    return a.join(b, list(on), "full_outer" if how == "outer" else how)


def effort_grid(df: DataFrame, res: float = tf.DEFAULT_RESOLUTION, origin_lon: float = tf.DEFAULT_BBOX["min_lon"],
                origin_lat: float = tf.DEFAULT_BBOX["min_lat"], time_col: str = "ts",
                hours: str = "hours", out: str = "Fishing_Effort_h_km2") -> DataFrame:
    """Fishing hours per 0.1-degree cell and week, per km^2."""
    area = (res * tf.KM_PER_DEG) ** 2
    snapped = df.select(tf.week_label(time_col).alias("week"),
                        tf.snap_index("lat", origin_lat, res).alias("lat_idx"),
                        tf.snap_index("lon", origin_lon, res).alias("lon_idx"),
                        tf.nan_to_null(hours).alias("_h"))
    return (snapped.groupBy("week", "lat_idx", "lon_idx")
                   .agg((F.coalesce(F.sum("_h"), F.lit(0.0)) / F.lit(area)).alias(out),
                        F.count(F.lit(1)).alias("n_records")))


def bottom_value(df: DataFrame, value: str = "o_an", depth: str = "depth_m",
                 keys: Sequence[str] = ("lat_idx", "lon_idx"), out: str = "Oxygen_bottom_ml_L") -> DataFrame:
    """Value at the deepest level that has one, per cell."""
    v = tf.nan_to_null(value)
    return (df.select(*keys, F.col(depth).alias("_d"), v.alias("_v"))
              .groupBy(*keys)
              .agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_d"))).alias(out),
                   F.max(F.when(F.col("_v").isNotNull(), F.col("_d"))).alias("bottom_depth_m")))


def block_mean(df: DataFrame, value: str = "value", res: float = tf.DEFAULT_RESOLUTION,
               origin_lon: float = tf.DEFAULT_BBOX["min_lon"], origin_lat: float = tf.DEFAULT_BBOX["min_lat"],
               time_col: str | None = "time", out: str | None = None) -> DataFrame:
    """Aggregate fine pixels to grid cells by mean (per time step)."""
    out = out or value
    tk = [F.col(time_col)] if time_col else []
    snapped = df.select(*tk, tf.snap_index("lat", origin_lat, res).alias("lat_idx"),
                        tf.snap_index("lon", origin_lon, res).alias("lon_idx"),
                        tf.nan_to_null(value).alias("_v"))
    gk = ([time_col] if time_col else []) + ["lat_idx", "lon_idx"]
    return snapped.groupBy(*gk).agg(F.avg("_v").alias(out), F.count("_v").alias("n_pixels"))
