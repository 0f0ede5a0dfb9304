"""Projections, filters and scalar features (survey rows P1-P21).

All operators are ``DataFrame -> DataFrame`` and stay declarative, so the
filters reach the Parquet scan (PushedFilters) and unused columns are pruned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as tf

# Column alias lists (first match wins).
LON_ALIASES = ("lon", "longitude", "Longitude", "decimalLongitude")
LAT_ALIASES = ("lat", "latitude", "Latitude", "decimalLatitude")
TIME_ALIASES = ("time", "Time", "date", "Date", "datetime")
SST_ALIASES = ("sst", "sea_surface_temperature")
CHL_ALIASES = ("chlor_a", "chlorophyll")


def find_column(df: DataFrame, candidates: Sequence[str], required: bool = True) -> str | None:
    """First candidate present in the schema (driver-side schema lookup only)."""
    for c in candidates:
        if c in df.columns:
            return c
    if required:
        raise ValueError(f"none of {list(candidates)} found in {df.columns}")
    return None


def normalize_columns(df: DataFrame, variable_aliases: dict[str, Sequence[str]] | None = None,
                      required: Sequence[str] = ("lon", "lat", "time")) -> DataFrame:
    """Rename coordinate/time/variable aliases to canonical names.

    A ``required`` coordinate or a variable without any known name is an error.

    lon/lat from longitude/latitude, ``time`` from the first of
    time, Time, date, Date, datetime, ``species_name`` from Species; optional
    variable aliases, e.g. ``{"sst": SST_ALIASES}``.
    """
    renames = {}
    for canon, cands in (("lon", LON_ALIASES), ("lat", LAT_ALIASES)):
        if canon not in df.columns:
            hit = find_column(df, cands, required=canon in required)
            if hit:
                renames[hit] = canon
    if "time" not in df.columns:
        hit = find_column(df, TIME_ALIASES, required="time" in required)
        if hit:
            renames[hit] = "time"
    if "species_name" not in df.columns and "Species" in df.columns:
        renames["Species"] = "species_name"
    for canon, cands in (variable_aliases or {}).items():
        if canon not in df.columns:
            renames[find_column(df, cands)] = canon
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    return df


def drop_missing_coords(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Drop rows lacking lat or lon (NaN counts as missing)."""
    return df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()
                     & ~F.isnan(F.col(lon)) & ~F.isnan(F.col(lat)))


def clip_points_bbox(df: DataFrame, bbox: dict, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Inclusive bbox clip; order-free BETWEEN (pushed to the scan)."""
    return df.filter(F.col(lon).between(bbox["min_lon"], bbox["max_lon"])
                     & F.col(lat).between(bbox["min_lat"], bbox["max_lat"]))


clip_grid_bbox = clip_points_bbox


def filter_dates_table(df: DataFrame, start: str, end: str, column: str = "ts") -> DataFrame:
    """``start <= t <= end`` with ``end`` at midnight (later that day excluded)."""
    c = F.col(column)
    return df.filter((c >= F.to_timestamp(F.lit(start))) & (c <= F.to_timestamp(F.lit(end))))


def filter_dates_cube(df: DataFrame, start: str, end: str, column: str = "time") -> DataFrame:
    """P5: label slice on a cube; the whole end day is included."""
    c = F.col(column)
    return df.filter((c >= F.to_timestamp(F.lit(start)))
                     & (c < F.to_timestamp(F.date_add(F.to_date(F.lit(end)), 1))))


def filter_species(df: DataFrame, species: str, column: str = "species") -> DataFrame:
    """P6."""
    return df.filter(F.col(column) == species)


def filter_life_stage(df: DataFrame, stage: str | None, column: str = "life_stage") -> DataFrame:
    """Keep one stage, or everything when ``stage`` is None."""
    return df if not stage else df.filter(F.col(column) == stage)


def split_by_life_stage(df: DataFrame, column: str = "life_stage") -> DataFrame:
    """The three modelled stages as one frame (Adult, Unknown fall out).

    The stage column is the partition key for writes (``partitionBy``).
    """
    return df.filter(F.col(column).isin(*tf.STAGES))


def filter_gear(df: DataFrame, gears: Sequence[str] = tf.DEFAULT_GEARS, column: str = "gear") -> DataFrame:
    """P9."""
    return df.filter(F.col(column).isin(*gears))


def add_is_summer(df: DataFrame, column: str = "time", months=tf.SUMMER_MONTHS,
                  out: str = "is_summer") -> DataFrame:
    """P10."""
    return df.withColumn(out, tf.is_summer(column, months))


def make_points(df: DataFrame, lon: str = "lon", lat: str = "lat", wkt: bool = False) -> DataFrame:
    """Point column as struct<lon,lat>, optional WKT text."""
    df = df.withColumn("geom", F.struct(F.col(lon).alias("lon"), F.col(lat).alias("lat")))
    if wkt:
        df = df.withColumn("geom_wkt", tf.point_wkt(lon, lat))
    return df


def tag_constants(df: DataFrame, **tags) -> DataFrame:
    """Add literal tag columns (species, source, presence, point type, stage)."""
    for name, value in tags.items():
        df = df.withColumn(name, F.lit(value))
    return df


def add_temporal_features(df: DataFrame, date_column: str = "Date") -> DataFrame:
    """Parse strings, Month and ISO Week_of_Year."""
    dtype = dict(df.dtypes)[date_column]
    c = F.col(date_column)
    if dtype == "string":
        df = df.withColumn(date_column, F.to_timestamp(c))
    return (df.withColumn("Month", F.month(F.col(date_column)).cast("int"))
              .withColumn("Week_of_Year", tf.iso_week(date_column)))


def add_season(df: DataFrame, date_column: str = "Date") -> DataFrame:
    """Season from Month (Month added first when absent)."""
    if "Month" not in df.columns:
        df = add_temporal_features(df, date_column)
    return df.withColumn("Season", tf.season("Month"))


def classify_life_stage(df: DataFrame, length: str = "length", sex: str = "sex",
                        out: str = "life_stage") -> DataFrame:
    """P17."""
    return df.withColumn(out, tf.life_stage(length, sex))


def add_depth(df: DataFrame, elevation: str = "elevation", out: str = "depth_m") -> DataFrame:
    """P18."""
    return df.withColumn(out, tf.elevation_to_depth(elevation))


def clamp_criteria(df: DataFrame, criteria: dict) -> DataFrame:
    """Boolean tests where a missing input means ``false``."""
    for name, cond in criteria.items():
        df = df.withColumn(name, F.coalesce(cond, F.lit(False)))
    return df
