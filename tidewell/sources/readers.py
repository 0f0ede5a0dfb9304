"""File readers for the reference's inputs.

The reference fetched these over HTTP; here they are files already landed
(JSON payloads, CSV, GeoJSON, Parquet). Every reader uses an explicit
schema (no inference pass over the data), and line-delimited layouts are
preferred because they split across tasks; ``multi_line=True`` reads whole
documents (one task per file) when that is how the files were saved.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as tf
from ..operators.columns import CHL_ALIASES, SST_ALIASES, clip_points_bbox, drop_missing_coords, normalize_columns

OCCURRENCE_FIELDS = T.StructType([
    T.StructField("occurrenceID", T.StringType()),
    T.StructField("key", T.LongType()),
    T.StructField("scientificName", T.StringType()),
    T.StructField("decimalLongitude", T.DoubleType()),
    T.StructField("decimalLatitude", T.DoubleType()),
    T.StructField("eventDate", T.StringType()),
])
PAYLOAD_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(OCCURRENCE_FIELDS))])

INDIVIDUAL_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("shark_id", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("species", T.StringType()),
    T.StructField("sex", T.StringType()), T.StructField("length", T.DoubleType()),
    T.StructField("weight", T.DoubleType()),
])
PING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("datetime", T.StringType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
])
TRACK_CSV_SCHEMA = T.StructType([
    T.StructField("Date", T.TimestampNTZType()), T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()), T.StructField("Name", T.StringType()),
    T.StructField("Sex", T.StringType()), T.StructField("Length", T.DoubleType()),
])
EFFORT_CSV_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType()), T.StructField("cell_ll_lat", T.DoubleType()),
    T.StructField("cell_ll_lon", T.DoubleType()), T.StructField("geartype", T.StringType()),
    T.StructField("fishing_hours", T.DoubleType()),
])
# Fixed value: timestamp text layout used by our CSV sinks and readers.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

LANE_FEATURE_SCHEMA = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()),
                                            T.StructField("coordinates", T.StringType())])),
])
LANE_COLLECTION_SCHEMA = T.StructType([T.StructField("features", T.ArrayType(LANE_FEATURE_SCHEMA))])


def explode_results(payloads: DataFrame) -> DataFrame:
    """L1: one row per element of each payload's ``results`` (empty -> none)."""
    return payloads.select(F.explode("results").alias("r")).select("r.*")


def _occurrences(spark: SparkSession, path, source: str, species: str | None, multi_line: bool) -> DataFrame:
    raw = spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", multi_line).json(path)
    rows = explode_results(raw)
    name = F.lit(species) if species else F.col("scientificName")
    return rows.select(F.coalesce(F.col("occurrenceID"), F.col("key").cast("string")).alias("record_id"),
                       name.alias("species_name"), F.lit(source).alias("source"),
                       F.col("eventDate").alias("event_date"),
                       F.col("decimalLongitude").alias("lon"), F.col("decimalLatitude").alias("lat"))


def read_obis_json(spark: SparkSession, path, species: str | None = None, multi_line: bool = False) -> DataFrame:
    """OBIS payloads -> occurrence rows with coordinates, tagged OBIS."""
    return drop_missing_coords(_occurrences(spark, path, "OBIS", species, multi_line))


def read_gbif_json(spark: SparkSession, path, species: str | None = None, bbox: dict | None = None,
                   limit: int | None = None, multi_line: bool = False) -> DataFrame:
    """GBIF payloads; optional bbox (inclusive) and record limit."""
    df = drop_missing_coords(_occurrences(spark, path, "GBIF", species, multi_line))
    if bbox:
        df = clip_points_bbox(df, bbox)
    if limit is not None:
        df = df.orderBy("record_id").limit(limit)
    return df


def read_individuals_json(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """S3: individuals list (JSON arrays of objects); key = coalesce(id, shark_id)."""
    df = spark.read.schema(INDIVIDUAL_SCHEMA).option("multiLine", multi_line).json(path)
    return df.select(F.coalesce("id", "shark_id").alias("id"), F.coalesce("name", F.lit("")).alias("name"),
                     "species", F.coalesce("sex", F.lit("")).alias("sex"),
                     F.col("length").alias("length_m"), F.col("weight").alias("weight_kg"))


def read_tracks_json(spark: SparkSession, path, id_pattern: str | None = None, multi_line: bool = False) -> DataFrame:
    """Ping records with longitude/latitude; the individual's id comes from
    the record or, with ``id_pattern`` (one regex group), from the file path."""
    df = (spark.read.schema(PING_SCHEMA).option("multiLine", multi_line)
          .option("recursiveFileLookup", True).json(path))
    sid = F.col("id")
    if id_pattern:
        sid = F.coalesce(sid, F.regexp_extract(F.input_file_name(), id_pattern, 1))
    return df.select(sid.alias("shark_id"), F.to_timestamp_ntz("datetime").alias("ts"),
                     F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))


def read_tracks_csv(spark: SparkSession, path) -> DataFrame:
    """CSV tracks (Date, Latitude, Longitude, Name, Sex, Length), status 1,
    life stage classified on this path too."""
    df = (spark.read.schema(TRACK_CSV_SCHEMA).option("header", True)
          .option("timestampNTZFormat", TS_FORMAT).csv(path))
    return df.select(F.col("Date").alias("ts"), F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"),
                     F.col("Name").alias("name"), F.coalesce("Sex", F.lit("")).alias("sex"),
                     F.col("Length").alias("length_m"), F.lit(1).alias("Shark_Presence_Status"),
                     tf.life_stage("Length", "Sex").alias("life_stage"))


def read_effort(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    """Fishing effort records -> (ts, lat, lon, gear, hours)."""
    reader = spark.read.schema(EFFORT_CSV_SCHEMA).option("timestampNTZFormat", TS_FORMAT)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)
    return df.select(F.col("date").alias("ts"), F.col("cell_ll_lat").alias("lat"), F.col("cell_ll_lon").alias("lon"),
                     F.col("geartype").alias("gear"), tf.nan_to_null("fishing_hours").alias("hours"))


def read_lanes_geojson(spark: SparkSession, path, one_feature_per_line: bool = True) -> DataFrame:
    """GeoJSON features -> (feature_no, properties, geom_type, coordinates json).

    ``one_feature_per_line`` reads newline-delimited features (splittable);
    otherwise whole FeatureCollection documents (no features -> no rows).
    """
    if one_feature_per_line:
        feats = spark.read.schema(LANE_FEATURE_SCHEMA).json(path)
    else:
        coll = spark.read.schema(LANE_COLLECTION_SCHEMA).option("multiLine", True).json(path)
        feats = coll.select(F.explode("features").alias("f")).select("f.*")
    return feats.select(F.col("properties"), F.col("geometry.type").alias("geom_type"),
                        F.col("geometry.coordinates").alias("coordinates"))


def line_vertices(lanes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """L2: LineString / MultiLineString features -> one row per vertex
    ``(keys.., part, k, lon, lat)``; other geometry types are ignored."""
    keys = list(keys)
    line = F.from_json("coordinates", "array<array<double>>")
    multi = F.from_json("coordinates", "array<array<array<double>>>")
    parts = (F.when(F.col("geom_type") == "LineString", F.array(line))
              .when(F.col("geom_type") == "MultiLineString", multi))
    p = lanes.select(*keys, F.posexplode(parts).alias("part", "_line"))
    v = p.select(*keys, "part", F.posexplode("_line").alias("k", "_xy"))
    return v.select(*keys, "part", "k", F.col("_xy")[0].alias("lon"), F.col("_xy")[1].alias("lat"))


def read_cube(spark: SparkSession, paths, fmt: str = "parquet", variable_aliases: dict | None = None,
              schema: str | T.StructType | None = None) -> DataFrame:
    """Many granules of long rows as one table (schemas merged), canonical
    names, NaN -> NULL on every floating column. CSV granules need their
    ``schema``: nothing is inferred."""
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(*([paths] if isinstance(paths, str) else paths))
    else:
        if schema is None:
            raise ValueError("a CSV cube is read with an explicit schema")
        df = spark.read.option("header", True).schema(schema).csv(paths)
    times = () if "week" in df.columns else ("time",)
    df = normalize_columns(df, variable_aliases, required=("lon", "lat", *times))
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.select(*[tf.nan_to_null(c).alias(c) if c in floats else F.col(c) for c in df.columns])


def granule_catalogue(granules: DataFrame, variables: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """A row per granule: its rows, its extent along every key, and how many values of each variable it has."""
    extent = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("min", F.min), ("max", F.max))]
    return granules.groupBy("granule").agg(F.count(F.lit(1)).alias("n_rows"), *extent, *[F.count(v).alias(f"n_{v}") for v in variables])


def overlapping(catalogue: Sequence[T.Row], keys: Sequence[str]) -> bool:
    """Whether the extents of any two granules meet (a sweep along the first key)."""
    rows = sorted((r for r in catalogue if r[f"min_{keys[0]}"] is not None), key=lambda r: r[f"min_{keys[0]}"])
    open_: list[T.Row] = []
    for r in rows:
        open_ = [o for o in open_ if o[f"max_{keys[0]}"] >= r[f"min_{keys[0]}"]]
        if any(all(o[f"min_{k}"] <= r[f"max_{k}"] and r[f"min_{k}"] <= o[f"max_{k}"] for k in keys[1:]) for o in open_):
            return True
        open_.append(r)
    return False


def read_granules(spark: SparkSession, paths: Sequence[str], variable_aliases: dict | None = None,
                  keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """Granules of any variables and extents combined by their coordinates, one row for each.

    Each granule is read with its own schema and canonical names. Granules whose extents don't meet are one table as
    they are. Where some meet, rows of equal coordinates are merged: variables of different granules stand side by side,
    equal values count once, a missing value yields to a present one, and different values of a variable are an error.
    The catalogue that decides this has one row per granule and needs one pass.
    """
    frames = []
    for i, path in enumerate(paths):
        df = normalize_columns(spark.read.parquet(path), {c: a for c, a in (variable_aliases or {}).items()
                                                          if set(a) & set(spark.read.parquet(path).columns)}, required=tuple(keys))
        floats = [c for c, t in df.dtypes if t in ("double", "float")]
        frames.append(df.select(*[tf.nan_to_null(c).alias(c) if c in floats else F.col(c) for c in df.columns])
                        .withColumn("granule", F.lit(i)))
    if not frames:
        raise ValueError("no granules to read")
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    variables = [c for c in both.columns if c not in (*keys, "granule")]
    if not overlapping(granule_catalogue(both, variables, keys).collect(), keys):
        return both.select(*keys, *variables)

    def merged(v: str):
        clash = F.concat(F.lit(f"granules differ in {v} at "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
        return F.when(F.col(f"_lo_{v}").eqNullSafe(F.col(f"_hi_{v}")), F.col(f"_lo_{v}")).otherwise(F.raise_error(clash)).alias(v)

    spans = [f(v).alias(f"_{n}_{v}") for v in variables for n, f in (("lo", F.min), ("hi", F.max))]
    return both.groupBy(*keys).agg(*spans).select(*keys, *[merged(v) for v in variables])


def duplicate_coordinates(cube: DataFrame, keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """Rows of ``keys`` that occur more than once (combine-by-coords check)."""
    return cube.groupBy(*keys).count().filter(F.col("count") > 1)


def read_raster(spark: SparkSession, path, band: int = 1, nodata: float | None = -9999.0) -> DataFrame:
    """One band of a raster table; the nodata value becomes NULL."""
    df = spark.read.parquet(path).filter(F.col("band") == band)
    v = F.col("value")
    if nodata is not None:
        v = F.when(v == F.lit(nodata), F.lit(None).cast("double")).otherwise(v)
    return df.select("lat_idx", "lon_idx", "lat", "lon", tf.nan_to_null(v).alias("value"))


def read_points(spark: SparkSession, path) -> DataFrame:
    """A saved point layer."""
    return spark.read.parquet(path)


__all__ = ["read_obis_json", "read_gbif_json", "read_individuals_json", "read_tracks_json", "read_tracks_csv",
           "read_effort", "read_lanes_geojson", "line_vertices", "read_cube", "read_granules", "read_raster", "read_points",
           "explode_results", "duplicate_coordinates", "SST_ALIASES", "CHL_ALIASES"]
