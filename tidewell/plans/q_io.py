"""Checked round trips through the file readers and sinks.

The test tables hold no raw JSON/CSV/GeoJSON, so each query first writes
data that Spark derives from the tables (payload pages, CSV, GeoJSON lines,
partitioned Parquet) into a fresh folder under the shared checkpoint
directory, then reads it back with the reader under test. The oracle is the
same rows computed directly from the tables.

Survey rows S1-S10, L1, L2, K1-K5 and product Q10.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import columns as C
from ..operators import grid as G
from ..operators import ranking as RK
from ..operators import spatial as SP
from ..operators import synthetic as S
from ..operators import temporal as T
from ..sources import readers as R
from ..sources import sinks as K
from .q_columns import STAGE_SQL
from .q_grid import q_bathymetry
from .q_spatial import PRESENCE_SQL
from .registry import RAW_ORACLES, register, report

BBOX = tf.DEFAULT_BBOX
PAGE = 10_000  # records per API response page (reference request size)


def _payload_pages(occ):
    """Occurrence rows as JSON payload lines ``{"results": [...]}``, one per
    (species, page of <= PAGE record ids) - bounded groups."""
    rec = F.struct(F.col("occ_id").cast("string").alias("occurrenceID"), F.col("species_name").alias("scientificName"),
                   F.col("lon").alias("decimalLongitude"), F.col("lat").alias("decimalLatitude"),
                   F.date_format("event_date", "yyyy-MM-dd").alias("eventDate"))
    pages = (occ.groupBy("species_name", F.floor(F.col("occ_id") / PAGE).alias("_page"))
                .agg(F.collect_list(rec).alias("results")))
    return pages.select(F.to_json(F.struct("results")).alias("value"))


def _write_payloads(spark, source: str) -> str:
    occ = spark.table("v_occurrences").filter(F.col("source") == source)
    path = K.scratch_path(spark, f"{source.lower()}-payloads")
    _payload_pages(occ).write.text(path)
    return path


@register("read_obis_json", ["v_occurrences"],
          "select occ_id, species_name, lon, lat from v_occurrences where source = 'OBIS' "
          "and lon is not null and lat is not null")
def q_read_obis(spark, sf):
    """OBIS payload pages -> occurrences with coordinates."""
    df = R.read_obis_json(spark, _write_payloads(spark, "OBIS"))
    return df.select(F.col("record_id").cast("bigint").alias("occ_id"), "species_name", "lon", "lat")


@register("read_gbif_json", ["v_occurrences"],
          "select occ_id, species_name, lon, lat from v_occurrences where source = 'GBIF' "
          "and lon is not null and lat is not null and lon between -130.0 and -110.0 and lat between 25.0 and 45.0")
def q_read_gbif(spark, sf):
    """GBIF payload pages clipped to the study bbox."""
    df = R.read_gbif_json(spark, _write_payloads(spark, "GBIF"), bbox=BBOX)
    return df.select(F.col("record_id").cast("bigint").alias("occ_id"), "species_name", "lon", "lat")


@register("explode_results", ["v_occurrences"],
          "select species_name, count(*) as n_results from v_occurrences group by 1")
def q_explode(spark, sf):
    """L1: every payload element becomes a row (missing coordinates kept here)."""
    paths = [_write_payloads(spark, "OBIS"), _write_payloads(spark, "GBIF")]
    raw = spark.read.schema(R.PAYLOAD_SCHEMA).json(paths)
    return R.explode_results(raw).groupBy(F.col("scientificName").alias("species_name")).agg(
        F.count(F.lit(1)).alias("n_results"))


@register("read_individuals_json", ["v_individuals"],
          "select id, name, species, sex, length_m, weight_kg from v_individuals")
def q_read_individuals(spark, sf):
    """S3: individuals as JSON arrays (pages of 1000) -> one row per individual."""
    ind = spark.table("v_individuals")
    rec = F.struct(F.col("id").cast("string").alias("id"), "name", "species", "sex",
                   F.col("length_m").alias("length"), F.col("weight_kg").alias("weight"))
    path = K.scratch_path(spark, "individuals")
    (ind.groupBy(F.floor(F.col("id") / 1000).alias("_page")).agg(F.to_json(F.collect_list(rec)).alias("value"))
        .select("value").write.text(path))
    df = R.read_individuals_json(spark, path)
    return report(df.select(F.col("id").cast("bigint").alias("id"), "name", "species", "sex", "length_m", "weight_kg"))


@register("read_tracks_json", ["v_tracks"], "select shark_id, ts, lon, lat from v_tracks")
def q_read_tracks_json(spark, sf):
    """Pings saved per individual; the id is recovered from the file path."""
    t = spark.table("v_tracks")
    pings = t.select("shark_id", F.date_format("ts", K.TS_FORMAT).alias("datetime"), F.col("lon").alias("longitude"),
                     F.col("lat").alias("latitude"))
    path = K.write_tracks_json(pings, K.scratch_path(spark, "pings"), "shark_id")
    df = R.read_tracks_json(spark, path, id_pattern=r"shark_id=(\d+)")
    return df.select(F.col("shark_id").cast("bigint").alias("shark_id"), "ts", "lon", "lat")


@register("read_tracks_csv", ["v_tracks", "v_individuals"],
          "select t.ts, round(t.lat, 9) + 0.0 as lat, round(t.lon, 9) + 0.0 as lon, i.name, "
          "coalesce(i.sex, '') as sex, round(i.length_m, 9) + 0.0 as length_m, "
          f"1 as Shark_Presence_Status, {STAGE_SQL} as life_stage from v_tracks t join v_individuals i "
          "on t.shark_id = i.id")
def q_read_tracks_csv(spark, sf):
    """S5 (+K4): tracks as CSV, read back with status and life stage."""
    t = spark.table("v_tracks").join(spark.table("v_individuals"), F.col("shark_id") == F.col("id"))
    path = K.write_csv(t.select(F.col("ts").alias("Date"), F.col("lat").alias("Latitude"),
                                F.col("lon").alias("Longitude"), F.col("name").alias("Name"),
                                F.col("sex").alias("Sex"), F.col("length_m").alias("Length")),
                       K.scratch_path(spark, "tracks-csv"))
    return report(R.read_tracks_csv(spark, path))


@register("read_effort", ["v_effort"],
          "select ts, round(lat, 9) + 0.0 as lat, round(lon, 9) + 0.0 as lon, gear, "
          "round(hours, 9) + 0.0 as hours from v_effort "
          "where gear in ('tuna_purse_seines', 'drifting_longlines')")
def q_read_effort(spark, sf):
    """S6 (+K4, P9): effort records through CSV, filtered to the default gears."""
    e = spark.table("v_effort")
    path = K.write_csv(e.select(F.col("ts").alias("date"), F.col("lat").alias("cell_ll_lat"),
                                F.col("lon").alias("cell_ll_lon"), F.col("gear").alias("geartype"),
                                F.col("hours").alias("fishing_hours")), K.scratch_path(spark, "effort-csv"))
    return report(C.filter_gear(R.read_effort(spark, path)))


def _write_lanes(spark) -> str:
    """Lanes as newline-delimited GeoJSON features built from the vertex view:
    every third lane a two-part MultiLineString, every tenth also gets an
    extra Point feature (ignored by the vertex explode)."""
    v = spark.table("v_lane_vertices")
    xy = F.array(F.col("lon"), F.col("lat"))
    lanes = v.groupBy("lane_id").agg(F.array_sort(F.collect_list(F.struct("vertex_no", xy.alias("xy")))).alias("vs"))
    pts = F.transform("vs", lambda s: s["xy"])
    multi = (F.col("lane_id") % 3) == 0
    geom = F.when(multi, F.to_json(F.struct(F.lit("MultiLineString").alias("type"), F.array(
        F.slice(pts, 1, 3), F.slice(pts, 4, 2)).alias("coordinates")))).otherwise(
        F.to_json(F.struct(F.lit("LineString").alias("type"), pts.alias("coordinates"))))
    props = F.to_json(F.create_map(F.lit("lane_id"), F.col("lane_id").cast("string")))
    feat = F.concat(F.lit('{"properties":'), props, F.lit(',"geometry":'), geom, F.lit("}"))
    point = F.concat(F.lit('{"properties":'), props, F.lit(',"geometry":'),
                     F.to_json(F.struct(F.lit("Point").alias("type"), F.element_at(pts, 1).alias("coordinates"))),
                     F.lit("}"))
    rows = lanes.select(feat.alias("value")).unionByName(
        lanes.filter((F.col("lane_id") % 10) == 1).select(point.alias("value")))
    path = K.scratch_path(spark, "lanes-geojson")
    rows.write.text(path)
    return path


def _lane_vertices(spark):
    feats = R.read_lanes_geojson(spark, _write_lanes(spark))
    feats = feats.withColumn("lane_id", F.col("properties")["lane_id"].cast("bigint"))
    return R.line_vertices(feats, ["lane_id"])


@register("read_lanes_geojson", ["v_lane_vertices"],
          "select lane_id, case when lane_id % 3 = 0 then 'MultiLineString' else 'LineString' end as geom_type "
          "from v_lane_vertices group by lane_id union all select lane_id, 'Point' from v_lane_vertices "
          "where lane_id % 10 = 1 group by lane_id")
def q_read_lanes(spark, sf):
    """GeoJSON features with their geometry type."""
    feats = R.read_lanes_geojson(spark, _write_lanes(spark))
    return feats.select(F.col("properties")["lane_id"].cast("bigint").alias("lane_id"), "geom_type")


@register("line_vertices", ["v_lane_vertices"],
          "select lane_id, case when lane_id % 3 = 0 and vertex_no >= 3 then 1 else 0 end as part, "
          "case when lane_id % 3 = 0 and vertex_no >= 3 then vertex_no - 3 else vertex_no end as k, lon, lat "
          "from v_lane_vertices")
def q_line_vertices(spark, sf):
    """L2: LineString / MultiLineString -> vertices; Point features ignored."""
    return _lane_vertices(spark)


@register("product_lane_distance", ["v_lane_vertices"], RAW_ORACLES["lane_distance"])
def q_product_lane(spark, sf):
    """Q10: S7 -> L2 -> J3 -> P20 (distance to the nearest lane vertex, cap 500 km)."""
    cells = G.target_grid(spark, BBOX, 0.1)
    out = SP.nearest_distance(cells, _lane_vertices(spark), 500.0, out="Dist_to_Shipping_Lane_km")
    return report(out.select("lat_idx", "lon_idx", "Dist_to_Shipping_Lane_km"))


@register("read_cube", ["v_cube"],
          "select cast(date_trunc('week', time) as date) + 6 as week, lat, lon, round(avg(value), 9) + 0.0 as value "
          "from v_cube group by 1, 2, 3")
def q_read_cube(spark, sf):
    """S8 (+K3): weekly cube written partitioned by week, read back as one table."""
    wk = T.aggregate_weekly(spark.table("v_cube"), "value", "mean", fill=False)
    path = K.write_cube(wk, K.scratch_path(spark, "cube"))
    return report(R.read_cube(spark, path).select("week", "lat", "lon", "value"))


@register("read_granules", ["v_ocean"],
          "select date as time, latitude as lat, longitude as lon, round(sst, 9) + 0.0 as sst, round(chlor_a, 9) + 0.0 as chlor_a, "
          "round(sla, 9) + 0.0 as sla from v_ocean")
def q_read_granules(spark, sf):
    """Four granules combined by coordinates: two of SST that overlap in time, one of chlorophyll under
    another name, one of sea level over the northern half and one over the southern."""
    cube, mid = spark.table("v_ocean"), F.lit("2024-02-10").cast("date")
    parts = [cube.filter(F.col("date") <= F.date_add(mid, 20)).select("date", "latitude", "longitude", "sst"),
             cube.filter(F.col("date") >= mid).select(F.col("date").alias("time"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "sst"),
             cube.select("date", "latitude", "longitude", F.col("chlor_a").alias("chlorophyll")),
             cube.filter("latitude > 30").select("date", "latitude", "longitude", "sla"),
             cube.filter("latitude <= 30").select("date", "latitude", "longitude", "sla")]
    paths = [K.scratch_path(spark, "granule") for _ in parts]
    for part, path in zip(parts, paths, strict=True):
        part.write.parquet(path)
    merged = R.read_granules(spark, paths, {"sst": R.SST_ALIASES, "chlor_a": R.CHL_ALIASES})
    return report(merged.select("time", "lat", "lon", "sst", "chlor_a", "sla"))


@register("read_raster", ["v_surface"],
          "select lat_idx, lon_idx, Slope_deg from (" + RAW_ORACLES["product_bathymetry"] + ") b")
def q_read_raster(spark, sf):
    """S9 (+K2): bathymetry depth and slope as a two-band raster table; band 2
    is read back (nodata -> NULL)."""
    bathy = q_bathymetry(spark, sf)
    grid = G.target_grid(spark, BBOX, 0.1)
    layer = bathy.join(grid, ["lat_idx", "lon_idx"])
    path = K.write_raster(layer, K.scratch_path(spark, "raster"), {1: "Depth_m", 2: "Slope_deg"})
    return report(R.read_raster(spark, path, band=2).select("lat_idx", "lon_idx", F.col("value").alias("Slope_deg")))


@register("read_points", ["v_tracks", "v_individuals"],
          f"with {PRESENCE_SQL} select event_id, life_stage, lon, lat from presence")
def q_read_points(spark, sf):
    """S10 (+K1): presence points written partitioned by life stage, read back."""
    p = S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))
    path = K.write_points(p.select("event_id", "lon", "lat", "life_stage"), K.scratch_path(spark, "points"),
                          partition_by="life_stage")
    return R.read_points(spark, path).select("event_id", "life_stage", "lon", "lat")


@register("write_cube", ["v_cube"],
          "with w as (select cast(date_trunc('week', time) as date) + 6 as week, lat, lon, avg(value) as value "
          "from v_cube group by 1, 2, 3), l as (select max(week) as last from w) "
          "select week, lat, lon, round(case when week = l.last then value + 1.0 else value end, 9) + 0.0 as value from w, l")
def q_write_cube(spark, sf):
    """K3: overwriting with one week's rows replaces that week and no other."""
    wk = T.aggregate_weekly(spark.table("v_cube"), "value", "mean", fill=False)
    path = K.write_cube(wk, K.scratch_path(spark, "cube"))
    cube = R.read_cube(spark, path)
    last = cube.agg(F.max("week")).first()[0]
    changed = wk.filter(F.col("week") == F.lit(last)).withColumn("value", F.col("value") + 1.0)
    K.write_cube(changed, path)
    return report(R.read_cube(spark, path).select("week", "lat", "lon", "value"))


@register("write_points", ["v_tracks", "v_individuals"],
          f"with {PRESENCE_SQL} select event_id, lon, lat from presence where life_stage = 'Juvenile'")
def q_write_points(spark, sf):
    """K1: one partition of a point layer, read by its own folder."""
    p = S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))
    path = K.write_points(p.select("event_id", "lon", "lat", "life_stage"), K.scratch_path(spark, "points"),
                          partition_by="life_stage")
    return R.read_points(spark, f"{path}/life_stage=Juvenile").select("event_id", "lon", "lat")


@register("write_raster", ["v_surface"],
          "select cast(lat_idx as int) as lat_idx, cast(lon_idx as int) as lon_idx, "
          "round(coalesce(sst, -9999.0), 9) + 0.0 as stored from v_surface")
def q_write_raster(spark, sf):
    """K2: a raster band as stored, missing values as the nodata value."""
    path = K.write_raster(spark.table("v_surface"), K.scratch_path(spark, "raster"), "sst")
    return report(R.read_raster(spark, path, nodata=None).select(
        F.col("lat_idx").cast("int").alias("lat_idx"), F.col("lon_idx").cast("int").alias("lon_idx"),
        F.col("value").alias("stored")))


@register("write_csv", ["v_tracks"],
          "select event_id, shark_id, ts, round(lon, 9) + 0.0 as lon, round(lat, 9) + 0.0 as lat from v_tracks")
def q_write_csv(spark, sf):
    """K4: a table as CSV with a header, read back with its schema."""
    t = spark.table("v_tracks").select("event_id", "shark_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "lon", "lat")
    path = K.write_csv(t, K.scratch_path(spark, "csv"))
    return report(spark.read.option("header", True).option("timestampNTZFormat", K.TS_FORMAT).schema(t.schema).csv(path))


@register("first_n", ["v_tracks"],
          "select event_id, shark_id from (select event_id, shark_id, row_number() over (partition by shark_id "
          "order by event_id) as rn from v_tracks) q where rn <= 5")
def q_first_n(spark, sf):
    """The first five pings of every individual, in order."""
    t = spark.table("v_tracks").select("event_id", "shark_id").withColumn("n", F.lit(5))
    return RK.first_n(t, "event_id", "n", ["shark_id"]).select("event_id", "shark_id")


META_SQL = " union all ".join(
    f"select '{name}' as layer, '{unit}' as unit, 'EPSG:4326' as crs, cast(0.1 as double) as resolution_deg, "
    f"cast(-130.0 as double) as min_lon, cast(-110.0 as double) as max_lon, cast(25.0 as double) as min_lat, "
    f"cast(45.0 as double) as max_lat, cast(-9999.0 as double) as nodata, count(*) as n_rows, "
    f"cast(count_if({col} is null) as bigint) as n_null, min({col}) as min_value, max({col}) as max_value, "
    f"'{src}' as source "
    f"from ({sql}) q"
    for name, unit, col, src, sql in (
        ("Dist_to_Shipping_Lane_km", "km", "Dist_to_Shipping_Lane_km", "shipping lanes", RAW_ORACLES["lane_distance"]),
        ("Depth_m", "m", "Depth_m", "bathymetry", RAW_ORACLES["product_bathymetry"]),
        ("Slope_deg", "degree", "Slope_deg", "bathymetry", RAW_ORACLES["product_bathymetry"])))


@register("layer_metadata", ["v_lane_vertices", "v_surface"], META_SQL)
def q_metadata(spark, sf):
    """K5: one descriptor row per layer (rows, missing, range, unit, source)."""
    from .registry import QUERIES
    lane = QUERIES["lane_distance"](spark, sf)
    bathy = QUERIES["product_bathymetry"](spark, sf)
    return report(K.layer_metadata({
        "Dist_to_Shipping_Lane_km": (lane, "Dist_to_Shipping_Lane_km", "km", "shipping lanes"),
        "Depth_m": (bathy, "Depth_m", "m", "bathymetry"),
        "Slope_deg": (bathy, "Slope_deg", "degree", "bathymetry"),
    }), keep=("resolution_deg", "min_lon", "max_lon", "min_lat", "max_lat", "nodata"))
