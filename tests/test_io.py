"""Readers and sinks on small hand-written files."""

import json
import os

from pyspark.sql import functions as F

from tidewell.sources import readers as R
from tidewell.sources import sinks as K


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_obis_payload_drops_missing_coords(spark, tmp_dir):
    p = os.path.join(tmp_dir, "obis", "page0.json")
    _write(p, json.dumps({"results": [
        {"occurrenceID": "a", "scientificName": "Phoca vitulina", "decimalLongitude": -120.5, "decimalLatitude": 35.0},
        {"occurrenceID": "b", "scientificName": "Phoca vitulina", "decimalLatitude": 35.0},
        {"occurrenceID": "c", "scientificName": "Phoca vitulina", "decimalLongitude": -121.0,
         "decimalLatitude": 36.0, "eventDate": "2021-06-01"}]}) + "\n" + json.dumps({"results": []}) + "\n")
    rows = R.read_obis_json(spark, os.path.dirname(p)).orderBy("record_id").collect()
    assert [r["record_id"] for r in rows] == ["a", "c"]
    assert rows[0]["source"] == "OBIS"


def test_feature_collection_document_and_empty(spark, tmp_dir):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "lane A"},
         "geometry": {"type": "LineString", "coordinates": [[-120.0, 34.0], [-119.5, 34.5]]}},
        {"type": "Feature", "properties": {"name": "lane B"},
         "geometry": {"type": "MultiLineString", "coordinates": [[[-118.0, 33.0], [-117.0, 33.0]], [[-116.0, 32.0],
                                                                                                     [-115.0, 32.0]]]}},
        {"type": "Feature", "properties": {"name": "buoy"}, "geometry": {"type": "Point", "coordinates": [-1.0, 1.0]}}]}
    _write(os.path.join(tmp_dir, "lanes", "a.geojson"), json.dumps(fc, indent=2))
    feats = R.read_lanes_geojson(spark, os.path.join(tmp_dir, "lanes"), one_feature_per_line=False)
    v = R.line_vertices(feats.withColumn("name", F.col("properties")["name"]), ["name"]).collect()
    assert len(v) == 6
    assert {r["name"] for r in v} == {"lane A", "lane B"}
    _write(os.path.join(tmp_dir, "empty", "e.geojson"), json.dumps({"type": "FeatureCollection", "features": []}))
    assert R.read_lanes_geojson(spark, os.path.join(tmp_dir, "empty"), one_feature_per_line=False).count() == 0


def test_tracks_csv_classifies_every_row(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "t", "tracks.csv"),
           "Date,Latitude,Longitude,Name,Sex,Length\n"
           "2022-01-01T00:00:00.000000,35.0,-120.0,Ann,Female,4.1\n"
           "2022-01-02T00:00:00.000000,35.1,-120.1,Bob,M,3.5\n"
           "2022-01-03T00:00:00.000000,35.2,-120.2,Cy,,\n"
           "2022-01-04T00:00:00.000000,35.3,-120.3,Di,f,2.0\n")
    got = {r["name"]: r["life_stage"] for r in R.read_tracks_csv(spark, os.path.join(tmp_dir, "t")).collect()}
    assert got == {"Ann": "Adult_Female", "Bob": "Adult_Male", "Cy": "Unknown", "Di": "Juvenile"}


def test_raster_roundtrip_nodata(spark, tmp_dir):
    df = spark.createDataFrame([(0, 0, 25.0, -130.0, 1.5), (0, 1, 25.0, -129.9, None)],
                               "lat_idx int, lon_idx int, lat double, lon double, depth double")
    path = K.write_raster(df, os.path.join(tmp_dir, "r"), "depth")
    got = {r["lon_idx"]: r["value"] for r in R.read_raster(spark, path).collect()}
    assert got == {0: 1.5, 1: None}


def test_cube_reader_merges_schemas_and_nulls_nan(spark, tmp_dir):
    a = spark.createDataFrame([("2020-01-01", 30.0, -120.0, float("nan"))], "time string, lat double, lon double, sst double")
    b = spark.createDataFrame([("2020-01-02", 30.0, -120.0, 1.0, 2.0)],
                              "time string, latitude double, lon double, sst double, chlor_a double")
    a.write.parquet(os.path.join(tmp_dir, "cube", "g1"))
    b.withColumnRenamed("latitude", "lat").write.parquet(os.path.join(tmp_dir, "cube", "g2"))
    cube = R.read_cube(spark, [os.path.join(tmp_dir, "cube", "g1"), os.path.join(tmp_dir, "cube", "g2")])
    rows = {r["time"]: (r["sst"], r["chlor_a"]) for r in cube.collect()}
    assert rows == {"2020-01-01": (None, None), "2020-01-02": (1.0, 2.0)}
    assert R.duplicate_coordinates(cube).count() == 0


def test_pings_make_one_file_for_each_individual(spark, tmp_dir):
    rows = [(i % 7 if i % 8 else None, f"2024-01-01T00:00:{i % 60:02d}.000000", i / 10, None if i % 5 == 0 else i / 20) for i in range(400)]
    df = spark.createDataFrame(rows, "shark_id long, datetime string, longitude double, latitude double").repartition(16)
    path = K.write_tracks_json(df, os.path.join(tmp_dir, "pings"), "shark_id")
    files = [f for _, _, names in os.walk(path) for f in names]
    assert sorted(files) == sorted([*(f"shark_id={i}.json" for i in range(7)), "shark_id=__HIVE_DEFAULT_PARTITION__.json"])
    back = R.read_tracks_json(spark, path, id_pattern=r"shark_id=(\d+)").collect()
    assert sorted((r.shark_id, r.ts.second, r.lon, r.lat or -1) for r in back) == sorted(
        (str(s) if s is not None else "", int(t[17:19]), x, y or -1) for s, t, x, y in rows)


def test_no_pings_make_no_file(spark, tmp_dir):
    df = spark.createDataFrame([], "shark_id long, datetime string, longitude double, latitude double")
    path = K.write_tracks_json(df, os.path.join(tmp_dir, "none"), "shark_id")
    assert R.read_tracks_json(spark, path, id_pattern=r"shark_id=(\d+)").count() == 0
