"""The streaming weekly mean equals the batch weekly mean on the same pings."""

import os

from pyspark.sql import functions as F

from tidewell.operators import temporal as T
from tidewell.sources.fixtures import register_views
from tidewell.streaming.weekly import snap_pings, weekly_mean_stream


def test_stream_weekly_mean_matches_batch(spark, sf_dir, tmp_dir):
    register_views(spark, sf_dir, ["v_tracks"])
    pings = snap_pings(spark.table("v_tracks")).select("ts", "lat_idx", "lon_idx", F.col("event_id").cast("double").alias("v"))
    src = os.path.join(tmp_dir, "pings")
    pings.write.parquet(src)
    stream = spark.readStream.schema(pings.schema).parquet(src)
    q = (weekly_mean_stream(stream, "v", late="3650 days").writeStream.outputMode("complete")
         .format("memory").queryName("weekly_stream").start())
    q.processAllAvailable()
    q.stop()
    got = {(r["week"], r["lat_idx"], r["lon_idx"]): r["v"] for r in spark.table("weekly_stream").collect()}
    batch = T.aggregate_weekly(pings, "v", "mean", "ts", ["lat_idx", "lon_idx"], fill=False).collect()
    want = {(r["week"], r["lat_idx"], r["lon_idx"]): r["v"] for r in batch}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
