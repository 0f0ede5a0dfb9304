"""Physical plan shape: range joins stay equi-joins, filters reach the scan."""

from pyspark.sql import functions as F

from tidewell import functions as tf
from tidewell.operators import columns as C
from tidewell.operators import density as D
from tidewell.operators import grid as G
from tidewell.operators import spatial as SP
from tidewell.sources.fixtures import register_views

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tile_joins_have_no_nested_loops(spark, sf_dir):
    register_views(spark, sf_dir, ["v_tracks", "v_occurrences"])
    tracks = spark.table("v_tracks")
    cand = tracks.select(F.col("event_id").alias("id"), (F.col("lon") + 0.01).alias("lon"), "lat")
    cells = G.target_grid(spark, tf.DEFAULT_BBOX, 0.5)
    plans = [
        _plan(SP.exclude_buffer(cand, tracks, 20.0)),
        _plan(SP.exclusion_mask(cells, tracks, 20.0)),
        _plan(SP.neighbour_counts(spark.table("v_occurrences").filter("lon is not null and lat is not null"), 10.0)),
        _plan(D.kde_density(cells, spark.table("v_occurrences"))),
    ]
    for p in plans:
        assert not any(b in p for b in BAD), p


def test_bbox_filter_is_pushed_to_parquet(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_discount")
    out = C.clip_points_bbox(df.withColumnRenamed("l_quantity", "lon").withColumnRenamed("l_discount", "lat"),
                             {"min_lon": 1.0, "max_lon": 10.0, "min_lat": 0.0, "max_lat": 0.05})
    plan = _plan(out)
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_discount), GreaterThanOrEqual(l_quantity" in plan
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in plan


def test_gradient_windows_are_partitioned(spark):
    from tidewell.operators import terrain as TR

    grid = G.target_grid(spark, tf.DEFAULT_BBOX, 0.5)
    g = TR.gradient_magnitude(grid.withColumn("v", F.col("lat")), "v", 0.5, 41, 41)
    plan = _plan(g)
    assert "SinglePartition" not in plan


def test_no_registered_query_plans_a_cartesian_or_nested_loop_join(spark, sf_dir):
    from tidewell.plans import catalog

    bad = []
    for key, fn in catalog.QUERIES.items():
        plan = _plan(fn(spark, sf_dir))
        hits = [b for b in BAD if b in plan]
        if hits:
            bad.append((key, hits))
    assert bad == []
