"""Stored layers, nested tiles, granules: values and growth."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewell.operators import grid as G
from tidewell.operators import spatial as SP
from tidewell.operators import store
from tidewell.operators import temporal as T
from tidewell.plans import q_grid, q_training
from tidewell.plans.registry import report
from tidewell.sources import readers as R
from tidewell.sources import sinks as K
from tidewell.sources.fixtures import register_views

DENSE = "/root/testdata/sf0.01"
BOX = {"min_lon": 0.0, "max_lon": 6.0, "min_lat": 0.0, "max_lat": 6.0}


def slow_nearest(cells, points, cap):
    return {(r.lat_idx, r.lon_idx): min([cap, *(111.0 * math.hypot(r.lon - x, r.lat - y) for x, y in points)]) for r in cells}


@pytest.mark.parametrize("kind", ["spread", "corner", "one", "line", "copies"])
@pytest.mark.parametrize("cap", [None, 150.0])
def test_nearest_distance_against_all_points(spark, monkeypatch, kind, cap):
    monkeypatch.setattr(SP, "TILE_POINTS", 40 if kind == "corner" else 4096)
    rng = random.Random(kind)
    points = {"spread": [(rng.uniform(-1, 7), rng.uniform(-1, 7)) for _ in range(200)],
              "corner": [(rng.uniform(0, 0.3), rng.uniform(0, 0.3)) for _ in range(600)], "one": [(3.25, 9.5)],
              "line": [(i / 50, 2.0) for i in range(300)], "copies": [(1.5, 1.5)] * 500 + [(5.0, 5.0)]}[kind]
    grid = G.target_grid(spark, BOX, 0.5)
    out = SP.nearest_distance(grid, spark.createDataFrame([*points, (None, 1.0)], "lon double, lat double"), cap).collect()
    want = slow_nearest(grid.collect(), points, cap or math.inf)
    assert len(out) == len(want)
    assert all(abs(r.distance_km - want[r.lat_idx, r.lon_idx]) < 1e-9 for r in out)


def test_far_cells_read_few_points_of_a_dense_corner(spark):
    rng = random.Random(1)
    pts = spark.createDataFrame([(rng.uniform(0, 0.1), rng.uniform(0, 0.1)) for _ in range(30_000)], "_px double, _py double")
    cells = G.target_grid(spark, {"min_lon": 3.0, "max_lon": 4.0, "min_lat": 3.0, "max_lat": 4.0}, 0.05).select(
        "lat_idx", "lon_idx", F.col("lon").alias("_cx"), F.col("lat").alias("_cy"))
    steps = F.array(*[F.lit(i).cast("long") for i in range(5)])
    pairs = cells.withColumn("_ub", F.lit(1e9)).withColumn("_tx", F.explode(steps)).withColumn("_ty", F.explode(steps))
    leaves = SP.nearest_tiles(pairs, pts, 0.0, 0.0, 2.0 ** -5, ["lat_idx", "lon_idx"])
    compared = sum(p.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0] for p, _ in leaves)
    assert compared < 200 * cells.count()  # of 30,000 points each


def test_ocean_layers_have_values_everywhere(spark):
    register_views(spark, DENSE, ["v_ocean"])
    lines = {name: q_grid._line_report(spark, DENSE, name) for name in q_grid.OCEAN}
    answers = set()
    for name, df in lines.items():
        value = q_grid.OCEAN[name][0][0]
        r = df.agg(F.sum(f"n_{value}").alias("n"), F.count("*").alias("lines"), F.avg(f"{value}_mean").alias("m")).first()
        assert r.n > 0.1 * r.lines * 201, (name, r)
        answers.add(round(r.m, 6))
    assert len(answers) == len(lines)


def test_layers_are_joined_bucket_to_bucket(spark):
    register_views(spark, DENSE, ["v_ocean", "v_effort_season"])
    plan = q_training.stack_weekly(spark, DENSE)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_training_table_has_all_thirteen_variables(spark):
    register_views(spark, DENSE, ["v_tracks", "v_individuals", "v_effort_season", "v_ocean", *q_training.STATIC_VIEWS])
    df = q_training.q_training.__wrapped__(spark, DENSE)
    variables = [*q_training.LAYERS, *q_training.WEEKLY, q_training.EFFORT]
    counts = df.agg(*[F.count(v).alias(v) for v in variables]).first().asDict()
    assert len(variables) == 13 and all(counts.values()), counts


def granule(spark, rows, schema):
    path = K.scratch_path(spark, "granule")
    spark.createDataFrame(rows, schema).write.parquet(path)
    return path


def test_granules_that_differ_are_an_error(spark):
    a = granule(spark, [(1, 1.0, 1.0, 5.0), (1, 2.0, 1.0, None)], "time int, lat double, lon double, sst double")
    b = granule(spark, [(1, 1.0, 1.0, 5.0), (1, 2.0, 1.0, 7.0)], "time int, lat double, lon double, sst double")
    c = granule(spark, [(1, 1.0, 1.0, 6.0)], "time int, latitude double, longitude double, sea_surface_temperature double")
    d = granule(spark, [(2, 1.0, 1.0, 0.5), (2, 1.0, 2.0, float("nan"))], "Time int, lat double, lon double, chlorophyll double")
    names = {"sst": R.SST_ALIASES, "chlor_a": R.CHL_ALIASES}
    rows = sorted(map(tuple, R.read_granules(spark, [a, b, d], names).select("time", "lat", "lon", "sst", "chlor_a").collect()))
    assert rows[:2] == [(1, 1.0, 1.0, 5.0, None), (1, 2.0, 1.0, 7.0, None)] and rows[2] == (2, 1.0, 1.0, None, 0.5)
    assert rows[3] == (2, 1.0, 2.0, None, None)
    with pytest.raises(Exception, match="granules differ in sst"):
        R.read_granules(spark, [a, c], names).collect()


def test_interpolation_keeps_fractions_of_a_second(spark):
    rows = [("a", "2024-01-07 23:59:59.0", 0.0), ("a", "2024-01-08 00:00:00.8", 1.8), ("b", "2024-01-08 00:00:00", 3.0),
            ("b", "2024-01-08 00:00:00.5", 4.0)]
    df = spark.createDataFrame(rows, "k string, t string, value double").withColumn("time", F.col("t").cast("timestamp_ntz"))
    got = {r.k: r.value for r in T.interpolate_weekly(df, "2024-01-01", "2024-01-31", keys=["k"]).collect()}
    assert abs(got["a"] - 1.0) < 1e-9 and got["b"] == 3.0


def test_a_layer_is_written_once(spark):
    made = []

    def build():
        made.append(1)
        return spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))

    for _ in range(2):
        assert store.layer(spark, "/some/folder", "numbers", ["k"], build).count() == 10
    store.drop_layers(spark, "/some/folder")
    store.layer(spark, "/some/folder", "numbers", ["k"], build)
    assert len(made) == 2
    store.drop_layers(spark, "/some/folder")


def test_rounding_of_many_columns_is_compiled(spark, capsys):
    values = [0.0, -0.0, 1.5e-9, -2.5e-9, 123.4567890125, -7.0, 4503599.627370497, 1e290, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = [r.x for r in report(df).collect()]
    assert got[:6] == [0.0, 0.0, 2e-9, -3e-9, 123.456789013, -7.0] and math.copysign(1.0, got[1]) == 1.0
    assert got[6:10] == values[6:10] and math.isnan(got[10]) and got[11] is None
    wide = spark.range(9).select(*[(F.rand(i) * 100).alias(f"v{i}") for i in range(14)])
    report(wide).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # HotSpot leaves longer methods to its interpreter
