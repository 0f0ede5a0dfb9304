"""Axis maps keep the source coordinates next to a target, whatever the length of the source's axis."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import resample as RS


def axes(spark, source, targets):
    s = spark.createDataFrame([(x,) for x in source], "s double")
    return s, spark.createDataFrame(list(enumerate(targets)), "idx int, t double")


def slow_brackets(source, targets):
    xs, out = sorted({x for x in source if x is not None}), {}
    for i, t in enumerate(targets):
        k = bisect.bisect_left(xs, t)
        if k == 0 and xs and xs[0] == t:
            k = 1
        if 0 < k < len(xs):
            out[i] = (xs[k - 1], xs[k], (t - xs[k - 1]) / (xs[k] - xs[k - 1]))
    return out


def slow_nearest(source, targets):
    xs = sorted({x for x in source if x is not None})
    return {i: min(xs, key=lambda x: (abs(x - t), x)) for i, t in enumerate(targets) if xs and xs[0] <= t <= xs[-1]}


@pytest.mark.parametrize("kind", ["long", "sparse", "equal", "one", "repeated", "outside"])
def test_axis_maps_against_plain_search(spark, kind):
    rng = random.Random(kind)
    targets = [float(i) for i in range(12)]
    source = {"long": [rng.uniform(-5, 40) for _ in range(3000)], "sparse": [0.5, 7.25, 9.0, None], "equal": [0.0, 1.0, 2.0, 3.0, 11.0],
              "one": [4.0], "repeated": [2.0, 2.0, 2.5, 2.5, 6.0, None], "outside": [-3.0, -2.0, 30.0, 31.0]}[kind]
    s, t = axes(spark, source, targets)
    assert {r.idx: (r.lo, r.hi, r.w) for r in RS.linear_brackets(s, t).collect()} == slow_brackets(source, targets)
    assert {r.idx: r.s for r in RS.nearest_axis_map(s, t).collect()} == slow_nearest(source, targets)


def test_a_longer_axis_makes_no_longer_window(spark):
    targets = [float(i) for i in range(10)]
    for n in (2_000, 20_000):
        s, t = axes(spark, [-5.0 + i / 100 for i in range(n)], targets)
        assert RS.near_targets(s, t).count() <= 4 * len(targets) + 2


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_no_frame_is_read_anew_for_each_row(spark, method):
    rows = spark.range(100).select((F.col("id") % 10).cast("double").alias("lat"), F.floor(F.col("id") / 10).cast("double").alias("lon"),
                                   F.col("id").cast("double").alias("v"))
    grid = rows.select(F.col("lat").cast("int").alias("lat_idx"), F.col("lon").cast("int").alias("lon_idx"), "lat", "lon")
    plan = RS.resample(rows, grid, ["v"], method)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "unboundedfollowing" not in plan.lower()
