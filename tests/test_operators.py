"""Custom operators against brute-force NumPy/pandas on hand-made inputs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell import functions as tf
from tidewell.operators import cluster as CL
from tidewell.operators import density as D
from tidewell.operators import grid as G
from tidewell.operators import ranking as RK
from tidewell.operators import resample as RS
from tidewell.operators import spatial as SP
from tidewell.operators import temporal as T
from tidewell.operators import terrain as TR


def _points(spark, n=400, seed=1, hot=True):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-130, -110, n)
    y = rng.uniform(25, 45, n)
    if hot:  # a pile of copies and a dense clump: one third of the rows
        k = n // 3
        x[:k // 2] = -120.0
        y[:k // 2] = 35.0
        x[k // 2:k] = -121 + rng.uniform(0, 0.05, k - k // 2)
        y[k // 2:k] = 36 + rng.uniform(0, 0.05, k - k // 2)
    pdf = pd.DataFrame({"id": np.arange(n, dtype=np.int64), "lon": x, "lat": y})
    return spark.createDataFrame(pdf), pdf


def test_nearest_distance_equals_brute_force(spark):
    df, pdf = _points(spark)
    bbox = {"min_lon": -130.0, "max_lon": -110.0, "min_lat": 25.0, "max_lat": 45.0}
    cells = G.target_grid(spark, bbox, 0.5)
    got = SP.nearest_distance(cells, df, 150.0).toPandas().sort_values(["lat_idx", "lon_idx"])
    gx = got["lon"].to_numpy()[:, None]
    gy = got["lat"].to_numpy()[:, None]
    d = np.sqrt(((gx - pdf["lon"].to_numpy()[None, :]) ** 2 + (gy - pdf["lat"].to_numpy()[None, :]) ** 2).min(1))
    want = np.minimum(d * 111.0, 150.0)
    assert np.allclose(got["distance_km"].to_numpy(), want, atol=1e-9)


def test_nearest_distance_uncapped(spark):
    df, pdf = _points(spark, n=30, hot=False)
    bbox = {"min_lon": -130.0, "max_lon": -110.0, "min_lat": 25.0, "max_lat": 45.0}
    cells = G.target_grid(spark, bbox, 1.0)
    got = SP.nearest_distance(cells, df, None).toPandas()
    gx = got["lon"].to_numpy()[:, None]
    gy = got["lat"].to_numpy()[:, None]
    d = np.sqrt(((gx - pdf["lon"].to_numpy()[None, :]) ** 2 + (gy - pdf["lat"].to_numpy()[None, :]) ** 2).min(1))
    assert np.allclose(got["distance_km"].to_numpy(), d * 111.0, atol=1e-9)


def test_exclude_buffer_equals_brute_force(spark):
    pts, ppdf = _points(spark, n=200)
    cand, cpdf = _points(spark, n=500, seed=7, hot=False)
    got = set(r["id"] for r in SP.exclude_buffer(cand, pts, 60.0).collect())
    r = 60.0 / 111.0
    d2 = ((cpdf["lon"].to_numpy()[:, None] - ppdf["lon"].to_numpy()[None, :]) ** 2
          + (cpdf["lat"].to_numpy()[:, None] - ppdf["lat"].to_numpy()[None, :]) ** 2)
    want = set(cpdf["id"][~(d2 <= r * r).any(1)])
    assert got == want


def test_neighbour_counts_with_copies(spark):
    df, pdf = _points(spark, n=300)
    got = SP.neighbour_counts(df, 10.0).toPandas().set_index("id")["n_neighbours"].sort_index()
    e = 10.0 / 111.0
    x, y = pdf["lon"].to_numpy(), pdf["lat"].to_numpy()
    d2 = (x[:, None] - x[None, :]) ** 2 + (y[:, None] - y[None, :]) ** 2
    want = (d2 <= e * e).sum(1)
    assert (got.to_numpy() == want).all()


def _textbook_dbscan(x, y, eps, min_samples):
    n = len(x)
    d2 = (x[:, None] - x[None, :]) ** 2 + (y[:, None] - y[None, :]) ** 2
    nb = [np.flatnonzero(d2[i] <= eps * eps) for i in range(n)]
    core = np.array([len(v) >= min_samples for v in nb])
    labels = np.full(n, -1)
    label = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] == -1:
                labels[j] = label
                if core[j]:
                    stack.extend(k for k in nb[j] if labels[k] == -1)
        label += 1
    return labels


@pytest.mark.parametrize("seed", [3, 11])
def test_dbscan_equals_textbook(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(0, 1, (6, 2))
    pts = np.concatenate([c + rng.normal(0, 0.03, (40, 2)) for c in centres] + [rng.uniform(0, 1, (60, 2))])
    pts = np.concatenate([pts, np.repeat(pts[:1], 15, axis=0)])  # a pile of copies
    pdf = pd.DataFrame({"id": np.arange(len(pts)), "lon": pts[:, 0], "lat": pts[:, 1]})
    eps_km = 0.04 * 111.0
    got = CL.dbscan(spark.createDataFrame(pdf), eps_km, 6, "id").toPandas().sort_values("id")["cluster"].to_numpy()
    want = _textbook_dbscan(pts[:, 0], pts[:, 1], eps_km / 111.0, 6)
    assert (got == want).all()


def test_dbscan_ambiguous_border_takes_smallest_cluster(spark):
    # two dense groups 2 eps apart, one border point exactly between them
    e = 1.0 / 111.0
    left = [(0.0 + 0.01 * e * i, 0.0) for i in range(5)]
    right = [(2.0 * e + 0.01 * e * i, 0.0) for i in range(5)]
    pts = right + left + [(1.0 * e + 0.005 * e, 0.0)]
    pdf = pd.DataFrame({"id": np.arange(len(pts)), "lon": [p[0] for p in pts], "lat": [p[1] for p in pts]})
    got = CL.dbscan(spark.createDataFrame(pdf), 1.0, 5, "id").toPandas().sort_values("id")["cluster"].to_numpy()
    want = _textbook_dbscan(pdf["lon"].to_numpy(), pdf["lat"].to_numpy(), e, 5)
    assert (got == want).all()


@pytest.mark.parametrize("shift", [2 ** 62, None])
def test_dbscan_of_large_and_text_ids(spark, shift):
    rng = np.random.default_rng(8)
    pts = np.concatenate([c + rng.normal(0, 0.02, (30, 2)) for c in rng.uniform(0, 1, (4, 2))])
    numbers = rng.permutation(len(pts)).tolist()
    ids = [shift + n for n in numbers] if shift else [f"occ-{n:05d}" for n in numbers]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in zip(ids, pts, strict=True)],
                               f"id {'long' if shift else 'string'}, lon double, lat double")
    got = [r["cluster"] for r in CL.dbscan(df, 0.04 * 111.0, 5, "id").orderBy("id").collect()]
    order = np.argsort(numbers)
    assert got == _textbook_dbscan(pts[order, 0], pts[order, 1], 0.04, 5).tolist()


def test_range_rank(spark):
    values = ["b", "a", None, "c", "a", "zz"] + [f"k{i:04d}" for i in range(500)]
    got = RK.range_rank(spark.createDataFrame([(v,) for v in values], "v string"), "v").collect()
    want = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}))}
    assert {r["v"]: r["rank"] for r in got} == want


def test_interpolation_ignores_the_session_zone_and_averages_repeated_times(spark):
    rows = [(1, "2024-03-04 00:00:00", 0.0), (1, "2024-03-04 00:00:00", 2.0), (1, "2024-03-14 00:00:00", 11.0)]
    df = spark.createDataFrame(rows, "k int, t string, value double").selectExpr("k", "cast(t as timestamp_ntz) as time", "value")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # summer time begins in between
        got = T.interpolate_weekly(df, "2024-03-01", "2024-03-31", keys=["k"]).orderBy("week_start").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r["value"] for r in got] == [1.0, 8.0]


def test_missing_coordinates_are_an_error(spark):
    from tidewell.operators import columns as C

    with pytest.raises(ValueError):
        C.normalize_columns(spark.createDataFrame([(1.0, 2.0)], "longitude double, latitude double"))


def test_cells_without_coordinates_have_no_distance(spark):
    from tidewell.operators import spatial as SP

    cells = spark.createDataFrame([(0, 0, 1.0, 1.0), (0, 1, None, 1.0)], "lat_idx int, lon_idx int, lon double, lat double")
    points = spark.createDataFrame([(1.0, 2.0)], "lon double, lat double")
    for cap in (None, 500.0):
        got = {r["lon_idx"]: r["distance_km"] for r in SP.nearest_distance(cells, points, cap).collect()}
        assert abs(got[0] - 111.0) < 1e-9 and got[1] is None


def test_block_rank_and_first_n(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "o": rng.permutation(5000)})
    df = spark.createDataFrame(pdf)
    got = RK.block_rank(df, "o", ["g"], block=64).toPandas()
    want = pdf.assign(rank=pdf.groupby("g")["o"].rank().astype(int))
    m = got.merge(want, on=["g", "o"])
    assert (m["rank_x"] == m["rank_y"]).all() and len(m) == 5000
    lim = df.withColumn("n", F.lit(700))
    kept = RK.first_n(lim, "o", "n", ["g"], block=64).toPandas()
    assert kept.groupby("g").size().max() == 700
    assert set(map(tuple, kept[["g", "o"]].values)) == set(
        map(tuple, want[want["rank"] <= 700][["g", "o"]].values))


@pytest.mark.parametrize(("bins", "direct"), [(256, 10_000), (256, 0), (4, 30)])
def test_exact_median_matches_numpy(spark, bins, direct):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.integers(0, 5, 999), "v": rng.integers(0, 20, 999).astype(float)})
    pdf.loc[pdf["k"] == 4, "v"] = rng.normal(size=(pdf["k"] == 4).sum())  # many distinct values
    pdf = pd.concat([pdf, pd.DataFrame({"k": [9, 9], "v": [1.0, 2.0]}), pd.DataFrame({"k": [8], "v": [5.0]})])
    got = T.exact_median(spark.createDataFrame(pdf), ["k"], "v", "m", bins, direct).toPandas().set_index("k")["m"].sort_index()
    want = pdf.groupby("k")["v"].median().sort_index()
    assert np.allclose(got.to_numpy(), want.to_numpy())


def test_week_labels_are_sundays(spark):
    df = spark.range(0, 60).select(F.expr("timestamp_ntz'2021-01-01 13:00:00' + make_interval(0,0,0,cast(id as int))")
                                   .alias("t"))
    out = df.select(tf.week_label("t").alias("w"), "t").toPandas()
    assert (pd.to_datetime(out["w"]).dt.dayofweek == 6).all()
    assert ((pd.to_datetime(out["w"]) - pd.to_datetime(out["t"]).dt.normalize()).dt.days.between(0, 6)).all()


def test_gradient_of_plane_is_constant_and_slope_of_flat_is_zero(spark):
    bbox = {"min_lon": 0.0, "max_lon": 1.0, "min_lat": 0.0, "max_lat": 1.0}
    grid = G.target_grid(spark, bbox, 0.1)
    layer = grid.select("lat_idx", "lon_idx", (F.col("lon") * 3.0 + F.col("lat") * 4.0).alias("v"),
                        F.lit(0.0).alias("flat"))
    g = TR.gradient_magnitude(layer, "v", 0.1, 11, 11).toPandas()
    assert np.allclose(g["gradient"], 5.0 / 111.0)
    s = TR.slope_degrees(layer, "flat", 0.1, 11, 11).toPandas()
    assert (s["Slope_deg"] == 0.0).all()


def test_gradient_matches_numpy(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(6, 7))
    a[2, 3] = np.nan
    rows = [(i, j, None if np.isnan(a[i, j]) else float(a[i, j])) for i in range(6) for j in range(7)]
    df = spark.createDataFrame(rows, "lat_idx int, lon_idx int, v double")
    got = TR.gradient_magnitude(df, "v", 0.1, 6, 7).toPandas().sort_values(["lat_idx", "lon_idx"])
    dy, dx = np.gradient(a, 0.1 * 111.0)
    want = np.sqrt(dx ** 2 + dy ** 2).ravel()
    g = got["gradient"].to_numpy(dtype=float)
    assert np.array_equal(np.isnan(g), np.isnan(want))
    assert np.allclose(g[~np.isnan(g)], want[~np.isnan(want)])


def test_bilinear_exact_on_plane(spark):
    src = [(lat, lon, 2.0 * lat - 3.0 * lon) for lat in np.arange(0, 3.01, 0.5) for lon in np.arange(0, 3.01, 0.75)]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in src], "lat double, lon double, v double")
    grid = G.target_grid(spark, {"min_lon": 0.0, "max_lon": 3.0, "min_lat": 0.0, "max_lat": 3.0}, 0.1)
    out = RS.resample(df, grid, ["v"], "bilinear").join(grid, ["lat_idx", "lon_idx"]).toPandas()
    assert len(out) == 31 * 31
    assert np.allclose(out["v"], 2.0 * out["lat"] - 3.0 * out["lon"])


def test_nearest_ties_go_low_and_outside_is_missing(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (0.0, 1.0, 2.0)], "lat double, lon double, v double")
    grid = G.target_grid(spark, {"min_lon": 0.0, "max_lon": 1.5, "min_lat": 0.0, "max_lat": 0.0}, 0.5)
    out = RS.resample(df, grid, ["v"], "nearest").toPandas().set_index("lon_idx")["v"].to_dict()
    assert np.isnan(out.pop(3))  # 1.5 is outside: a cell without a value
    assert out == {0: 1.0, 1: 1.0, 2: 2.0}  # 0.5 is a tie -> lower


@pytest.mark.parametrize("npts", [4, 5, 9])
def test_cubic_spline_matches_dense_not_a_knot(npts):
    rng = np.random.default_rng(9)
    x = np.sort(rng.uniform(0, 10, npts))
    y = rng.normal(size=npts)
    xt = np.linspace(x[0], x[-1], 57)
    got = RS.cubic_eval(x, y, xt)
    # dense solve of the same spline: piecewise cubic coefficients with C2 + not-a-knot
    n = len(x) - 1
    A = np.zeros((4 * n, 4 * n))
    b = np.zeros(4 * n)
    r = 0
    for i in range(n):
        for xx, yy in ((x[i], y[i]), (x[i + 1], y[i + 1])):
            A[r, 4 * i:4 * i + 4] = [1, xx, xx ** 2, xx ** 3]
            b[r] = yy
            r += 1
    for i in range(n - 1):
        xx = x[i + 1]
        A[r, 4 * i:4 * i + 4] = [0, 1, 2 * xx, 3 * xx ** 2]
        A[r, 4 * i + 4:4 * i + 8] = [0, -1, -2 * xx, -3 * xx ** 2]
        r += 1
        A[r, 4 * i:4 * i + 4] = [0, 0, 2, 6 * xx]
        A[r, 4 * i + 4:4 * i + 8] = [0, 0, -2, -6 * xx]
        r += 1
    for i in (0, n - 2):
        A[r, 4 * i + 3] = 1
        A[r, 4 * i + 7] = -1
        r += 1
    c = np.linalg.solve(A, b).reshape(n, 4)
    k = np.clip(np.searchsorted(x, xt) - 1, 0, n - 1)
    want = c[k, 0] + c[k, 1] * xt + c[k, 2] * xt ** 2 + c[k, 3] * xt ** 3
    assert np.allclose(got, want, atol=1e-8)


def test_interpolate_weekly_matches_numpy(spark):
    days = pd.date_range("2024-01-01", "2024-03-01", freq="3D")
    vals = np.sin(np.arange(len(days)))
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "time": days, "value": vals}))
    got = T.interpolate_weekly(df, "2024-01-01", "2024-03-31", keys=["k"]).toPandas().sort_values("week_start")
    mondays = pd.date_range("2024-01-01", "2024-03-01", freq="W-MON")
    want = np.interp(mondays.astype("int64"), days.astype("int64"), vals)
    assert len(got) == len(mondays)
    assert np.allclose(got["value"].to_numpy(), want)


@pytest.mark.parametrize("bandwidth_km", [None, 50.0])
def test_kde_matches_brute_force_down_to_its_tail(spark, bandwidth_km, monkeypatch):
    monkeypatch.setattr(D, "MAX_POINTS_PER_TASK", 7)  # force blocks of hot tiles
    df, pdf = _points(spark, n=120, hot=False)
    cells = G.target_grid(spark, {"min_lon": -130.0, "max_lon": -110.0, "min_lat": 25.0, "max_lat": 45.0}, 1.0)
    got = D.kde_density(cells, df, bandwidth_km=bandwidth_km).toPandas().sort_values(["lat_idx", "lon_idx"])
    data = np.vstack([pdf["lon"], pdf["lat"]])
    n = data.shape[1]
    cov = np.cov(data) * n ** (-1 / 3) if bandwidth_km is None else np.eye(2) * (bandwidth_km / 111.0) ** 2
    inv = np.linalg.inv(cov)
    pts = np.vstack([got["lon"], got["lat"]])
    d = pts[:, :, None] - data[:, None, :]
    q = np.einsum("ijk,il,ljk->jk", d, inv, d)
    want = np.exp(-0.5 * q).sum(1) / (n * 2 * math.pi * math.sqrt(np.linalg.det(cov)))
    assert np.allclose(got["density"].to_numpy(), want, rtol=1e-9, atol=0)
    assert ((got["density"].to_numpy() > 0) == (want > 0)).all()


def test_target_grid_has_integer_axis_length(spark):
    g = G.target_grid(spark, {"min_lon": -122.0, "max_lon": -120.0, "min_lat": 36.0, "max_lat": 38.0}, 0.1)
    assert g.count() == 21 * 21
    assert G.target_grid(spark).count() == 201 * 201


@pytest.mark.parametrize("gap", [0.97, 1.03])
def test_dbscan_clumps_linked_only_by_far_cells(spark, gap):
    # two tight dense clumps whose closest points are gap * eps apart, empty
    # cells between them: only the point test between non-touching cells decides
    rng = np.random.default_rng(8)
    e = 1.0 / 111.0
    a = np.column_stack([rng.uniform(-0.05, 0.0, 30) * e, rng.uniform(-0.02, 0.02, 30) * e])
    b = np.column_stack([gap * e + rng.uniform(0.0, 0.05, 30) * e, rng.uniform(-0.02, 0.02, 30) * e])
    a[0] = (0.0, 0.0)
    b[0] = (gap * e, 0.0)
    pts = np.concatenate([b, a, rng.uniform(-5, 5, (20, 2)) * e])
    pdf = pd.DataFrame({"id": np.arange(len(pts)), "lon": pts[:, 0], "lat": pts[:, 1]})
    got = CL.dbscan(spark.createDataFrame(pdf), 1.0, 5, "id").toPandas().sort_values("id")["cluster"].to_numpy()
    want = _textbook_dbscan(pdf["lon"].to_numpy(), pdf["lat"].to_numpy(), e, 5)
    assert (got == want).all()
    assert len(set(want[want >= 0])) == (1 if gap < 1 else 2)


def test_cubic_many_lines_equal_single_lines():
    rng = np.random.default_rng(12)
    x = np.sort(rng.uniform(0, 10, 12))
    ys = rng.normal(size=(5, 12))
    ys[2, 4] = np.nan
    xt = np.linspace(-1, 11, 40)
    many = RS.cubic_eval_many(x, ys, xt)
    for i in range(5):
        one = RS.cubic_eval(x, ys[i], xt)
        assert np.array_equal(np.isnan(one), np.isnan(many[i]))
        assert np.allclose(one[~np.isnan(one)], many[i][~np.isnan(one)])
    assert np.isnan(many[2]).all()


def test_resample_cubic_reproduces_a_cubic_surface(spark):
    # a separable cubic is reproduced exactly by not-a-knot splines
    rows = [(float(la), float(lo), float(la ** 3 - 2 * la + 0.5 * lo ** 3 + lo))
            for la in np.arange(0.0, 3.01, 0.5) for lo in np.arange(0.0, 4.01, 0.5)]
    df = spark.createDataFrame(rows, "lat double, lon double, v double")
    grid = G.target_grid(spark, {"min_lon": 0.0, "max_lon": 4.0, "min_lat": 0.0, "max_lat": 3.0}, 0.25)
    out = RS.resample_cubic(df, grid, "v").join(grid, ["lat_idx", "lon_idx"]).toPandas()
    assert len(out) == 13 * 17
    assert np.allclose(out["v"], out["lat"] ** 3 - 2 * out["lat"] + 0.5 * out["lon"] ** 3 + out["lon"])
