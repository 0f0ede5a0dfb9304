"""Neighbour counts and DBSCAN links by pairs of squares: exact, and without all pairs of dense cells."""

from __future__ import annotations

import numpy as np
import pytest

from tidewell.operators import cluster as C
from tidewell.operators import spatial as SP

EPS = 10.0 / 111.0


@pytest.fixture
def compared(monkeypatch):
    """How many location pairs the cut squares hold, call by call."""
    seen, whole = [], SP.close_points

    def counted(cut, placed, r2):
        mine = placed.toDF("level", "a_x", "a_y", "px", "py", "pw")
        other = placed.toDF("level", "b_x", "b_y", "qx", "qy", "qw")
        seen.append(cut.join(mine, ["level", "a_x", "a_y"]).join(other, ["level", "b_x", "b_y"]).count())
        return whole(cut, placed, r2)

    monkeypatch.setattr(SP, "close_points", counted)
    return seen


def frame(spark, x, y):
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "lon": x, "lat": y}))


def brute(x, y):
    return np.array([((x - a) * (x - a) + (y - b) * (y - b) <= EPS * EPS).sum() for a, b in zip(x, y, strict=True)])


def dense(n, seed=0):
    """Half of the points in one square of a third of eps, half of them a little within or beyond eps of it."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.uniform(0, EPS / 3, n // 2), rng.uniform(EPS * 0.8, EPS * 1.2, n - n // 2)])
    return x - 120.0, rng.uniform(0, EPS / 3, n) - 33.0


def test_counts_of_dense_cells_are_exact_and_subquadratic(spark, compared):
    for n in (2000, 8000):
        x, y = dense(n)
        got = SP.neighbour_counts(frame(spark, x, y), 10.0).toPandas().sort_values("id")["n_neighbours"].to_numpy()
        assert (got == brute(x, y)).all()
    few, many = compared
    # four times the points: all pairs would be 16 times as many
    assert many < 9 * few and many < 0.05 * 8000 ** 2


def test_counts_on_the_circle_and_with_negative_zero(spark):
    x = np.array([0.0, -0.0, EPS, EPS, 0.0, np.nextafter(EPS, 1)] + [0.0] * 40)
    y = np.array([0.0, 0.0, 0.0, -0.0, EPS, 0.0] + list(np.linspace(0, EPS, 40)))
    got = SP.neighbour_counts(frame(spark, x, y), 10.0).toPandas().sort_values("id")["n_neighbours"].to_numpy()
    assert (got == brute(x, y)).all()


def test_no_points(spark):
    assert SP.neighbour_counts(frame(spark, np.array([0.0]), np.array([0.0])).filter("id < 0"), 10.0).count() == 0


@pytest.mark.parametrize("gap, clusters", [(0.9999, 1), (1.0001, 2)])
def test_two_clumps_about_eps_apart(spark, compared, gap, clusters):
    n = 20_000
    rng = np.random.default_rng(4)
    side = EPS / 10
    x, y = rng.uniform(0, side, 2 * n), rng.uniform(0, side, 2 * n)
    x[n:] += side + gap * EPS
    # the two nearest places, one over the other
    x[0], y[0], x[n], y[n] = side, side / 2, side + gap * EPS, side / 2
    got = C.dbscan(frame(spark, x - 120.0, y - 33.0), 10.0, 5).toPandas().sort_values("id")["cluster"].to_numpy()
    assert len(set(got)) == clusters and (got[:n] == got[0]).all() and (got[n:] == got[n]).all()
    assert sum(compared) < 4 * n
