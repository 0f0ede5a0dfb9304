"""Ocean products over the whole calendar and all places: rows of the orders table at hand, written for each test."""

import datetime
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

HALVES = 41 * 41


@pytest.fixture(scope="module")
def orders(spark):
    """Orders at all 81 places on one day of 1995 and on one of 2001."""
    folder = tempfile.mkdtemp(prefix="tidewell-orders-")
    rows = [(100 * day + place, place, datetime.datetime(*at), 1000.0 * place + 20000.0 * day)
            for day, at in enumerate(((1995, 1, 4), (2001, 8, 1))) for place in range(81)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(
        os.path.join(folder, "orders.parquet"))
    return folder


@pytest.mark.parametrize("key, value", [("product_sst", "SST_mean_C"), ("product_chlorophyll", "Chla_mean_mg_m3"),
                                        ("product_salinity", "Salinity_mean_PSU")])
def test_cells_of_every_week_of_the_calendar(spark, orders, key, value):
    df = entry.queries()[key](spark, orders)
    weeks = {r.week: r for r in df.groupBy("week").agg(F.count("*").alias("n"), F.sum(f"n_{value}").alias("values"), F.count(value).alias("corners")).collect()}
    first, last = datetime.date(1995, 1, 8), datetime.date(2001, 8, 5)
    assert len(weeks) == (last - first).days // 7 + 1 and {r.n for r in weeks.values()} == {HALVES}
    assert all(r["values"] == 0 for w, r in weeks.items() if w not in (first, last))
    assert all(weeks[w]["values"] > 0 and weeks[w].corners > 0 for w in (first, last))
    if key == "product_sst":
        assert weeks[first]["values"] == 201 * 201
        r = df.filter((F.col("week") == first) & (F.col("lat_idx") == 5) & (F.col("lon_idx") == 10)).first()
        assert (r.SST_mean_C, r.SST_mean_C_min) == (0.95, 0.95)  # place 19, two lines up and one to the right
        assert r.SST_mean_C_max == pytest.approx(0.95 + 4 * (0.05 + 0.45) / 25, abs=1e-9) and r.SST_grad_C_km > 0


def test_weeks_of_the_calendar(spark, orders):
    chl = entry.queries()["product_chlorophyll_weeks"](spark, orders).collect()
    sst = entry.queries()["product_sst_weeks"](spark, orders).collect()
    assert len(chl) == len(sst) == 344 and {r.n_cells for r in chl + sst} == {201 * 201}
    assert sum(r.n_values > 0 for r in chl) == sum(r.n_values > 0 for r in sst) == 2


def test_weeks_of_sst_are_laid_out_in_blocks(spark, orders):
    plan = entry.queries()["product_sst_weeks"](spark, orders)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Window" not in plan
