"""The ocean products cover the whole 0.1-degree grid every week."""

import pytest

import __spark_entry__ as entry


@pytest.mark.parametrize("key", ["product_chlorophyll_weeks", "product_sea_level_weeks", "product_salinity_weeks"])
def test_weeks_hold_every_cell(spark, sf_dir, key):
    weeks = entry.queries()[key](spark, sf_dir).collect()
    assert weeks and {r.n_cells for r in weeks} == {201 * 201}  # the smallest cube has no cell with four corners
