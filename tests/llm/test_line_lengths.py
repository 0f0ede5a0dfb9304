"""Line dedup's shingle sizes and extensions against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm import linededup


@pytest.mark.parametrize("shingle_units,min_chars", [(3, 80), (1, 40), (2, 9)])
def test_shingle_sizes(spark, shingle_units, min_chars):
    rng = random.Random(shingle_units)
    texts = [[rng.choice([1, 1, 2, 5, 30]) for _ in range(n)] for n in (0, 1, 2, 3, 7, 40, 120, 200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, lengths array<int>")
    sums = F.transform("lengths", lambda x, i: sum((F.coalesce(F.get("lengths", i + k), F.lit(0)) for k in range(1, shingle_units)), x))
    got = rows.withColumn("sums", sums).select("id", F.transform("lengths", lambda _, i: linededup.shingle_size(
        "lengths", "sums", i, shingle_units, min_chars)).alias("sizes"))

    def size(lengths, i):
        fits = (n for n in range(shingle_units, len(lengths) - i + 1) if sum(lengths[i:i + n]) >= min_chars)
        return next(fits, None)

    assert {r.id: r.sizes for r in got.collect()} == {k: [size(t, i) for i in range(len(t))] for k, t in enumerate(texts)}


@pytest.mark.parametrize("longest", [0, 1, 2, 9, 33])
def test_extensions_reach_as_far_as_any_earlier_place(spark, longest):
    rng = random.Random(longest)
    rows = [(run, (k,), [rng.choice([7, 7, 7, 8]) for _ in range(rng.randint(0, longest))]) for run in (1, 2, 3) for k in range(20)]
    places = spark.createDataFrame(rows, "run long, place struct<id:long>, ext array<bigint>")

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    want = {}
    for run, (k,), ext in rows:
        far = max((common(ext, e) for r, (j,), e in rows if r == run and j < k), default=0)
        if far:
            want[run, k] = far
    got = linededup._reaches(places).collect()
    assert {(r.run, r.place.id): r.far for r in got} == want
    assert len(got) == len(want)
