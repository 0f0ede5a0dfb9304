"""Line dedup's numbered documents and the fingerprints at their places, against plain loops."""

from pyspark.sql import functions as F

from tidewell.llm import linededup


def test_documents_are_numbered_in_order_and_once(spark):
    rows = [(5, None, 1, [7]), (1, "b", 4, [7, 8]), (2, "a", -3, [7]), (3, "b", -4, [9]), (4, "b", 4, [7, 8]), (6, None, 0, []), (7, "a", -2, None)]
    units = spark.createDataFrame(rows, "row long, id string, th long, units array<long>").repartition(3)
    got = sorted(map(tuple, linededup.numbered(units).collect()))
    assert got == [(0, 5, None, 1, 1), (1, 2, "a", -3, 1), (2, 3, "b", -4, 1), (3, 1, "b", 4, 2)]


def test_fingerprints_are_the_leftmost_minima_of_windows(spark):
    rows = [(doc, [(doc * 31 + k * k * 7) % 11 for k in range(n)], [1] * n, [(0, 1), (0, n)] if n else []) for doc, n in enumerate([0, 1, 2, 3, 9, 40])]
    units = spark.createDataFrame(rows, "doc long, units array<long>, sizes array<int>, lines array<struct<pos:int,n:int>>")
    hashes = {r.u: r.h for r in spark.range(11).select(F.col("id").alias("u"), F.xxhash64("id").alias("h")).collect()}
    for window in (1, 2, 4):
        want = set()
        for doc, values, _, lines in rows:
            h = [hashes[v] for v in values]
            last = max(len(h) - window, 0)
            picks = {min(range(s, min(s + window, len(h))), key=lambda j: (h[j], j)) for s in range(last + 1)} if h else set()
            want |= {(doc, j, 1) for j in picks} | {(doc, p, n) for p, n in lines}
        got = [(r.place >> linededup.POS_BITS, r.place & ((1 << linededup.POS_BITS) - 1), r.n)
               for r in linededup.fingerprints(units, 1, window).collect()]
        assert len(got) == len(set(got)) and set(got) == want
