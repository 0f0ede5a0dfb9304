"""Top-k search of query blocks over candidate blocks in several parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import topk


def _vectors(n=400, seed=8):
    rng = random.Random(seed)
    return [(rng.randrange(n // 2), [rng.choice([-2.0, -0.5, 0.25, 1.0, 3.0]) for _ in range(rng.choice([3, 4, 4]))])
            for _ in range(n)]


def _expected(vectors, k):
    best = {}
    for q, v in vectors:
        for c, w in vectors if q % 5 == 0 else []:
            if c != q and len(v) == len(w):
                score = sum(int(64 * a) * int(64 * b) for a, b in zip(v, w, strict=True))
                best.setdefault(q, {})[c] = max(score, best.get(q, {}).get(c, score))
    return sorted((q, r, c, s) for q, found in best.items()
                  for r, (c, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k], 1))


def test_top_k_joins_and_broadcasts_nothing(spark):
    """Copies of the query blocks for all candidate blocks must not pass through the driver."""
    frame = spark.createDataFrame(_vectors(), "vec_id long, embedding array<double>")
    plan = topk.top_k(frame, F.col("id") % 5 == 0, k=3, block_rows=16, query_rows=8)._jdf.queryExecution().toString()
    assert "CoGroupsInArrow" in plan
    assert "Broadcast" not in plan and "Join" not in plan


@pytest.mark.parametrize("part_bytes", [1, 2000])
def test_top_k_of_many_parts(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(topk, "PART_BYTES", part_bytes)
    monkeypatch.setattr(topk, "TASKS", 1)
    vectors = _vectors()
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = topk.top_k(frame, F.col("id") % 5 == 0, k=6, block_rows=32, query_rows=16)
    assert sorted(map(tuple, found.collect())) == _expected(vectors, 6)


def test_slots_are_dealt_one_to_each_partition(spark):
    frame = spark.range(37).select(topk._slot(spark, F.col("id"), 37).alias("slot")).repartition(37, "slot")
    assert sorted(r[0] for r in frame.select(F.spark_partition_id()).collect()) == list(range(37))


def test_blocks_are_as_narrow_as_their_numbers(spark):
    frame = spark.createDataFrame([(1, [-33, 32]), (2, [127, -128])], "id long, v array<long>")
    assert [r.kind for r in topk._as_blocks(frame, 10).collect()] == ["|i1"]


def test_equal_scores_go_to_smaller_ids_of_later_blocks():
    best, ids = topk.Best(np.array([5000]), 3), np.arange(2000)
    for part in (ids[1000:], ids[:1000]):
        topk.threshold_search(topk.Candidates(part, np.ones((1000, 2), dtype=np.int64)), np.array([[1, 1]]), best)
    assert best.found == [[(-2, 0), (-2, 1), (-2, 2)]]
