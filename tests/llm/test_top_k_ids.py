"""Top-k search where an id has many vectors."""

import numpy as np

from tidewell.llm import topk


def test_top_k_of_an_id_with_many_vectors():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(50, 60, (300, 6)), rng.integers(0, 50, (600, 6))])
    ids = np.concatenate([np.full(300, 7), np.arange(100, 700)])
    for big in (1, 2 ** 50):  # Python integers too
        queries, best = rng.integers(1, 9, (5, 6)), topk.Best(np.arange(5), 20)
        topk.threshold_search(topk.Candidates(ids, rows * big), queries, best, depth=400)
        for q, found in zip(queries, best.found, strict=True):
            most: dict[int, int] = {}
            for i, row in zip(ids.tolist(), rows.tolist(), strict=True):
                most[i] = max(most.get(i, 0), sum(a * b for a, b in zip(q.tolist(), row, strict=True)) * big)
            assert found == sorted((-s, i) for i, s in most.items())[:20]
