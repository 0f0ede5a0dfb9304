"""Ranked search against scores of all documents, in Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_search(docs, items, k):
    vectors = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    vectors = [v for v in vectors if v[2]]
    n_docs, length = len(vectors), sum(v[2] for v in vectors)
    df = Counter(t for _, v, _ in vectors for t in v)
    out = []
    for item, text in set(items):
        scored = []
        for i, v, n in vectors:
            m = 25 + 75 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * v[t] // (1000 * v[t] + 8 * m))
                        for t in terms(text) if v[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, rank, i if known else None, -s) for rank, (s, known, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def made(seed, n, words):
    rng = random.Random(seed)
    text = lambda: " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(rng.randint(0, 40)))
    docs = [(i, text()) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(n // 3)]  # a group of copies
    docs += [(5, docs[5][1]), (None, docs[9][1]), (None, None), (n * 2, None), (n * 2 + 1, ""), (n * 2 + 2, "Éa-ÉA x y W1\x7fw2")]
    items = [(i, text()) for i in range(25)] + [(1, "w1 w2"), (1, "w1 w2"), (None, "W1 w1 w5 nowhere"), (30, None), (31, ""), (32, "?!"), (33, "éa ÉA")]
    return docs, items


@pytest.mark.parametrize("leaf,tree", [(32, 8192), (1, 64), (4, 100000), (2, 1)])
def test_against_all_scores(spark, monkeypatch, leaf, tree):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "TREE_DOCS", tree)
    docs, items = made(leaf, 300, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns(
        {c: F.lit("x") for c in ("id", "n", "terms", "tfs", "score", "rank", "item")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("block", F.lit(1))
    out = lexical.ranked_search(frame, asked)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(str, map(tuple, out.collect()))) == slow_search(docs, items, 10)


def test_many_item_blocks_and_other_k(spark):
    docs, items = made(3, 120, 30)
    out = lexical.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"), k=3, block_chars=600)
    assert sorted(map(str, map(tuple, out.collect()))) == slow_search(docs, items, 3)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked_search(none, some).collect() == []
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert lexical.ranked_search(docs, some.filter("item_id = 2")).collect() == []
    assert lexical.ranked_search(spark.createDataFrame([(1, "?")], "doc_id long, text string"), some).collect() == []


def test_subtrees_are_left_out():
    """Documents of other subjects are not scored: the bounds close their subtrees."""
    rng = random.Random(8)
    subjects = [[f"s{s}t{i}" for i in range(30)] for s in range(40)]
    rows = [sorted(set(rng.choices(subjects[d % 40], k=20))) for d in range(4000)]
    names = {t: i for i, t in enumerate(sorted({t for r in rows for t in r}))}
    offsets = np.cumsum([0, *(len(r) for r in rows)])
    tree = lexical.Tree(np.arange(4000), np.full(4000, 100), offsets, np.array([names[t] for r in rows for t in r]), np.ones(offsets[-1], np.int64))
    best, slot = [], np.full(len(names), -1)
    asked = np.array([names[t] for t in subjects[7][:5]])
    scored = tree.search(asked, np.full(5, 1000), slot, best, 10)
    assert len(best) == 10 and scored <= 400 and (slot == -1).all()
