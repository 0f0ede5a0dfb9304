"""The quality score against a plain scorer, and that no size of a text decides it."""

from __future__ import annotations

import bisect
import math
import random

import numpy as np
import pytest
import zstandard

from tidewell.llm import quality


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    lexicon = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for i in range(900):
        k = int(2 ** rng.uniform(2, 9))
        good = i % 3 != 0
        chosen = rng.choices(lexicon, k=k) if good or i % 2 else [rng.choice(lexicon)] * k
        rows.append((i, (" " if good else " | ").join(chosen), int(good)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    return docs, labels, quality.fit_quality(docs, labels), {i: (t, q) for i, t, q in rows}


def line(points, values, x):
    """Linear interpolation, constant beyond the ends; of equal points the last one counts."""
    j = bisect.bisect_right(points, x)
    if j == 0 or j == len(points):
        return values[0 if j == 0 else -1]
    part = (x - points[j - 1]) / (points[j] - points[j - 1])
    return values[j - 1] + part * (values[j] - values[j - 1])


def plain_score(model, text):
    data = (text or "").encode()
    sizes = []
    for d in (model.good, model.bad):
        kind = zstandard.DICT_TYPE_AUTO if d[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        packer = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind),
                                          write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(sum(len(packer.compress(data[i:i + quality.BLOCK])) for i in range(0, len(data), quality.BLOCK)))
    x = (sizes[1] - sizes[0]) / len(data) if data else 0.0
    place = line([math.log(c) for c in quality.CENTRES], list(range(len(quality.CENTRES))), math.log(max(1, len(data))))
    low = min(int(place), len(quality.CENTRES) - 2)
    share = sum(w * line(*model.steps[k], x) for k, w in ((low, low + 1 - place), (low + 1, place - low)))
    smooth = 1 / (1 + math.exp(-max(-30, min(30, model.weight * x + model.bias))))
    return (1 - quality.SMOOTH) * share + quality.SMOOTH * smooth


def test_scores_are_those_of_a_plain_scorer(spark, labelled):
    docs, labels, model, truth = labelled
    out = quality.classify_quality(docs, labels).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r.score == pytest.approx(plain_score(model, r.text), abs=1e-9)
        assert r.predicted == int(r.score >= quality.THRESHOLD)
    held = [r for r in spark.createDataFrame(out).withColumn("h", quality.held_out("doc_id")).collect() if r.h]
    assert sum(r.predicted == truth[r.doc_id][1] for r in held) / len(held) >= 0.9
    assert model.score([None, ""]).tolist() == pytest.approx([plain_score(model, "")] * 2)


def test_no_size_is_a_step(labelled):
    _, _, model, _ = labelled
    sizes = np.arange(1, 40_000)
    near = quality.nearness(sizes)
    assert np.allclose(near.sum(axis=1), 1)
    shares = np.column_stack([np.interp(np.linspace(-0.3, 0.3, 61), *fit) for fit in model.steps])
    # the same difference at two neighbouring sizes
    assert np.abs(np.diff(near @ shares.T, axis=0)).max() < 0.05


def test_whole_labelled_texts_are_learnt_from(spark):
    rng = random.Random(3)
    marks = [f"mark{i:04d}" for i in range(40)]
    filler = lambda: " ".join(rng.choices(["sea", "salt", "wave"], k=3000))
    rows = [(i, filler() + " " + " ".join(marks) + " " + filler(), 1) for i in range(12)]
    rows += [(100 + i, filler(), 0) for i in range(12)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, labels)
    assert b"mark0007" in model.good and b"mark0007" not in model.bad
