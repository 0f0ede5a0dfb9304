"""Licence spans and templates that repeat bigrams."""

import random

from tidewell.llm import licenses


def test_licence_spans_and_templates_that_repeat_bigrams(spark):
    by_nc, mit, gpl, notice = (licenses.TEMPLATES[n] for n in ("CC-BY-NC-4.0-short", "MIT", "GPL-3.0", "MIT-notice"))
    texts = [f"{by_nc} {by_nc}", f"{mit} {mit}", f"{gpl} {gpl}", " ".join(notice.split()[:44]), f"{mit}\n{mit}", mit * 30]
    got = {(r.doc_id, r.kind): r for r in licenses.scan_licenses(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() if r.first_line == 0}
    want = {(0, "line"): ("CC-BY-NC-4.0-short", 12 / 13), (1, "line"): ("MIT", 8 / 9), (2, "line"): ("GPL-3.0", 22 / 23),
            (3, "line"): ("MIT-notice", None), (4, "line"): ("MIT", 1.0), (4, "paragraph"): ("MIT", 8 / 9),
            (5, "line"): ("MIT", 8 / 9)}
    assert {k: r.license for k, r in got.items()} == {k: v for k, (v, _) in want.items()}
    assert all(dice is None or abs(got[k].dice - dice) < 1e-12 for k, (_, dice) in want.items())
    assert got[3, "line"].dice >= 0.8


def test_anchors_lose_no_match():
    rng = random.Random(4)
    for text in licenses.TEMPLATES.values():
        grams = licenses.template_bigrams(text)[1]
        for threshold in (0.3, 0.8, 1.0):
            chosen, need = licenses.anchors(grams, threshold), licenses.least_shared(len(grams), threshold)
            for _ in range(20):
                assert any(not chosen.isdisjoint(g.split()) for g in rng.sample(grams, need))
            assert sum(chosen.isdisjoint(g.split()) for g in grams) < need
