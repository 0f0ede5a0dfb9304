"""Personal data: base spans by brute force, added spans on planted cases, and the fit on made-up votes."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewell.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        twice = int(c) * (1 + i % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def slow_base(text):
    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and passes_luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if fine:
                spans.append((m.start(), order, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


def card(rng, n=16):
    head = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(head + c for c in "0123456789" if passes_luhn(head + c))


TRICKY = ["a@b.c._x@d.e", "a@b@c.d", "x@y", "@a.b", "a@b..c", "++@--.--", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "0255.000.1.1",
          "1.2.3", "+1 (017) 555-7713", "+1((((((((((", "+12345678901234567", "+1-2", "++49 30 1234567 8", "é\U0001f600 a@b.de \U0001f600 1.2.3.4",
          "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111", "1 2 3 4 5 6 7 8 9", "4111111111111111 -4111111111111111",
          "tel: 555-123-4567, call now", "mail me: jane.doe [at] example [dot] com", "", None, " \n\t", "0" * 5000, "1." * 3000, "a" * 20000 + "@b.c"]


def documents():
    rng = random.Random(5)
    made = []
    for i in range(300):
        words = ["".join(rng.choice("abcé ") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice([
                card(rng), "".join(rng.choice("0123456789 -.+()@a") for _ in range(rng.randint(5, 30))),
                f"u{i}@mail{i % 3}.example.com", ".".join(str(rng.randint(0, 300)) for _ in range(4)),
                f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"]))
        made.append(rng.choice([" ", "\n", ""]).join(words))
    return [(i, t) for i, t in enumerate(TRICKY + made)] + [(None, "a@b.c"), (7, "a@b.c"), (7, "a@b.c")]


def test_base_spans_against_brute_force(spark):
    rows = documents()
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("other") for c in ("id", "spans", "base", "added", "company", "kind")})
    out = pii.digests(pii.find_personal_data(frame)).collect()
    assert len(out) == len(rows)
    want = sorted(str((i, *[sum(s.startswith(k) for s in slow_base(t)) for k in PATTERNS],
                       hashlib.sha256(",".join(slow_base(t)).encode()).hexdigest())) for i, t in rows)
    assert sorted(str((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)) for r in out) == want
    by_text = {r.doc_id: r.spans for r in out if r.doc_id is not None}
    for i, t in rows:
        if i is not None and i != 7:
            assert set(slow_base(t)) <= set(by_text[i].split(",")) | {""}
            for span in filter(None, by_text[i].split(",")):
                kind, a, b = span.split(":")
                digits = re.sub("[^0-9]", "", t[int(a):int(b)])
                assert kind not in ("card", "phone") or kind == "card" and passes_luhn(digits) or 10 <= len(digits) <= 15


def test_numbers_inside_failed_matches_are_added_and_clean_texts_left_alone(spark):
    rng = random.Random(6)
    rows = [(i, f"words before {card(rng)} and after") for i in range(200)]
    rows += [(200 + i, f"order {i} of 12 pages, version 1.2.{i}, 20{i:02d}-01-02, {rng.randint(10 ** 6, 10 ** 8)}") for i in range(100)]
    two = [(card(rng), card(rng)) for _ in range(40)]
    rows += [(400 + i, f"two {a} {b} run together") for i, (a, b) in enumerate(two)]
    rows += [(500 + i, f"call +1 (017) 555-{1000 + i} 170.106.4.{i} please") for i in range(40)]
    found = {r.doc_id: r.spans for r in pii.digests(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(found[i] == "" for i in range(200, 300))
    assert all(found[400 + i] == f"card:4:{4 + len(a)},card:{5 + len(a)}:{5 + len(a) + len(b)}" for i, (a, b) in enumerate(two)
               if not slow_base(f"{a} {b}"))
    assert all("phone:5:22" in found[500 + i] for i in range(40))


def test_reliabilities_follow_the_labelers_that_agree():
    rng = random.Random(7)
    counts = {}
    for _ in range(5000):
        truth = rng.random() < 0.5
        good = [1 if (rng.random() < 0.9) == truth else -1 for _ in range(3)]
        votes = (*good, rng.choice([-1, 1]))
        counts[votes] = counts.get(votes, 0) + 1
    p = pii.reliabilities([(2, v, n) for v, n in counts.items()])
    assert p[2, (1, 1, 1, -1)] > 0.95 and p[2, (-1, -1, -1, 1)] < 0.05
    assert abs(p[2, (1, 1, 1, -1)] - p[2, (1, 1, 1, 1)]) < 0.05


def test_empty_table(spark):
    out = pii.digests(pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string")))
    assert out.collect() == [] and out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, n):
    frame = spark.createDataFrame([([list(range(n)), [3]],)], "sizes array<array<int>>")
    sums = pii.running_sums(frame, "sizes", "out").first().out
    assert sums == [[sum(range(i + 1)) for i in range(n)], [3]]
