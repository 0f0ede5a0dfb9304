"""The prefix trie against a trie of dictionaries, in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidewell.llm import prefixtrie


def slow_rebuilt(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    base = lambda c: c - (abs(c) % 100) * (1 if c >= 0 else -1)
    return {c: own.get(base(c), [])[:heads[c]] + v[heads[c]:] for c, v in own.items()}


def slow_trie(sequences):
    members = {}
    for c, v in sequences.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids, out = {}, []
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    totals = {}
    for key in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(key, [])]
        saved = (len(members[key]) - 1) * len(key[-1][1]) if key else 0
        totals[key] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    for key, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(key))
        out.append((min(own), len(key), min(members[key[:-1]]) if key else None, len(own), len(kids.get(key, [])), *totals[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def conversations(seed, longest, ids):
    rng = random.Random(seed)
    texts = ["", None, "a", "é\U0001f600", "long " * 40, "a\nb"]
    rows = []
    for c in ids:
        if rng.random() < 0.3 and rows:
            like = rng.choice(rows)[0]
            rows += [(c, *r[1:]) for r in rows if r[0] == like]
        else:
            rows += [(c, t if t or rng.random() < 0.5 else None, rng.choice(["user", "assistant", None]), rng.choice(texts))
                     for t in range(rng.randint(1, longest))]
    return rows


CASES = {"usual": (1, 8, range(0, 500, 3)), "single turns": (2, 1, range(40)), "long": (3, 37, range(95, 120)),
         "negative": (4, 5, range(-250, 250, 7)), "one": (5, 6, [300])}


@pytest.mark.parametrize("case", CASES)
def test_against_dictionaries(spark, case):
    rows = conversations(*CASES[case])
    rng = random.Random(9)
    rows += [(None, 1, "user", "nobody's"), rows[0], rows[-1]]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("conv", "d", "x", "place", "part", "n", "w")})
    lengths, turns = prefixtrie.rebuilt(prefixtrie.numbered_turns(frame))
    got = prefixtrie.prefix_trie(lengths, turns).collect()
    assert sorted(str(tuple(r)) for r in got) == slow_trie(slow_rebuilt(rows))


def test_conversations_as_they_are(spark):
    rows = conversations(11, 9, range(60))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefixtrie.prefix_trie(*prefixtrie.plain(prefixtrie.numbered_turns(frame))).collect()
    own = {}
    for c, t, role, text in rows:
        own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert sorted(str(tuple(r)) for r in got) == slow_trie({c: [x[2:] for x in sorted(v)] for c, v in own.items()})


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = prefixtrie.prefix_trie(*prefixtrie.rebuilt(prefixtrie.numbered_turns(frame)))
    assert out.collect() == [] and "ends_sha256" in out.columns


def test_long_list_of_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE_CHARS", 50)
    ends = spark.createDataFrame([(i * 3, 5, 2) for i in range(1000)] + [(1, 7, 2)], "member long, conv long, depth long").repartition(4)
    got = {(r.conv, r.depth): r.ends_sha256 for r in prefixtrie.end_digests(ends).collect()}
    assert got == {(5, 2): hashlib.sha256(",".join(str(i * 3) for i in range(1000)).encode()).hexdigest(),
                   (7, 2): hashlib.sha256(b"1").hexdigest()}
