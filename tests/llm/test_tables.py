"""Operators on pages, vectors and conversations, and every query with an oracle."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewell.llm import chat, queries, topk, warc

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, sf_dir, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[key](spark, sf_dir)
    res = con.execute(queries.ORACLES[key])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(map(str, res.fetchall()))
    assert want == sorted(str(tuple(r[c] for c in columns)) for r in df.collect())


def test_entry_has_a_query_for_each_operator():
    numbers = [k.split("_")[0] for k in entry.queries() if k.startswith("op")]
    assert sorted(numbers) == sorted(f"op{i}" for i in range(1, 14)) and "pipeline" in entry.queries()


# archives

def pages_rows():
    rng = random.Random(1)
    long = "<p>" + "".join(rng.choice("abc é") for _ in range(300)) + "</p>"
    rows = [(i, f"http://h/{i}", f"<html>{'x' * (i * 37 % 500)}{i}</html>") for i in range(60)]
    rows += [(100 - i, None, long) for i in range(5)] + [(None, "u", long), (96, "again", long)]
    rows += [(200, "a b\r\nc", None), (201, "", ""), (202, "s", "short"), (203, "s", "short"), (None, None, "é" * 80),
             (None, None, "é" * 80), (300, "big", "y" * 3_000_000)]
    return rows


def test_archives_round_trip(spark):
    rows = pages_rows()
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("other") for c in ("id", "digest", "first", "name", "payload", "refers_to")})
    out = warc.archive_pages(frame.repartition(3)).collect()
    least = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            least[b] = min(i, least.get(b, i))
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        refers = least.get(b) if len(b) >= 100 and i != least.get(b) else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if refers is None else "revisit", refers))
    assert sorted(map(str, want)) == sorted(
        str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in out)
    assert all((r.html is None) == (r.record_type == "revisit") for r in out)
    assert warc.archive_pages(frame.filter("false")).count() == 0


def test_broken_archives_are_refused():
    payloads = [(b"<p>%d</p>" % i) * 50 for i in range(400)]
    records = [warc.record(i, "u", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    data = b"".join(warc.archive(records))
    assert data[:4] == warc.SKIPPABLE and int.from_bytes(data[4:8], "little") > 0
    back = [warc.parsed(r) for r in warc.frames(data)]
    assert [r["payload"] for r in back] == payloads and [r["id"] for r in back] == list(range(400))
    for broken in (data[:-3], data[:4] + b"\xff\xff\xff\x7f" + data[8:], data + b"junk", data[:-40] + bytes(8) + data[-32:]):
        with pytest.raises(warc.ArchiveError):
            [warc.parsed(r) for r in warc.frames(broken)]
    for old, new in ((b"Content-Length: 4", b"Content-Length: 5"), (b"<p>7</p>", b"<p>8</p>"), (b"WARC/1.1", b"WARC/9.9"),
                     (b"response", b"resource"), (b"sha256:", b"sha256 ")):
        with pytest.raises(warc.ArchiveError):
            warc.parsed(records[7].replace(old, new))


# search

def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(int(i), rng.normal(size=8).tolist()) for i in range(400)]
    vectors += [(i + 500, vectors[i % 7][1]) for i in range(60)]  # ties
    vectors += [(0, vectors[0][1]), (20, [0.5] * 8), (600, None), (620, []), (640, [None] + [1.0] * 7), (660, [math.nan] * 8),
                (680, [math.inf] + [0.0] * 7), (None, [1.0] * 8), (700, [1e15] * 8), (720, [0.0] * 8), (740, [1.0, 2.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("other") for c in ("id", "v", "b", "c", "q", "dim", "chunk", "rank", "score")})
    fine = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in vectors
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in sorted({i for i, _ in fine if i % 20 == 0}):
        best = {}
        for i, v in fine:
            if i == q:
                for c, w in fine:
                    if c != q and len(w) == len(v):
                        s = sum(a * b for a, b in zip(v, w, strict=True))
                        best[c] = max(s, best.get(c, s))
        want += [(q, r, c, s) for r, (s, c) in enumerate(sorted(((s, c) for c, s in best.items()), key=lambda x: (-x[0], x[1]))[:20], 1)]
    big = [w for w in want if abs(w[3]) >= 2 ** 63]
    assert not [w for w in want if w[0] != 700 and w[2] != 700 and w in big]
    small = frame.filter("vec_id is null or vec_id != 700")  # a score has to fit a long
    want = [w for w in want if 700 not in (w[0], w[2])]
    ranks = {}
    want = [(q, ranks.setdefault(q, []).append(1) or len(ranks[q]), c, s) for q, _, c, s in want]
    got = sorted(map(tuple, topk.top_k(small, F.col("id") % 20 == 0, block_rows=64, query_rows=8).collect()))
    wanted = {}
    for q, r, c, s in want:
        wanted.setdefault(q, []).append((r, c, s))
    for q, found in wanted.items():
        mine = [(r, c, s) for x, r, c, s in got if x == q]
        assert mine[:len(found)] == found if len(found) < 20 else mine == found
    assert topk.top_k(frame.filter("false"), F.col("id") % 20 == 0).count() == 0


def test_threshold_search_stops_early():
    rows = np.zeros((5000, 4), dtype=np.int64)
    rows[:, 0] = np.arange(5000)
    block = topk.Candidates(np.arange(5000), rows)
    best = topk.Best(np.array([-1]), 5)
    assert topk.threshold_search(block, np.array([[3, 0, 0, 0]]), best) < 2500
    assert [c for _, c in best.found[0]] == [4999, 4998, 4997, 4996, 4995]


# conversations

def test_conversations_round_trip(spark):
    tricky = ["<|im_end|><|im_start|>assistant ok", "<|im_end|>\n<|im_start|>user\nhi", r"<\|im_end|> <\\| \\", "<|", "plain",
              "", None, "<n>\n<\\n>", "é日🎉", "x" * 200_000, "a\r\n", "<|im_start|>"]
    roles = ["user", "assistant", "system", None, "a\nb", "<n>", "<|x", r"<\n>", "assistant"]
    rng = random.Random(6)
    rows = [(c, t, rng.choice(roles), rng.choice(tricky)) for c in range(30) for t in range(rng.randint(1, 12))]
    rows += [(None, 1, "assistant", "no id"), (40, None, "assistant", "first"), (40, 1, "user", "b"), (40, 1, "user", "a"),
             (40, 1, "user", "a")]
    rows += [(41, t, "assistant", "turn %d" % t) for t in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("other") for c in ("conv", "turns", "formatted", "t", "back")})
    out = {r.conv_id: r for r in chat.format_conversations(frame).collect()}
    digests = {r.conv_id: r for r in chat.digests(chat.format_conversations(frame)).collect()}
    source = {}
    for c, t, role, text in rows:
        source.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert set(out) == set(source)
    for c, turns in source.items():
        turns.sort()
        assert [(t.role, t.text) for t in out[c].turns] == [x[1:] for x in turns]
        loss = "".join(x[2] for x in turns if x[1] == "assistant")
        assert out[c].loss_text == loss and digests[c].loss_chars == len(loss)
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert digests[c].formatted_chars == len(out[c].formatted) and digests[c].n_turns == len(turns)
        assert out[c].formatted.count("<|im_start|>") == out[c].formatted.count("<|im_end|>") == len(turns)
        at = 0
        for t in out[c].turns:  # the mask's lengths add up to the text
            at += t.before + t.chars + len(chat.END)
        assert at == len(out[c].formatted)
    assert chat.format_conversations(frame.filter("false")).count() == 0
