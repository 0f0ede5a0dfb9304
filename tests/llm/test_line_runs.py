"""Line deduplication of runs made of short units."""

import random

from tidewell.llm import linededup


def words(rng, n, end=""):
    return [rng.choice("bcdfgh") + "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) + end for _ in range(n)]


def short_sentences(rng):
    return ". ".join(" ".join(words(rng, 3)) for _ in range(20)) + "."


def shouted(rng):
    return " ".join(words(rng, 60, "!!"))


def listed(rng):
    return "\n".join("- " + " ".join(words(rng, 2)) for _ in range(30))


def deduped(spark, rows):
    return {r.doc_id: r for r in linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_repeated_runs_of_short_units_are_found(spark):
    rng = random.Random(5)
    rows, passages = [], {}
    for k, kind in enumerate([short_sentences, shouted, listed] * 3):
        passage = kind(rng)
        for i in (2 * k, 2 * k + 1):
            rows.append((i, " ".join(words(rng, 25)) + ".\n" + passage + "\n" + " ".join(words(rng, 25)) + "."))
        passages[2 * k + 1] = passage
    out = deduped(spark, rows)
    assert all(out[i - 1].removed_units == 0 for i in passages)
    for i, passage in passages.items():
        left = [w for w in passage.split() if w != "-" and w in out[i].text.split()]
        assert len(left) <= 15, (i, left)


def test_repeated_lines_of_few_units_are_found(spark):
    rng = random.Random(6)
    line = " ".join(w * 2 for w in words(rng, 9))
    unbroken = "".join(words(rng, 40))  # one word, as in scripts without spaces
    rows = [(2 * k + j, "\n".join([" ".join(words(rng, 12)) + ".", x, " ".join(words(rng, 12)) + "."]))
            for k, x in enumerate([line, unbroken]) for j in range(2)]
    out = deduped(spark, rows)
    assert len(line) > 80 and out[0].text == rows[0][1] and out[2].text == rows[2][1]
    assert line not in out[1].text and unbroken not in out[3].text
    assert out[1].removed_units == out[3].removed_units == 1


def test_no_copy_keeps_a_rest(spark):
    rng = random.Random(7)
    kinds = [short_sentences, shouted, listed, lambda r: " ".join(words(r, 30)) + "."]
    texts = ["\n".join(rng.choice(kinds)(rng) for _ in range(6)) for _ in range(12)]
    rows = [(100 * j + i, t) for i, t in enumerate(texts) for j in range(2)]
    out = deduped(spark, rows)
    assert all(out[i].text == t and out[100 + i].text == "" for i, t in enumerate(texts))


def test_runs_end_where_the_units_differ(spark):
    rng = random.Random(8)
    head, tail = " ".join(words(rng, 20)) + ".", " ".join(words(rng, 20)) + "."
    run, more = shouted(rng), " ".join(words(rng, 12, "!"))
    rows = [(0, f"{head}\n{run}\n{tail}"), (1, f"other start here.\n{run}\n{more}\nend of one."),
            (2, f"a third start.\n{run}\n{more}\nend of two.")]
    out = deduped(spark, rows)
    assert out[0].removed_units == 0
    assert out[1].text == f"other start here.\n{more}\nend of one."
    assert out[2].text == "a third start.\nend of two."  # more is shared with 1 alone
