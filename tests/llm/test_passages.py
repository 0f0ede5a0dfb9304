"""Every passage of a benchmark item is reported."""

from tidewell.llm import decontam

ITEM = "the harbour seal rests on warm rocks while the tide runs out across the wide and silent bay"


def found(text, items=((1, ITEM),)):
    return [(m["item_id"], m["start"], m["end"], m["edits"]) for m in decontam.Matcher(list(items), 0.08, 8).matches(text)]


def test_items_back_to_back_and_edited_copies_beside_exact_ones():
    n, edited = len(ITEM), ITEM.replace("warm", "cold").replace("wide", "wi#e")
    assert found(f"see {ITEM}") == [(1, 4, 4 + n, 0)]
    assert found(ITEM * 5) == [(1, i * n, (i + 1) * n, 0) for i in range(5)]
    assert found(" ".join([ITEM] * 3)) == [(1, i * (n + 1), i * (n + 1) + n, 0) for i in range(3)]
    edits = decontam.myers(ITEM, edited)[0]
    assert 0 < edits <= decontam.error_budget(n)
    texts = [edited, ITEM, edited, edited, ITEM]
    got = found(" ".join(texts))
    assert [g[3] for g in got] == [0 if t == ITEM else edits for t in texts]
    assert all(a[2] <= b[1] for a, b in zip(got, got[1:], strict=False))
    assert [g[1] for g in got] == [i * (n + 1) for i in range(5)]
    assert len(found(edited * 200)) == 200
