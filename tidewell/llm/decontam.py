"""Benchmark decontamination by pigeonhole edit matching.

An item of ``n`` characters may differ from a passage by ``k = rate * n``
edits. Cut into ``k + 1`` pieces, at least one piece of a passage within that
budget is unchanged. All pieces of all items go into one Aho-Corasick
automaton; every exact piece hit names a window of the document, and
overlapping windows of an item are merged. In a window the exact passages are
taken first, from the left; between them Myers' bit-parallel distance finds
the others: behind the first end within the budget the best of those less than
an item's length away, and so on before and behind it. Passages of one item
do not overlap. Whole texts are read; nothing is shuffled.

Text and items are compared in lower case and with ASCII white space as
blanks, which keeps offsets; blanks in a row within an item are one.

The items are read in blocks of about ``block_chars`` characters, a block is
the only thing sent to the tasks, and each block is a pass over the
documents, so a benchmark of any size stays within bounds.

Defined results: null and empty texts have no match; items of null, empty or
blank text are ignored; items of a null id are reported with it; items shorter than two pieces must match exactly; repeated
items of different id are all reported, repeated rows of an item once, and
repeated documents each for itself. Extra columns are kept; an input column
called ``matches`` is replaced.
"""

from __future__ import annotations

import math
import pickle
import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_names

RATE = 0.08
MIN_PIECE = 8
BLOCK_CHARS = 2_000_000
MATCHES = "array<struct<item_id:bigint,start:int,end:int,edits:int>>"

def fold(text: str) -> str:
    """Lower case, ASCII white space as blanks; as many characters as before."""
    low = text.lower()
    if len(low) != len(text):  # some capitals become two characters: they stay
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    return low


def error_budget(n: int, rate: float = RATE, min_piece: int = MIN_PIECE) -> int:
    """Edits allowed for an item of ``n`` characters; its pieces keep ``min_piece`` or more."""
    return max(0, min(int(rate * n), n // min_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a substring of ``text``, and where the first such ends."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, dist, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        vertical = eq | minus
        eq |= (((eq & plus) + plus) ^ plus) & full
        up = minus | (full & ~(eq | plus))
        down = plus & eq
        if up & top:
            dist += 1
            if down & top:
                dist -= 1
        elif down & top:
            dist -= 1
            if dist < best:
                best, end = dist, j + 1
        up = up << 1 & full  # a match may begin anywhere: no carry into the first row
        down = down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return best, end


def near(pattern: str, text: str, k: int, reach: int) -> tuple[int, int, int] | None:
    """Edits and end of the best passage within ``k`` whose end is less than ``reach`` behind the first end; and that."""
    m = len(pattern)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, dist, best, end, first = full, 0, m, k + 1, 0, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        vertical = eq | minus
        eq |= (((eq & plus) + plus) ^ plus) & full
        up = minus | (full & ~(eq | plus))
        down = plus & eq
        if up & top:
            dist += 1
        elif down & top:
            dist -= 1
        if dist < best:
            best, end, first = dist, j + 1, first or j + 1
        if first and j + 1 >= first + reach:
            break
        up = up << 1 & full
        down = down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return (best, end, first) if first else None


def passages(item: str, text: str, k: int) -> list[tuple[int, int, int]]:
    """``(start, end, edits)`` of passages of ``item`` in ``text`` within ``k`` edits; none overlap."""
    out, gaps, a = [], [], 0
    while (at := text.find(item, a)) >= 0:
        out.append((at, at + len(item), 0))
        gaps.append((a, at))
        a = at + len(item)
    gaps.append((a, len(text)))
    while gaps and k:
        a, b = gaps.pop()
        if b - a < len(item) - k or not (hit := near(item, text[a:b], k, len(item))):
            continue
        edits, end, first = hit
        start = end - myers(item[::-1], text[max(a, a + end - len(item) - k):a + end][::-1])[1]
        out.append((a + start, a + end, edits))
        gaps.append((a + end, b))
        gaps.append((max(a, a + first - len(item) - k), a + start))  # nothing ends before the first
    return out


class Matcher:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_piece: int):
        self.items = [(i, t, error_budget(len(t), rate, min_piece)) for i, t in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.items):
            for offset, piece in pieces(text, k):
                owners.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, own in owners.items():
            self.automaton.add_word(piece, (len(piece), own))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the merged windows in which it may begin and end."""
        found: dict[int, list[list[int]]] = {}
        for last, (length, own) in self.automaton.iter(text):
            for n, offset in own:
                _, item, k = self.items[n]
                begin = last + 1 - length - offset - k
                found.setdefault(n, []).append([max(0, begin), begin + len(item) + 2 * k])
        for n, spans in found.items():
            if len(spans) > 1:
                spans.sort()
                merged = spans[:1]
                for a, b in spans[1:]:
                    if a < merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                found[n] = merged
        return found

    def matches(self, text: str | None) -> list[dict]:
        if not text or not self.items:
            return []
        text = fold(text)
        out = []
        for n, spans in self.windows(text).items():
            item_id, item, k = self.items[n]
            for a, b in spans:
                for start, end, edits in passages(item, text[a:b], k):
                    out.append({"item_id": item_id, "start": a + start, "end": a + end, "edits": edits})
        return sorted(out, key=lambda m: (m["start"], m["item_id"] is not None, m["item_id"] or 0))


@lru_cache(maxsize=2)
def _matcher(block: bytes) -> Matcher:
    return Matcher(*pickle.loads(block))


def _matches_of(block: bytes, text: Column) -> Column:
    @F.pandas_udf(MATCHES)
    def matches(texts: pd.Series) -> pd.Series:
        found = _matcher(block)
        return pd.Series([found.matches(t) for t in texts])

    return matches(text)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_chars: int = BLOCK_CHARS):
    """Folded items, block by block, each of about ``block_chars`` characters."""
    items = (benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                      .filter("text is not null and trim(text) != ''").distinct())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / block_chars))
    for i in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect() if chars else []
        folded = {(r["id"], re.sub(" +", " ", fold(r["text"])).strip()) for r in rows}
        yield sorted((x for x in folded if x[1]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = RATE,
                 min_piece: int = MIN_PIECE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``matches``: item, span in the text and edits of every benchmark passage."""
    columns = []
    for items in item_blocks(benchmark, block_chars=block_chars):
        columns.append(_matches_of(pickle.dumps((items, rate, min_piece)), F.col(text_col)))
    return docs.withColumn("matches", columns[0] if len(columns) == 1 else F.concat(*columns))


def find_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """A row for each passage: document, item, span and edits."""
    found = with_matches(docs.select(id_col, text_col), benchmark, text_col, **options)
    # the outer form: for the inner one the optimizer adds a filter that would compute the matches twice
    each = found.select(id_col, F.explode_outer("matches").alias("m")).filter("m is not null")
    return each.select(id_col, "m.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold a benchmark passage."""
    plain, at = own_names(docs)
    clean = with_matches(plain, benchmark, at[text_col], **options).filter(F.size("matches") == 0)
    return clean.select(*[F.col(n).alias(c) for c, n in at.items()])
