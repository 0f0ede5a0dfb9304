r"""Ranked lexical search over document FP-trees.

A document becomes the vector of its terms that some item asks for, each with its frequency ``tf``. Terms are ordered by
the number of documents that hold them, most frequent first, so that vectors share the paths of a trie (an FP-tree).
Each node knows, for the documents beneath it, the greatest ``tf`` of every term and the least length factor ``m``. A
term's score rises with ``tf`` and falls with ``m``, so these bound what any document of the subtree can reach for an
item. For each item the tree is searched depth first, best child first; a subtree is left out when its bound is below
the kth score so far (or equals it and holds no smaller id). Documents of the leaves that remain are scored exactly.

The score is that of BM25 in integers: ``sum over the item's terms, repeats included, of
w * (10^9 tf div (1000 tf + 8 m))`` with ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))`` and
``m = 25 + (75 n N) div L``.

On Spark: one pass over the texts writes the restricted vectors; ``N``, ``L`` and ``df`` are aggregates of them. Each
task then builds trees of up to ``TREE_DOCS`` documents or ``TREE_POSTINGS`` terms from its own rows, and carries the
``k`` best of each item from one tree to the next; it sends out ``k`` rows an item, and a window over those gives the
ranks. No document is exchanged, so a frequent term, a hot source or a group of copies meets in no task: its documents
stay where they are read. Copies share a path, and among equal scores only smaller ids are looked at.

Items go in blocks of about ``BLOCK_CHARS`` characters. A block's terms and items are all that is sent to the tasks and
held by the driver; each block is a job of its own over the documents, and its result is written before the next begins.
A tree's branch of one child that keeps over nine tenths of its parent's documents is merged into the parent, and
subtrees of up to ``LEAF`` documents are leaves.

Defined results: a null text has no term and is no document of ``N``; nor is one without terms. Items of null text or
without terms have no result; a null ``item_id`` is reported as such; an item is a distinct pair of id and text, and
repeated rows of it count once. Repeated documents are ranked each for itself; a null id comes first among equal scores.
An empty table on either side gives an empty result. Whole texts are read, however long; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned

K = 10
BLOCK_CHARS = 2_000_000
TREE_DOCS = 8192
TREE_POSTINGS = 4_000_000
LEAF = 32
ALIKE = 0.9
NULL_ID = -(1 << 63)

#: Bytes of UTF-8: terms are runs of ASCII letters, digits and all that is not ASCII; only A-Z is lowered.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(id, n, terms, tfs)`` of ``docs(id, text)``: all terms counted, those of ``vocabulary`` with their frequency."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts, offsets, terms, tfs = [], [0], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = terms_of(text) if text else []
                counts.append(len(found))
                for term, tf in Counter(found).items():
                    at = vocabulary.get(term)
                    if at is not None:
                        terms.append(at)
                        tfs.append(tf)
                offsets.append(len(terms))
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], ["id", "n", "terms", "tfs"])

    return docs.mapInArrow(batches, "id long, n long, terms array<int>, tfs array<int>")


class Tree:
    """The FP-tree of some documents: ids, length factors, and their vectors (``rank`` is a term's place by frequency)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, offsets: np.ndarray, rank: np.ndarray, tf: np.ndarray):
        n = len(ids)
        sizes = np.diff(offsets)
        by = np.lexsort((rank, np.repeat(np.arange(n), sizes)))
        rank, tf = rank[by], tf[by]
        path = rank.astype(">u4").tobytes()  # as bytes, paths compare like their terms
        keys = [path[4 * a:4 * b] for a, b in zip(offsets, offsets[1:], strict=False)]
        order = np.array(sorted(range(n), key=keys.__getitem__))
        self.ids, self.m, sizes = ids[order], m[order], sizes[order]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(offsets[:-1][order] - self.offsets[:-1], sizes) + np.arange(len(rank))
        self.rank, self.tf, self.doc = rank[source], tf[source], np.repeat(np.arange(n), sizes)
        shared = [0] * n
        for i in range(1, n):
            a, b = keys[order[i - 1]], keys[order[i]]
            least = min(len(a), len(b))
            if a[:least] == b[:least]:
                shared[i] = least // 4
            else:
                x, y = np.frombuffer(a[:least], np.uint32), np.frombuffer(b[:least], np.uint32)
                shared[i] = int((x != y).argmax())
        self._nodes(shared)
        self._maxima()

    def _nodes(self, shared: list[int]) -> None:
        """Subtrees as ranges of documents: branches of the trie, and leaves of up to ``LEAF`` documents."""
        n, found, stack = len(self.ids), [(0, len(self.ids))], [(0, 0)]
        for i in range(1, n + 1):
            depth, begin = shared[i] if i < n else -1, i - 1
            while stack and stack[-1][0] > depth:
                begin = stack.pop()[1]
                if LEAF < i - begin < n:
                    found.append((begin, i))
            if depth >= 0 and (not stack or stack[-1][0] < depth):
                stack.append((depth, begin))
        found = sorted(set(found), key=lambda r: (r[0], -r[1]))
        ranges, kids, level, inner, open_ = [found[0]], [[]], [0], [True], [0]

        def add(begin: int, end: int, parent: int, branch: bool) -> int:
            ranges.append((begin, end))
            kids.append([])
            level.append(level[parent] + 1)
            inner.append(branch)
            kids[parent].append(len(ranges) - 1)
            return len(ranges) - 1

        for begin, end in found[1:]:
            while ranges[open_[-1]][1] <= begin:
                open_.pop()
            parent = open_[-1]
            if end - begin <= ALIKE * (ranges[parent][1] - ranges[parent][0]):
                open_.append(add(begin, end, parent, True))
        for v in range(len(ranges)):
            at, end = ranges[v]
            for begin, stop in [*sorted(ranges[c] for c in kids[v]), (end, end)]:
                for a in range(at, begin, LEAF):
                    add(a, min(a + LEAF, begin), v, False)
                at = stop
        self.ranges, self.inner, self.level = ranges, inner, np.array(level)
        self.kids = [np.array(k) for k in kids]
        self.least_m = np.array([self.m[a:b].min() for a, b in ranges])
        self.least_id = [int(self.ids[a:b].min()) for a, b in ranges]

    def _maxima(self) -> None:
        """The greatest frequency of each term beneath each node, by term."""
        by = np.argsort(self.rank, kind="stable")  # by term, then document: nodes of one level come in order
        rank, doc, tf = self.rank[by], self.doc[by], self.tf[by]
        parts = []
        for depth in range(1, int(self.level.max()) + 1):
            above = np.full(len(self.ids), -1)
            for v in np.flatnonzero(self.level == depth):
                above[self.ranges[v][0]:self.ranges[v][1]] = v
            node = above[doc]
            here = node >= 0
            t, v, f = rank[here], node[here], tf[here]
            if not len(t):
                continue
            first = np.concatenate([[0], np.flatnonzero((t[1:] != t[:-1]) | (v[1:] != v[:-1])) + 1])
            parts.append((t[first], v[first], np.maximum.reduceat(f, first)))
        t, v, f = (np.concatenate([p[i] for p in parts]) for i in range(3))
        by = np.argsort(t, kind="stable")
        self.max_term, self.max_node, self.max_tf = t[by], v[by], f[by]

    def search(self, terms: np.ndarray, weights: np.ndarray, slot: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
        """Merges this tree's documents into ``best``, the ``k`` least of ``(-score, id)``; returns the documents scored.

        ``terms`` are ranks, ``weights`` their weights times their repeats; ``slot`` is an array of -1 for all ranks.
        """
        a, b = np.searchsorted(self.max_term, terms), np.searchsorted(self.max_term, terms, "right")
        there = np.flatnonzero(b > a)
        if not len(there):
            return 0
        maxima = np.zeros((len(there), len(self.ranges)), np.int64)
        for j, i in enumerate(there):
            maxima[j, self.max_node[a[i]:b[i]]] = self.max_tf[a[i]:b[i]]
        terms, weights, scored = terms[there], weights[there], 0
        slot[terms] = np.arange(len(terms))
        stack = [(1 << 62, 0)]
        while stack:
            bound, v = stack.pop()
            if len(best) == k and (-bound, self.least_id[v]) >= best[-1]:
                continue
            if self.inner[v]:
                kids = self.kids[v]
                tf = maxima[:, kids]
                bounds = weights @ (1_000_000_000 * tf // (1000 * tf + 8 * self.least_m[kids]))
                for i in np.argsort(bounds):
                    if bounds[i] > 0:
                        stack.append((int(bounds[i]), int(kids[i])))
                continue
            begin, end = self.ranges[v]
            part = slice(self.offsets[begin], self.offsets[end])
            at = slot[self.rank[part]]
            here = np.flatnonzero(at >= 0)
            tf, doc = self.tf[part][here], self.doc[part][here]
            scores = np.zeros(end - begin, np.int64)
            np.add.at(scores, doc - begin, weights[at[here]] * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[doc])))
            scored += end - begin
            least = -best[-1][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= max(1, least)):
                best.append((-int(scores[i]), int(self.ids[begin + i])))
            best.sort()
            del best[k:]
        slot[terms] = -1
        return scored


def trees(batch: pa.RecordBatch, n_docs: int, length: int, rank: np.ndarray) -> Iterator[Tree]:
    """The trees of a batch of ``(id, n, terms, tfs)``, each of bounded size."""
    ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
    m = 25 + 75 * batch.column(1).to_numpy() * n_docs // length
    offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
    terms = rank[batch.column(2).values.to_numpy()]
    tf = batch.column(3).values.to_numpy().astype(np.int64)
    a = 0
    while a < len(ids):
        b = int(np.searchsorted(offsets, offsets[a] + TREE_POSTINGS, "right")) - 1
        b = min(len(ids), max(a + 1, min(b, a + TREE_DOCS)))
        p, q = offsets[a], offsets[b]
        yield Tree(ids[a:b], m[a:b], offsets[a:b + 1] - p, terms[p:q], tf[p:q])
        a = b


def best_of_tasks(vectors: DataFrame, items: list[tuple[int | None, list[tuple[int, int]]]], n_docs: int, length: int,
                  dfs: list[int], k: int) -> DataFrame:
    """``(item, item_id, id, score)``: the ``k`` best documents of each item in each task. Items: id, (term, repeats)."""
    order = sorted(range(len(dfs)), key=lambda t: -dfs[t])
    rank = np.empty(len(dfs), np.int64)
    rank[order] = np.arange(len(dfs))
    w = np.array([weight(n_docs, df) for df in dfs], np.int64)
    asked = [(rank[[t for t, _ in own]], w[[t for t, _ in own]] * np.array([r for _, r in own], np.int64)) for _, own in items]
    names = [i for i, _ in items]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        slot = np.full(len(rank), -1)
        for batch in rows:
            for tree in trees(batch, n_docs, length, rank) if batch.num_rows else ():
                for own, (terms, weights) in zip(best, asked, strict=True):
                    tree.search(terms, weights, slot, own, k)
        flat = [(i, names[i], None if d == NULL_ID else d, -s) for i, own in enumerate(best) for s, d in own]
        for a in range(0, len(flat), 10_000):
            part = list(zip(*flat[a:a + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], ["item", "item_id", "id", "score"])

    return vectors.mapInArrow(batches, "item long, item_id long, id long, score long")


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items and their terms with repeats, block by block, each of about ``block_chars`` characters."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    n = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars
    for i in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect()
        found = [(r["id"], Counter(terms_of(r["text"].encode()))) for r in rows]
        if found := [(i, c) for i, c in found if c]:
            yield found


def ranked_search(docs: DataFrame, benchmark: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(item_col, rank, id_col, score)``: for each item its ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = None
    for number, block in enumerate(item_blocks(benchmark, item_col, item_text, block_chars)):
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in block for t in c}))}
        vectors = pinned(restricted(narrow, vocabulary), "lexical-vectors")
        n_docs, length = vectors.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        dfs = [0] * len(vocabulary)
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            dfs[r["t"]] = r["df"]
        items = [(i, [(vocabulary[t], c) for t, c in own.items()]) for i, own in block]
        best = best_of_tasks(vectors.filter(F.size("terms") > 0), items, n_docs, length, dfs, k)
        best = pinned(best.withColumn("block", F.lit(number)), "lexical-best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], f"`{item_col}` long, rank int, `{id_col}` long, score long")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                 .select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
