"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors become integers, ``floor(scale * x)`` for each component, and are cut
into blocks of bounded size; a block keeps, for every dimension, its rows
sorted by that component. A block of queries meets a block of candidates in
one step of the threshold algorithm:

* sorted access: of every dimension's list the next rows are read, from the
  top for queries with a positive component, from the bottom for negative;
* random access: rows seen for the first time get their whole score, for all
  queries that are still open at once;
* stop: no unseen row can score more than the sum of the query's components
  times the lists' current values. A query is closed when that bound is below
  its kth score (an equal score may still win by its smaller id).

The kth score is carried from one candidate block to the next within a part
of the candidates, so later blocks start with a high threshold. A part sends
out ``k`` places for each query, packed by query block; those are merged block
by block, and a window over what is left gives the ranks.

The work is that of a stated query set against all rows, in blocks. Candidate
blocks are put into parts of up to ``PART_BYTES`` (smaller ones while there
are fewer than ``TASKS`` tasks a core), query blocks likewise with their
places, and every part of the queries meets every part of the candidates in
a task of its own: a block is copied once for each part of the other side, not
for each of its blocks. Both sides are dealt out by a number and cogrouped;
there is no join, so nothing is broadcast whatever the threshold, and neither
side is ever collected.

Scores are exact: blocks are multiplied in float32 while every partial sum
stays below 2**24, in float64 below 2**53, and with Python integers beyond
that.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, neither as query nor as candidate; nor do rows with
a null id. A query's candidates are all rows with another id, of the query's
length. Rows repeated with the same id and vector count once; the same id
with different vectors is as many candidates and queries, of which an id
keeps its best score for a query id. Fewer than ``k`` candidates: all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F

from .common import computed, pinned

K = 20
SCALE = 64
CANDIDATES = 4096
QUERIES = 4096
SLICE = 512
PART_BYTES = 32 * 2 ** 20
TASKS = 3
EXACT = {np.dtype(np.float32): 2 ** 24, np.dtype(np.float64): 2 ** 53}


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Integer components (doubles without fraction), or null for vectors that take no part."""
    x = vector.cast("array<double>")
    odd = [F.array_contains(x, F.lit(float(v))) for v in ("nan", "inf", "-inf")]  # null where a component is null
    return F.when(~odd[0] & ~odd[1] & ~odd[2] & (F.size(x) > 0), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _as_blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """``(block, dim, ids, kind, data)`` with up to about ``rows`` vectors each; ids and data are raw bytes."""
    n = max(1, -(-vectors.count() // rows))

    def packed(group: pa.Table) -> pa.Table:
        ids = group["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        data = group["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order]
        kind = next(t for t in (np.dtype(x) for x in ("int8", "int16", "int32", "int64"))
                    if np.iinfo(t).min <= data.min() and data.max() <= np.iinfo(t).max)
        return pa.table({"block": group["b"][:1], "dim": group["dim"][:1], "ids": [ids[order].tobytes()], "kind": [kind.str],
                         "data": [data.astype(kind).tobytes()]})

    dealt = vectors.withColumn("b", F.pmod(F.xxhash64("id", "v"), F.lit(n))).withColumn("dim", F.size("v"))
    return dealt.groupBy("b", "dim").applyInArrow(packed, "block long, dim int, ids binary, kind string, data binary")


def _unpacked(blocks: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Number, ids and rows of each block, in the order of their numbers."""
    return [(x["block"], np.frombuffer(x["ids"], dtype=np.int64),
             np.frombuffer(x["data"], dtype=x["kind"]).reshape(-1, x["dim"])) for x in blocks.sort_by("block").to_pylist()]


def _largest(rows: np.ndarray) -> int:
    return max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))


def _ordered(*keys: np.ndarray) -> np.ndarray:
    """``np.lexsort``, with the keys packed into one number where that fits."""
    packed, span = np.zeros(len(keys[0]), dtype=np.int64), 1
    for key in keys:
        low, width = int(key.min(initial=0)), int(key.max(initial=0)) - int(key.min(initial=0)) + 1
        if span * width >= 2 ** 63:
            return np.lexsort(keys)
        packed += (key - low) * span
        span *= width
    return np.argsort(packed, kind="stable")


class Candidates:
    """A block of vectors with its sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable")[::-1]  # a list of row numbers for each dimension
        self.lists = np.take_along_axis(rows, self.order, axis=0)
        self.largest = _largest(rows)

    def kind(self, queries: np.ndarray) -> np.dtype:
        """The smallest type in which every partial sum of a score is exact."""
        most = self.largest * _largest(queries) * queries.shape[1]
        return next((t for t, limit in EXACT.items() if most < limit), np.dtype(object))


class Best:
    """The k best candidates of each query so far: larger scores first, then smaller ids.

    ``several``: an id can come in more than one block.
    """

    def __init__(self, ids: np.ndarray, k: int, several: bool = True):
        self.ids, self.k, self.several = ids, k, several
        self.held = np.zeros(len(ids), dtype=np.int64)  # how many of the k places are taken
        self.scores, self.who = (np.zeros((len(ids), k), dtype=np.int64) for _ in range(2))

    @property
    def found(self) -> list[list[tuple[int, int]]]:
        """``(-score, candidate)`` of each query."""
        return [[(-s, c) for s, c in zip(scores[:n].tolist(), who[:n].tolist(), strict=True)]
                for n, scores, who in zip(self.held.tolist(), self.scores, self.who, strict=True)]

    def kth(self, which: np.ndarray) -> np.ndarray:
        """The kth score of these queries, or minus infinity where there are fewer."""
        least = np.full(len(which), -np.inf, dtype=object if self.scores.dtype == object else np.float64)
        full = self.held[which] == self.k
        least[full] = self.scores[which[full], self.k - 1]
        return least

    def add(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of these candidates (columns) for the queries ``which`` (rows): whole floats or Python integers."""
        if (np.diff(ids) <= 0).any():
            order = np.argsort(ids, kind="stable")
            starts = np.nonzero(np.diff(ids[order], prepend=ids[order[:1]] - 1))[0]
            ids, scores = ids[order[starts]], np.maximum.reduceat(scores[:, order], starts, axis=1)
        with np.errstate(over="ignore"):  # a kth score beyond the type is beyond all of these scores
            least = self.kth(which).astype(scores.dtype)
        open_ = self.held[which] < self.k
        first = 16 * self.k
        if open_.any() and len(ids) > 2 * first:  # a few give a kth score, which spares most of the others
            self.add(which, ids[:first], scores[:, :first])
            return self.add(which, ids[first:], scores[:, first:])
        if open_.any() and len(ids) > self.k + 1 and scores.dtype != object:  # one more, which may be the query itself
            least[open_] = np.partition(scores[open_], len(ids) - self.k - 1, axis=1)[:, len(ids) - self.k - 1]
        near = np.flatnonzero(scores >= least[:, None])
        row, column = np.divmod(near, len(ids))
        who, score = ids[column], scores[row, column]
        fits = (who != self.ids[which[row]]) & (open_[row] | (score > least[row]) | (who < self.who[which[row], self.k - 1]))
        if fits.any():
            self.merge(which[row[fits]], who[fits], score[fits])

    def merge(self, at: np.ndarray, who: np.ndarray, scores: np.ndarray) -> None:
        """Takes in single scores of the queries numbered ``at``."""
        if scores.dtype == object:
            self.scores = self.scores.astype(object)
        some = np.unique(at)
        at = np.concatenate([np.repeat(some, self.held[some]), at])
        who = np.concatenate([self.who[some][self.taken(some)], who])
        scores = np.concatenate([self.scores[some][self.taken(some)], scores.astype(self.scores.dtype)])
        rank = np.unique(-scores, return_inverse=True)[1] if scores.dtype == object else ~scores
        if self.several:
            order = _ordered(rank, who, at)
            order = order[(np.diff(at[order], prepend=-1) != 0) | (np.diff(who[order], prepend=0) != 0)]
            at, who, scores, rank = at[order], who[order], scores[order], rank[order]
        order = _ordered(who, rank, at)
        at, who, scores = at[order], who[order], scores[order]
        starts = np.searchsorted(at, some)
        counts = np.diff(starts, append=len(at))
        place = np.arange(len(at)) - np.repeat(starts, counts)
        keep = place < self.k
        self.scores[at[keep], place[keep]], self.who[at[keep], place[keep]] = scores[keep], who[keep]
        self.held[some] = np.minimum(counts, self.k)

    def taken(self, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.arange(self.k) < self.held[which][:, None]


def threshold_search(block: Candidates, queries: np.ndarray, best: Best, depth: int = 64) -> int:
    """Runs the threshold algorithm of all ``queries`` over one block; returns the rows scored."""
    n, kind = len(block.ids), block.kind(queries)
    unseen, scored, at = np.ones(n, dtype=bool), 0, 0
    open_ = np.arange(len(queries))
    queries, every = queries.astype(kind), block.rows.astype(kind)
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    while len(open_) and at < n:
        upto = min(n, at + depth)
        new = np.zeros(n, dtype=bool)
        new[block.order[at:upto]] = new[block.order[n - upto:n - at]] = True
        new = np.flatnonzero(new & unseen)
        if len(new):
            unseen[new] = False
            scored += len(new)
            ids, rows = block.ids[new], every[new].T
            for some in np.split(open_, range(SLICE, len(open_), SLICE)):
                best.add(some, ids, queries[some] @ rows)
        at, depth = upto, depth * 4
        if scored == n:
            break
        bound = positive[open_] @ block.lists[at - 1].astype(kind) + negative[open_] @ block.lists[n - at].astype(kind)
        open_ = open_[bound >= best.kth(open_)]
    return scored


FOUND = "q long, dim int, ids binary, held binary, who binary, scores binary"


def _searched(asked: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """For each block of queries its best of some blocks of candidates, as raw bytes."""
    rows = []
    for dim in sorted({*asked["dim"].to_pylist()} & {*blocks["dim"].to_pylist()}):
        queries, candidates = (_unpacked(t.filter(pc.field("dim") == dim)) for t in (asked, blocks))
        every = np.concatenate([ids for _, ids, _ in candidates])
        names = np.unique(np.concatenate([every, *(ids for _, ids, _ in queries)]))  # ids are numbered, in their order
        bests = [Best(np.searchsorted(names, ids), k, len(np.unique(every)) < len(every)) for _, ids, _ in queries]
        for _, ids, vectors in candidates:
            block = Candidates(np.searchsorted(names, ids), vectors)
            for best, (*_, own) in zip(bests, queries, strict=True):
                threshold_search(block, own, best)
        rows += [(q, dim, ids, best.held, names[best.who[best.taken()]], best.scores[best.taken()].astype(np.int64))
                 for best, (q, ids, _) in zip(bests, queries, strict=True)]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.table([pa.array([x.tobytes() if isinstance(x, np.ndarray) else x for x in column], kind)
                     for column, kind in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])


def _merged(found: pa.Table, k: int) -> pa.Table:
    """The best of all candidates for one block of queries."""
    best = None
    for part in found.to_pylist():
        ids, held, who, scores = (np.frombuffer(part[x], dtype=np.int64) for x in ("ids", "held", "who", "scores"))
        best = best or Best(ids, k)
        best.merge(np.repeat(np.arange(len(ids)), held), who, scores)
    return pa.table([np.repeat(best.ids, best.held), best.who[best.taken()], best.scores[best.taken()]],
                    names=["query_id", "vec_id", "score"])


def _slot(spark: SparkSession, place: Column, n: int) -> Column:
    """For each place from 0 to ``n - 1`` a number; ``repartition`` deals those to ``n`` partitions, one to each."""
    numbers, dealt = 0, []
    while len(dealt) < n:
        numbers = 2 * numbers or 32 * n
        dealt = (spark.range(numbers).groupBy(F.pmod(F.hash("id"), F.lit(n)))
                      .agg(F.min("id").alias("id")).collect())
    slots = F.lit(sorted(r.id for r in dealt)).cast("array<long>")
    return F.element_at(slots, (place + 1).cast("int"))


def _parts(blocks: DataFrame, more: int = 0) -> tuple[int, int]:
    """How many blocks there are, and the fewest parts of up to about ``PART_BYTES``; a row takes ``more`` bytes besides."""
    n, size = blocks.agg(F.max("block") + 1, F.max(F.length("data") + F.length("ids").cast("long") * (1 + more // 8))).first()
    return n or 1, -(-(n or 1) // max(1, PART_BYTES // (size or 1)))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE, block_rows: int = CANDIDATES, query_rows: int = QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best other rows of every row that ``is_query`` holds for.

    ``is_query`` is a condition on a column named ``id``.
    """
    spark = vectors.sparkSession
    whole = pinned(computed(vectors, F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v"))
                   .filter("id is not null and v is not null").distinct(), "vectors")
    blocks = pinned(_as_blocks(whole, block_rows), "candidate-blocks")
    queries = pinned(_as_blocks(whole.filter(is_query), query_rows), "query-blocks")
    _, query_parts = _parts(queries, 16 * k)
    n, parts = _parts(blocks)
    parts = max(parts, min(n, -(-TASKS * spark.sparkContext.defaultParallelism // query_parts)))
    slot = _slot(spark, F.col("part") * query_parts + F.col("query_part"), parts * query_parts)

    def dealt(side: DataFrame, own: str, own_parts: int, other: str, other_parts: int) -> GroupedData:
        every = F.sequence(F.lit(0), F.lit(other_parts - 1)).cast("array<long>")
        copies = side.select("*", (F.col("block") % own_parts).alias(own), F.explode(every).alias(other))
        return copies.select(*side.columns, slot.alias("slot")).repartition(parts * query_parts, "slot").groupBy("slot")

    found = (dealt(queries, "query_part", query_parts, "part", parts)
             .cogroup(dealt(blocks, "part", parts, "query_part", query_parts))
             .applyInArrow(lambda asked, rows: _searched(asked, rows, k), FOUND))
    each = (found.groupBy("q", "dim")
                 .applyInArrow(lambda group: _merged(group, k), "query_id long, vec_id long, score long")
                 .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
