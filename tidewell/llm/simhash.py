"""SimHash near-duplicates found with deletion-variant signatures.

A text's fingerprint has 64 bits, each the majority of that bit over the
hashes of its word shingles. To find fingerprints at most ``max_bits`` apart,
the 64 bits are cut into ``max_bits // 2 + 1`` segments, fewer than plain
pigeonholing needs: if all of them differed in two bits or more, the whole
would differ in more than ``max_bits``, so one segment differs in one bit at
most. Each distinct fingerprint is therefore indexed by every segment with
one bit left out (64 variants in all); fingerprints meet by an equality join
on the variant and are verified by counting differing bits.

Rows of one variant are sorted next to each other and compared with NumPy; a
task sends out links to a local root only, never all pairs. A variant with
more than ``bucket_rows`` fingerprints is cut into blocks, and every pair of
blocks is a group of its own, so no task holds more than twice that number.
Exact copies share a fingerprint and never meet in this step.

Defined results: null and empty texts, and texts without words, have
fingerprint zero, which links like any other; a text with fewer words than a
shingle is one shingle. Null ids never become a component's id unless all of
its ids are null. Repeated rows are returned as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cluster import _local_min_labels, connected_components
from .common import own_names, pinned

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BUCKET_ROWS = 4096
HELD_LINKS = 500_000


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of a whole text."""
    words = text.encode("utf-8").lower().split() if text else []  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist(), strict=False)])
    n, counts = len(hashes) // 8, np.zeros(64, dtype=np.int64)
    raw = np.frombuffer(hashes, dtype=np.uint8)
    for i in range(0, n, 65280):  # 255 rows add up without overflow in a byte
        bits = np.unpackbits(raw[8 * i:8 * (i + 65280)]).reshape(-1, 64)
        whole = len(bits) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fp",
                     shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle_words) for t in texts], dtype=np.int64)

    return docs.withColumn(out, fingerprints(F.col(text_col)))


def variant_masks(max_bits: int) -> list[int]:
    """For each bit, the mask of its segment without that bit (signed)."""
    cuts = np.linspace(0, 64, max_bits // 2 + 2).astype(int).tolist()
    masks = [((1 << b) - (1 << a)) & ~(1 << bit) for a, b in zip(cuts, cuts[1:], strict=False) for bit in range(a, b)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _links_within(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``max_bits`` in each group of a sorted run of rows."""
    ends_u, ends_v, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    alive, shift = np.arange(len(fp)), 1
    while True:
        alive = alive[alive + shift < len(fp)]
        alive = alive[group[alive] == group[alive + shift]]
        if not len(alive):
            break
        apart = (fp[alive] ^ fp[alive + shift]).view(np.uint64)  # of signed numbers NumPy counts the absolute value's bits
        near = alive[np.bitwise_count(apart) <= max_bits]
        ends_u.append(fp[near])
        ends_v.append(fp[near + shift])
        held, shift = held + len(near), shift + 1
        if held > HELD_LINKS:
            u, v = _as_stars(np.concatenate(ends_u), np.concatenate(ends_v))
            ends_u, ends_v, held = [u], [v], len(u)  # fewer than rows, and a batch has few of those
    return _as_stars(np.concatenate(ends_u), np.concatenate(ends_v))


def _as_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components, as links from each node to its smallest one."""
    nodes = np.unique(np.concatenate([u, v]))
    roots = _local_min_labels(nodes, u, v)
    return nodes[nodes != roots], roots[nodes != roots]


def _local_links(batches: Iterator[pd.DataFrame], keys: list[str], max_bits: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by ``keys``; the last group of a batch waits for the next batch."""
    rest = None

    def linked(rows: np.ndarray) -> pd.DataFrame:
        new = (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1)
        u, v = _links_within(np.concatenate([[0], np.cumsum(new)]), rows[:, -1], max_bits)
        return pd.DataFrame({"src": u, "dst": v})

    for batch in batches:
        rows = np.column_stack([batch[c].to_numpy(dtype=np.int64) for c in [*keys, "fp"]])
        rows = rows if rest is None else np.concatenate([rest, rows])
        if not len(rows):
            continue
        other = np.nonzero((rows[:, :-1] != rows[-1, :-1]).any(axis=1))[0]
        cut = other[-1] + 1 if len(other) else 0
        rest = rows[cut:]
        if cut:
            yield linked(rows[:cut])
    if rest is not None:
        yield linked(rest)


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(src, dst)`` links with the components of all pairs at most ``max_bits`` apart.

    ``distinct`` has one row for each fingerprint ``fp``.
    """
    masks = F.array(*[F.lit(m) for m in variant_masks(max_bits)])
    variants = (distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("p"))
                        .select("p", F.col("fp").bitwiseAND(F.element_at(masks, F.col("p") + 1)).alias("part"), "fp"))
    keys = ["p", "part"]
    large = pinned(variants.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows), "buckets")
    if not large.isEmpty():
        blocks = F.ceil(F.coalesce("n", F.lit(1)) / bucket_rows)
        own = F.pmod(F.xxhash64("fp"), blocks).cast("long")
        variants = (variants.join(large, keys, "left")
                            .select(*keys, "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"))
                            .select(*keys, F.least("own", "j").alias("lo"), F.greatest("own", "j").alias("hi"), "fp"))
        keys = [*keys, "lo", "hi"]
    return (variants.repartition(*keys).sortWithinPartitions(*keys, "fp")
                    .mapInPandas(lambda it: _local_links(it, keys, max_bits), "src long, dst long").distinct())


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(fp, root, component_id)`` of every fingerprint in ``prints(id, fp)``.

    ``root`` is the smallest fingerprint reachable, ``component_id`` the smallest id.
    """
    distinct = pinned(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "fingerprints")
    links = pinned(fingerprint_links(distinct, max_bits, bucket_rows), "links")
    nodes = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()
    labels = connected_components(nodes, links).select(F.col("node").alias("fp"), F.col("label").alias("root"))
    linked = distinct.join(labels, "fp")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    alone = distinct.join(labels, "fp", "left_anti")
    return (linked.join(least, "root").select("fp", "root", "component_id")
                  .unionByName(alone.select("fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"))))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, a row for each row of ``docs``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = pinned(with_fingerprint(narrow, shingle_words=shingle_words).select("id", "fp"), "prints")
    found = fingerprint_components(prints, max_bits, bucket_rows)
    return prints.join(found, "fp").select(F.col("id").alias(id_col),
                                           F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: that with the smallest id.

    Rows with the same id in a component (repeated rows) leave one row. All
    columns are kept as they are.
    """
    plain, at = own_names(docs)
    wide = pinned(with_fingerprint(plain, at[text_col], "fp", shingle_words), "documents")
    found = fingerprint_components(wide.select(F.col(at[id_col]).alias("id"), "fp"), max_bits)
    kept = (wide.join(found, "fp").filter(F.col(at[id_col]).eqNullSafe(F.col("component_id")))
                .dropDuplicates(["root"]))
    return kept.select(*[F.col(n).alias(c) for c, n in at.items()])
