r"""Prefix trie of conversations by van Emde Boas recursion.

Conversations are sequences of turns; a node of the trie is a distinct sequence of first turns. It is named by its
smallest member and its depth. The trie of sequences up to ``2^K`` turns is built by halves:

* **Cut.** Sequences that reach the middle of their segment are cut there. The digests of aligned halves, quarters and
  so on are made once, each from two of half its length.
* **Name.** Cut prefixes beneath the same node with equal digests are one node; its name is the smallest conversation
  among them.
* **Recurse.** Of each cut prefix one piece goes on into the upper trie, with the number of its members; what follows
  the cut goes into the lower forest beneath the named node. Upper tries and lower forests of all segments are one table
  and are cut again in the same round, in parallel: ``K`` rounds instead of one for each depth. A prefix that a third of
  all conversations share is one row in the upper trie from its first cut on.
* **Graft.** On the way back, a round joins each lower forest to the node it hangs on: the forest's totals are added to
  all nodes between that node and the top of the upper segment. The path from a segment's last node to its top grows
  by the same doubling.

Shuffles are by (segment, parent, digest), (node, depth) or (conversation, segment), with partial sums before them; a
group of copies is joined back to its one name, a join whose large side Spark can split. Turns are numbered by ranges
of (conversation, turn) and one count for each range, never by a window over one conversation. Each round's table is
written to the shared folder.

The digest of the conversations that end at a node is that of one long text, so it has to be read in order: ranges of
ids are joined into texts of ``PIECE_CHARS`` characters by many tasks, and one task for a node hashes those, holding
one at a time.

Defined results: a null role or text is empty; rows of a null ``conv_id`` belong to no conversation and are left out; a
null turn comes first, equal turns are in the order of role and text, repeated rows are as many turns. Turns of one
conversation that agree in turn and in the first ``KEY_CHARS`` characters of role and text are sorted by one task. A
conversation rebuilt without turns is a member of the root. An empty table has no node, not even a root. Texts may be
of any length: only digests and lengths leave the first pass. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned

BLOCK = 100
SALT = 6
KEY_CHARS = 32
PIECE_CHARS = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``(conv, place, x, chars)``: every turn's place in the table's order, its digest and its text's code points."""
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    said = F.concat(F.length("role").cast("string"), F.lit("\n"), F.col("role"), F.lit("\n"), F.col("text"))
    ranged = (rows.repartitionByRange("conv", "turn", F.left("role", F.lit(KEY_CHARS)), F.left("text", F.lit(KEY_CHARS)))
                  .sortWithinPartitions("conv", "turn", "role", "text"))
    part = F.spark_partition_id()
    turns = pinned(ranged.select("conv", part.alias("part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("i"),
                                 F.unhex(F.sha2(said, 256)).alias("x"), F.length("text").cast("long").alias("chars")), "turns")
    counts = {r["part"]: r["n"] for r in turns.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, at = [], 0
    for p in range(max(counts, default=0) + 1):
        before.append(F.lit(at).cast("long"))
        at += counts.get(p, 0)
    return turns.select("conv", (F.get(F.array(*before), F.col("part")) + F.col("i")).alias("place"), "x", "chars")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, length)`` and ``(conv, d, x, chars)`` of conversations as they are, turns numbered from 1."""
    convs = turns.groupBy("conv").agg(F.min("place").alias("first"), F.count("*").alias("length"))
    own = turns.join(convs, "conv").select("conv", (F.col("place") - F.col("first") + 1).alias("d"), "x", "chars")
    return convs.select("conv", "length"), own


def rebuilt(turns: DataFrame, block: int = BLOCK, salt: int = SALT) -> tuple[DataFrame, DataFrame]:
    """As ``plain``, for conversations whose first ``crc32(id) % salt`` turns are those of their block's first one.

    Less if that one is shorter, none if there is none; a block has at most ``2 * block`` ids and a head ``salt - 1`` turns.
    """
    convs, own = plain(turns)
    base = F.col("conv") - F.col("conv") % block
    convs = pinned(convs.withColumn("h", F.crc32(F.col("conv").cast("string")) % salt).withColumn("base", base), "conversations")
    own = pinned(own, "own-turns")
    heads = convs.select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    convs = convs.join(heads, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_length", F.lit(0))))
    lengths = convs.select("conv", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length"))
    kept = (own.join(convs.select("conv", "h", "taken"), "conv").filter(F.col("d") > F.col("h"))
               .select("conv", (F.col("d") - F.col("h") + F.col("taken")).alias("d"), "x", "chars"))
    head = own.filter(F.col("d") < salt).withColumnRenamed("conv", "base")
    shared = (convs.filter("taken > 0").select("conv", "base", "taken").join(head, "base").filter(F.col("d") <= F.col("taken"))
                   .select("conv", "d", "x", "chars"))
    return pinned(lengths, "lengths"), pinned(kept.unionByName(shared), "rebuilt-turns")


def _digests(turns: DataFrame, levels: int) -> list[DataFrame]:
    """By level, ``(conv, lo, g)``: the digest of the ``2^level`` turns behind ``lo``, where there are so many."""
    out = [turns.select("conv", (F.col("d") - 1).alias("lo"), F.col("x").alias("g"))]
    for k in range(1, levels):
        half = 1 << (k - 1)
        right = F.col("lo") % (2 * half) == half
        pairs = (out[-1].groupBy("conv", F.expr(f"lo - lo % {2 * half}").alias("lo0"))
                        .agg(F.max(F.when(~right, F.col("g"))).alias("a"), F.max(F.when(right, F.col("g"))).alias("b"))
                        .filter("a is not null and b is not null"))
        out.append(pinned(pairs.select("conv", F.col("lo0").alias("lo"), F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("g")),
                          "segment-digests"))
    return out


def _named(pieces: DataFrame, digests: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """The nodes that ``pieces`` reach over the segments of ``digests``, and the pieces with their node's name."""
    keyed = pinned(pieces.join(digests, ["conv", "lo"]), "cut")
    # written, so that the join is one of two plain tables: Spark splits its hot keys
    nodes = pinned(keyed.groupBy("lo", "parent", "g").agg(F.min("conv").alias("name"), F.sum("w").alias("w"), *more), "named")
    return nodes, keyed.join(nodes.select("lo", "parent", "g", "name"), ["lo", "parent", "g"])


def build(lengths: DataFrame, turns: DataFrame) -> tuple[int, int, DataFrame, DataFrame]:
    """Smallest conversation, rounds, nodes ``(conv, depth, parent, n_convs, chars)`` and ends ``(member, conv, depth)``.

    ``lengths`` must not be empty. The root is not among the nodes.
    """
    root, longest = lengths.agg(F.min("conv"), F.max("length")).first()
    rounds = max(0, (longest - 1).bit_length())
    digests = _digests(turns, rounds)
    ends = lengths.filter("length = 0").select(F.col("conv").alias("member"), F.lit(root).cast("long").alias("conv"),
                                               F.lit(0).cast("long").alias("depth"))
    pieces = lengths.filter("length > 0").select("conv", F.lit(0).cast("long").alias("lo"), F.lit(root).cast("long").alias("parent"),
                                                 F.col("length").alias("n"), F.lit(1).cast("long").alias("w"), F.lit(True).alias("tail"))
    columns = pieces.columns

    def ended(at_node: DataFrame, half: int) -> DataFrame:
        return at_node.filter(F.col("tail") & (F.col("n") == half)).select(
            F.col("conv").alias("member"), F.col("name").alias("conv"), (F.col("lo") + half).alias("depth"))

    for k in reversed(range(rounds)):
        half = 1 << k
        nodes, at_node = _named(pieces.filter(F.col("n") >= half), digests[k])
        ends = ends.unionByName(ended(at_node, half))
        upper = nodes.select(F.col("name").alias("conv"), "lo", "parent", F.lit(half).cast("long").alias("n"), "w", F.lit(False).alias("tail"))
        lower = at_node.filter(F.col("n") > half).select(
            "conv", (F.col("lo") + half).alias("lo"), F.col("name").alias("parent"), (F.col("n") - half).alias("n"), "w", "tail")
        pieces = pinned(pieces.filter(F.col("n") < half).unionByName(upper).unionByName(lower).select(*columns), "pieces")
    last = turns.select("conv", (F.col("d") - 1).alias("lo"), F.col("x").alias("g"), "chars")
    nodes, at_node = _named(pieces, last, F.max("chars").alias("chars"))
    ends = pinned(ends.unionByName(ended(at_node, 1)), "ends")
    nodes = pinned(nodes.select(F.col("name").alias("conv"), (F.col("lo") + 1).alias("depth"), "parent", F.col("w").alias("n_convs"),
                                "chars"), "nodes")
    return root, rounds, nodes, ends


def graft(nodes: DataFrame, rounds: int) -> DataFrame:
    """``(conv, depth, parent, leaves, saved)``: sums over the subtree of every node of ``(..., leaves, saved)``."""
    totals = nodes.select("conv", "depth", "parent", "leaves", "saved")
    tops = nodes.select(F.col("depth").alias("end"), F.col("conv").alias("last"), "parent")  # the node above the segment
    paths = nodes.select(F.col("depth").alias("end"), F.col("conv").alias("last"), "conv", "depth")
    for k in range(rounds):
        half = 1 << k
        hung = (totals.filter((F.col("depth") - 1) % (2 * half) == half)
                      .groupBy((F.col("depth") - 1).alias("end"), F.col("parent").alias("last"))
                      .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
        more = hung.join(paths, ["end", "last"]).select("conv", "depth", F.lit(None).cast("long").alias("parent"), "leaves", "saved")
        totals = pinned(totals.unionByName(more).groupBy("conv", "depth").agg(
            F.max("parent").alias("parent"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "totals")
        if k + 1 < rounds:
            lower = tops.filter(F.col("end") % (2 * half) == 0)
            link = lower.select((F.col("end") - half).alias("end"), F.col("parent").alias("last"), F.col("end").alias("end2"),
                                F.col("last").alias("last2"))
            above = link.join(paths, ["end", "last"]).select(F.col("end2").alias("end"), F.col("last2").alias("last"), "conv", "depth")
            longer = pinned(paths.filter(F.col("end") % (2 * half) == 0).unionByName(above), "paths")
            tops = pinned(link.join(tops, ["end", "last"]).select(F.col("end2").alias("end"), F.col("last2").alias("last"), "parent"), "tops")
            paths = longer
    return totals


def _joined(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``(conv, depth, member)`` as texts of up to ``PIECE_CHARS`` characters: ``(conv, depth, first, ids)``."""
    node, first, ids, chars = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([first], pa.int64()),
                                           pa.array([",".join(ids)])], ["conv", "depth", "first", "ids"])

    for batch in rows:
        for conv, depth, member in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and (node != (conv, depth) or chars >= PIECE_CHARS):
                yield piece()
                ids, chars = [], 0
            if not ids:
                node, first = (conv, depth), member
            ids.append(str(member))
            chars += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as ``(conv, depth, ends_sha256)``."""
    node, digest, out = None, None, []

    def done() -> pa.RecordBatch:
        convs, depths, digests = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(depths, pa.int64()), pa.array(digests)],
                                          ["conv", "depth", "ends_sha256"])

    for batch in rows:
        for conv, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if node == (conv, depth):
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (conv, depth), hashlib.sha256()
            digest.update(ids.encode())
            if len(out) >= 10_000:
                yield done()
                out = []
    if node:
        out.append((*node, digest.hexdigest()))
        yield done()


def end_digests(ends: DataFrame) -> DataFrame:
    """``(conv, depth, ends_sha256)``: the digest of the members that end at each node, in order, comma-joined."""
    ranged = ends.select("conv", "depth", "member").repartitionByRange("conv", "depth", "member").sortWithinPartitions("conv", "depth", "member")
    pieces = ranged.mapInArrow(_joined, "conv long, depth long, first long, ids string")
    return (pieces.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "first")
                  .mapInArrow(_hashed, "conv long, depth long, ends_sha256 string"))


def prefix_trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``, a row for each node."""
    spark = lengths.sparkSession
    schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
              "ends_sha256 string")
    if lengths.isEmpty():
        return spark.createDataFrame([], schema)
    root, rounds, nodes, ends = build(lengths, turns)
    children = nodes.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    own = pinned(nodes.join(children, ["conv", "depth"], "left").select(
        "conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "own-values")
    totals = graft(own, rounds)
    top = totals.filter("depth = 1").agg(F.count("*"), F.sum("leaves"), F.sum("saved")).first()
    members = lengths.count()
    top_row = spark.createDataFrame([(root, 0, None, members, top[0], top[1] or 1, top[2] or 0)],
                                    "conv long, depth long, parent long, n_convs long, n_children long, leaves long, saved long")
    whole = own.drop("leaves", "saved").join(totals.drop("parent"), ["conv", "depth"]).unionByName(top_row)
    return whole.join(end_digests(ends), ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
