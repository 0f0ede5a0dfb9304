"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are dealt to blocks. How many rows each block sends to each shard is
drawn first, from the distribution that a uniform permutation of all rows
would give: a matrix whose row sums are the blocks' sizes and whose column
sums are the shards' sizes, each entry hypergeometric given those before.
Then each block is permuted and cut at its row of the matrix, the parts are
exchanged, and each shard is permuted again. The result is a uniform shuffle
in which every shard has exactly its size, and none ever holds more than its
share while it is built.

Block and shard are permuted by sorting hashes of a tag that every row gets
once, in a written table, so that a recomputed task sees the same order.
Shards are permuted piece by piece: a shard's rows are cut by ranges of their
hash into pieces of about ``ROWS`` rows, so no task sorts a whole shard.
DataFrame functions only; the driver draws the matrix, at most ``MAX_BLOCKS``
times ``shards`` numbers.

Defined results: every row, whatever it holds, gets one place; equal rows get
different ones. An empty table gives an empty result. Columns called
``shard`` or ``slot`` in the input are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned

ROWS = 1024
MAX_BLOCKS = 4096
SMALL = 10 ** 9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good items among ``draws`` of ``good + bad``, at any size."""
    if good + bad < SMALL:
        return int(rng.hypergeometric(good, bad, draws))
    least, most = max(0, draws - bad), min(draws, good)
    mode = min(most, max(least, (draws + 1) * (good + 1) // (good + bad + 2)))
    # inversion that walks outwards from the mode, weights relative to it
    width = int(12 * math.sqrt(draws * (good / (good + bad)) * (bad / (good + bad)) + 1)) + 12
    ks = np.arange(max(least, mode - width), min(most, mode + width) + 1)
    up = ks[:-1]
    steps = (np.log(np.maximum(good - up, 1)) + np.log(np.maximum(draws - up, 1))
             - np.log(up + 1) - np.log(np.maximum(bad - draws + up + 1, 1)))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return int(rng.choice(ks, p=weights / weights.sum()))


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> np.ndarray:
    """How many rows of each block go to each shard; sums are exactly ``blocks`` and ``shards``."""
    if sum(blocks) != sum(shards):
        raise ValueError("blocks and shards hold different numbers of rows")
    rng = np.random.default_rng(seed)
    room, out = [int(x) for x in shards], np.zeros((len(blocks), len(shards)), dtype=np.int64)
    for b, rows in enumerate(blocks):
        left, rest = int(rows), sum(room)
        for s in range(len(room)):
            rest -= room[s]
            out[b, s] = hypergeometric(rng, room[s], rest, left) if left else 0
            left -= int(out[b, s])
        room = [x - int(y) for x, y in zip(room, out[b], strict=True)]
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = 0, rows_per_block: int = ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (0 to the shard's size - 1)."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    names = [f"c{i}" for i in range(len(columns))]  # own names: none can clash
    tagged = pinned(df.select(*columns).toDF(*names).withColumn("tag", F.monotonically_increasing_id()), "rows", "zstd")
    total = tagged.count()
    n_blocks = max(1, min(MAX_BLOCKS, total // rows_per_block))
    keyed = tagged.withColumns({
        "block": F.pmod(F.xxhash64("tag", F.lit(seed)), F.lit(n_blocks)),
        "first_key": F.xxhash64("tag", F.lit(seed + 1)), "second_key": F.xxhash64("tag", F.lit(seed + 2))})
    counts = {r["block"]: r["n"] for r in keyed.groupBy("block").agg(F.count("*").alias("n")).collect()}
    sizes = [counts.get(b, 0) for b in range(n_blocks)]
    matrix = communication_matrix(sizes, shard_sizes(total, shards), seed)
    ends = spark.createDataFrame([(b, row.tolist()) for b, row in enumerate(matrix.cumsum(axis=1))],
                                 "block long, ends array<long>")
    place = F.row_number().over(Window.partitionBy("block").orderBy("first_key", "tag")) - 1
    # at most MAX_BLOCKS rows of `shards` numbers: small enough to send to every task
    sent = (keyed.withColumn("place", place).join(F.broadcast(ends), "block")
                 .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place")))).drop("ends"))
    pieces = max(1, total // shards // rows_per_block)
    piece = F.floor(F.shiftrightunsigned("second_key", 32) * pieces / F.lit(2 ** 32)).cast("long")
    cut = sent.withColumn("piece", piece)
    within = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("second_key", "tag"))
    before = (cut.groupBy("shard", "piece").agg(F.count("*").alias("n"))
                 .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n"))
                 .select("shard", "piece", "before"))
    done = (cut.withColumn("within", within).join(before, ["shard", "piece"])
               .withColumn("slot", F.col("before") + F.col("within") - 1))
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, columns, strict=True)], "shard", "slot")


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                    seed: int = 0) -> DataFrame:
    """Places of all documents under the law ``rows``: shard counts are at most one apart.

    The texts themselves are exchanged; size and checksum are those of the shards' rows.
    """
    placed = shuffle_to_shards(docs.select(id_col, text_col), shards, seed)
    # of the text that came to the shard
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long")
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return placed.select(id_col, size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 0) -> None:
    """The shuffled rows as files, a folder for each shard, in the order of their slots."""
    placed = shuffle_to_shards(df, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
