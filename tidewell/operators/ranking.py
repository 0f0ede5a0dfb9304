"""Order-based selection without a single-partition window (W4, cluster labels).

``range_rank`` numbers the distinct values of a column of any type.

``block_rank`` numbers rows 1.. in ``order`` within each ``part`` group. The
order key is cut into fixed-width blocks; a small table of per-block counts
gives each block's offset (running sum), and ``row_number`` only runs inside
one block, so no task ever sorts a whole group. The order key must be a
non-negative integer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import materialize

DEFAULT_BLOCK = 1 << 16


def block_rank(df: DataFrame, order: str, part: Sequence[str] = (), out: str = "rank",
               block: int = DEFAULT_BLOCK) -> DataFrame:
    part = list(part)
    b = df.withColumn("_blk", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    counts = b.groupBy(*part, "_blk").agg(F.count(F.lit(1)).alias("_bc"))
    w = (Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))).orderBy("_blk")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_bc").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy(*part, "_blk").orderBy(order)
    return (b.join(offsets.drop("_bc"), [*part, "_blk"])
             .withColumn(out, F.col("_off") + F.row_number().over(inner))
             .drop("_blk", "_off"))


def range_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """``(col, out)``: the distinct values of ``col``, of any sortable type, numbered from 0 in order.

    Values are cut into ranges, each range is ranked by itself, and the
    driver adds up one count for each range (as many as shuffle partitions).
    """
    ranged = materialize(df.select(col).filter(F.col(col).isNotNull()).distinct().repartitionByRange(col)
                           .withColumn("_part", F.spark_partition_id()), "range-rank")
    counts = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = [sum(n for q, n in counts.items() if q < p) for p in range(max(counts, default=0) + 1)]
    start = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in before]), F.col("_part") + 1)
    inner = Window.partitionBy("_part").orderBy(col)
    return ranged.select(col, (start + F.row_number().over(inner) - 1).alias(out))


def first_n(df: DataFrame, order: str, n_col: str, part: Sequence[str] = (),
            block: int = DEFAULT_BLOCK) -> DataFrame:
    """The first ``n_col`` rows in ``order`` per group (short result allowed).

    Blocks that start at or after position n are dropped before any
    per-block ranking runs. ``df`` is computed once, for the block counts and
    the rows.
    """
    part = list(part)
    df = materialize(df, "first-n")
    b = df.withColumn("_blk", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    counts = b.groupBy(*part, "_blk").agg(F.count(F.lit(1)).alias("_bc"))
    w = (Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))).orderBy("_blk")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_bc").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy(*part, "_blk").orderBy(order)
    kept = b.join(offsets.drop("_bc"), [*part, "_blk"]).filter(F.col("_off") < F.col(n_col))
    return (kept.withColumn("_pos", F.col("_off") + F.row_number().over(inner))
                .filter(F.col("_pos") <= F.col(n_col))
                .drop("_blk", "_off", "_pos"))
