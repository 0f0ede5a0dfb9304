"""A store of layers: written once by the product that makes them, read by all that use them.

A layer is a table bucketed by its keys: ``(week, lat_idx, strip)`` for weekly
layers, whose rows are strips of grid lines, ``(lat_idx, lon_idx)`` for static
ones. Layers with the same keys are joined bucket to bucket, so stacking them
moves nothing, and reading them at points moves the points only.

A store belongs to a session and a data folder: its tables stand in the
session's catalog, their files in the shared checkpoint folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .lineage import scratch_path

BUCKETS = 24  # tasks of a join of layers
ROW_GROUP = 16 << 20  # bytes that a bucket's writer and reader hold


def table_name(sf_dir: str, name: str) -> str:
    return f"layer_{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}_{name}"


def layer(spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str], build: Callable[[], DataFrame],
          buckets: int = BUCKETS) -> DataFrame:
    """The layer ``name`` of ``sf_dir``; ``build`` makes it if the session has not written it yet."""
    table = table_name(sf_dir, name)
    if not spark.catalog.tableExists(table):
        (build().repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
                .option("parquet.block.size", ROW_GROUP).option("parquet.enable.dictionary", "false")
                .option("path", scratch_path(spark, table)).saveAsTable(table))
    return spark.table(table)


def drop_layers(spark: SparkSession, sf_dir: str) -> None:
    """Forget all layers of ``sf_dir``: the next reader makes them anew."""
    prefix = table_name(sf_dir, "")
    for t in spark.catalog.listTables():
        if t.name.startswith(prefix):
            spark.sql(f"DROP TABLE `{t.name}`")


def side_by_side(spine: DataFrame, layers: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """J12 on stored layers: every row of ``spine`` with the values of each layer, NULL where it has none.

    Left joins keep the spine's buckets, so no layer is exchanged.
    """
    out = spine
    for one in layers:
        out = out.join(one.hint("merge"), list(keys), "left")
    return out
