"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pinned(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the cluster's shared folder and read back.

    Cuts the lineage and fixes row contents: whatever is computed from the
    result twice, or again after an executor is lost, sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def own_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns ``c0``, ``c1`` and so on, and the name that each column got: nothing added can clash."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def computed(df: DataFrame, *cols) -> DataFrame:
    """``df.select(*cols)`` with each column computed once for a row.

    Plain selects are merged, and an array that a lambda looks into would be
    computed anew for each element; a one-row generator keeps them apart.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


def as_blocks(data: bytes, size: int) -> list[bytes]:
    """The whole of ``data`` in pieces of ``size`` bytes (the last is shorter)."""
    return [data[i:i + size] for i in range(0, len(data), size)]
