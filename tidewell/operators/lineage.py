"""Cutting lineage in iterative operators.

``materialize`` writes a reliable checkpoint into the shared
``spark.checkpoint.dir`` (never a local checkpoint): lineage is cut and the
data survives executor loss.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewell-io/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

