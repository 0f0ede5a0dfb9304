"""Sinks (K1-K5): layers written as Parquet/CSV tables.

Rasters are long tables ``(band, lat_idx, lon_idx, lat, lon, value)``
sorted by (lat_idx, lon_idx) inside each file so row-group statistics prune
bbox reads; cubes are partitioned by week so date filters prune partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as tf
from ..operators.lineage import scratch_path  # noqa: F401  (re-exported)

DEFAULT_NODATA = -9999.0


def write_points(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None,
                 mode: str = "overwrite") -> str:
    """K1: point/line layer as Parquet, optionally partitioned (species, stage)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def raster_rows(df: DataFrame, value: str, band: int = 1, nodata: float = DEFAULT_NODATA) -> DataFrame:
    """K2 layout: missing values stored as ``nodata``."""
    return df.select(F.lit(band).alias("band"), F.col("lat_idx").cast("int"), F.col("lon_idx").cast("int"),
                     "lat", "lon", F.coalesce(tf.nan_to_null(value), F.lit(nodata)).alias("value"))


def write_raster(df: DataFrame, path: str, bands, nodata: float = DEFAULT_NODATA,
                 mode: str = "overwrite") -> str:
    """K2: grid layer bands (``{band: column}`` or one column as band 1),
    partitioned by band, cell order inside files."""
    if isinstance(bands, str):
        bands = {1: bands}
    rows = None
    for band, col in sorted(bands.items()):
        r = raster_rows(df, col, band, nodata)
        rows = r if rows is None else rows.unionByName(r)
    rows.sortWithinPartitions("lat_idx", "lon_idx").write.mode(mode).partitionBy("band").parquet(path)
    return path


def write_cube(df: DataFrame, path: str, partition_col: str = "week", mode: str = "overwrite") -> str:
    """K3: weekly cube partitioned by week; overwrite replaces only the weeks
    present in ``df`` (dynamic partition overwrite)."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    return path


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K4: tabular output as CSV with a header (microsecond timestamps)."""
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", TS_FORMAT)
       .option("timestampFormat", TS_FORMAT).csv(path))
    return path


def write_tracks_json(df: DataFrame, path: str, by: str) -> str:
    """Pings as JSON lines, saved by individual: a file ``<by>=<id>.json`` for each, more of them where one has very many.

    Rows are dealt by individual first, so the number of files follows the individuals alone, not tasks times individuals;
    Spark splits a part that is too large. A task writes its files, one open at a time, into its own folder, each under a
    hidden name until it is whole.
    """
    folder = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    fields = [c for c in df.columns if c != by]
    lines = df.select(F.col(by).cast("string").alias("id"), F.to_json(F.struct(*fields)).alias("line"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        task = TaskContext.get()
        base, out, opened = f"{base}/part={task.partitionId()}", None, None
        hidden, n_files = f"{base}/.{task.taskAttemptId()}", 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            start = 0
            while start < len(ids):
                stop = start + 1
                while stop < len(ids) and ids[stop] == ids[start]:
                    stop += 1
                name = f"{base}/{by}={'__HIVE_DEFAULT_PARTITION__' if ids[start] is None else quote(ids[start], safe='')}.json"
                if name != opened:
                    if out is not None:
                        out.close()
                        fs.move(hidden, opened)
                    fs.create_dir(base, recursive=True)
                    out, opened, n_files = fs.open_output_stream(hidden, compression=None), name, n_files + 1
                out.write(("\n".join(batch.column(1).slice(start, stop - start).to_pylist()) + "\n").encode())
                start = stop
        if out is not None:
            out.close()
            fs.move(hidden, opened)
        yield pa.RecordBatch.from_arrays([pa.array([n_files], pa.int64())], ["n_files"])

    fs, base = _file_system(folder)
    fs.create_dir(base, recursive=True)
    lines.hint("rebalance", "id").sortWithinPartitions("id").mapInArrow(save, "n_files long").agg(F.sum("n_files")).collect()
    return path


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)


def layer_metadata(layers: dict, crs: str = "EPSG:4326", res: float = tf.DEFAULT_RESOLUTION,
                   bbox: dict = tf.DEFAULT_BBOX, nodata: float = DEFAULT_NODATA) -> DataFrame:
    """K5: one descriptor row per layer.

    ``layers`` maps name -> (DataFrame, value column, unit, source). Each
    layer contributes one aggregate row (rows, nulls, min, max); the rows are
    unioned, never collected.
    """
    rows = []
    for name, (df, col, unit, source) in layers.items():
        v = tf.nan_to_null(col)
        rows.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(v.isNull()).alias("n_null"),
                           F.min(v).alias("min_value"), F.max(v).alias("max_value"))
                    .select(F.lit(name).alias("layer"), F.lit(unit).alias("unit"), F.lit(crs).alias("crs"),
                            F.lit(float(res)).alias("resolution_deg"),
                            F.lit(float(bbox["min_lon"])).alias("min_lon"), F.lit(float(bbox["max_lon"])).alias("max_lon"),
                            F.lit(float(bbox["min_lat"])).alias("min_lat"), F.lit(float(bbox["max_lat"])).alias("max_lat"),
                            F.lit(float(nodata)).alias("nodata"), "n_rows", "n_null", "min_value", "max_value",
                            F.lit(source).alias("source")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
