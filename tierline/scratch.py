"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A session in one process without the setting gets a temporary folder of its own; a cluster, also one on a single
    machine, must name one, because files written to a machine-local folder are lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierline-"))
        return spark.sparkContext.getCheckpointDir()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses."""
    return f"{shared_dir(spark)}/tierline/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame once and read it back.

    Cuts the lineage so that several consumers do not recompute it, survives executor loss, and gives the
    optimizer true file sizes, so small sides broadcast by measured size and large ones shuffle. Packed more tightly than
    by default, as nothing removes these files before the application ends.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer derived from ``folder``, written once per application and read by every query that needs it.

    Stands for the stored table a query would find in a deployment: later queries scan only the columns they
    use. Layers are written whole and wide, so they are packed more tightly than by default.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def already_stored(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """A layer that some query of this application has written, or None."""
    path = _STORED.get((spark.sparkContext.applicationId, folder, name))
    return None if path is None else spark.read.parquet(path)
