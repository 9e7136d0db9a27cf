"""SparkSession with the settings the library expects."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# ANSI stays on: tolerant parsing is explicit (try_cast, try_to_date, try_divide) where it is wanted.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide rows generate methods beyond the 8000 bytes the JVM compiles; such a stage is faster split up
    # than fused and interpreted (measured on the 17-key fact: a third less time).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app_name: str = "tierline", **settings: str) -> SparkSession:
    """Session for the cluster spark-submit points at; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs over rows too wide for one compiled method, in a session that was made without :data:`SETTINGS`."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, SETTINGS[limit])
    try:
        yield
    finally:
        spark.conf.set(limit, before)
