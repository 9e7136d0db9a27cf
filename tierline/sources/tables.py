"""Reading stored tables and the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.model import LAYERS
from tierline.operators.quality import table_inventory


def read_table(spark: SparkSession, tenant: str, layer: str, table: str) -> DataFrame:
    return spark.table(f"{tenant.lower()}_{layer}.{table}")


def list_tables(spark: SparkSession, tenant: str) -> DataFrame:
    """(table_schema, table_name) of the tenant's layers."""
    rows = [
        (database, t.name)
        for database in (f"{tenant.lower()}_{layer}" for layer in LAYERS)
        if spark.catalog.databaseExists(database)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    ]
    return spark.createDataFrame(rows, "table_schema string, table_name string").orderBy(F.col("table_schema"), "table_name")


def inventory(spark: SparkSession, tenant: str) -> DataFrame:
    """Row and column counts of every stored table."""
    names = [f"{r.table_schema}.{r.table_name}" for r in list_tables(spark, tenant).toLocalIterator()]
    return table_inventory({name: spark.table(name) for name in names})
