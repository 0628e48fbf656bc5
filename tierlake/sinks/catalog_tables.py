"""Layers as catalog tables: created and dropped by DDL, read by their names.

The tables are external (``USING parquet ... LOCATION``), so the catalog knows their
schema and partitions while the files stay where the layers write them. Any catalog of the
session will do; names may have one to three parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tierlake.schemas import ddl
from tierlake.sinks.tables import PartitionedTable


def create_table(spark: SparkSession, name: str, schema: StructType, location: str,
                 partitioned_by: list[str] | None = None) -> None:
    """Drop the table if it exists and create it anew over ``location``.

    Dropping an external table leaves its files; with ``partitioned_by`` the partitions
    that are there already are registered."""
    drop_table(spark, name)
    spark.sql(ddl(schema, name, location, partitioned_by))
    if partitioned_by:
        refresh_partitions(spark, name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Register new partition folders with the catalog, forget those that are gone, and
    drop cached file listings; call it after a batch."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def publish(table: PartitionedTable, name: str) -> None:
    """Create catalog table ``name`` over a stored layer, layout columns included."""
    create_table(table.spark, name, table.scan().schema, table.root, table.partition_cols)


def append_rows(df: DataFrame, name: str) -> None:
    """Append rows to a catalog table, columns matched by name."""
    columns = df.sparkSession.read.table(name).columns
    df.select(*columns).write.insertInto(name)


def extract_batch(spark: SparkSession, name: str, batch_id: str | None = None) -> DataFrame:
    """Rows of a catalog table, or of one batch of it (a filter that reaches the scan)."""
    rows = spark.read.table(name)
    return rows if batch_id is None else rows.where(rows["batch_id"] == batch_id)
