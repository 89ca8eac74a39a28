"""Catalog tables over the stored layers (``CREATE TABLE ... USING parquet LOCATION``)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from snapledger.model import LEDGER_SCHEMA, MART_SCHEMA


def _columns(schema: T.StructType) -> str:
    return ",\n  ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def ledger_ddl(table: str, location: str, partition_cols: tuple[str, ...] = ("snapshot_date",)) -> str:
    """DDL of the snapshot ledger.

    Partition columns are declared once, in the column list and in
    ``PARTITIONED BY`` by name only (declaring them twice is rejected).
    The default partitions by snapshot day only: partitioning by
    (snapshot_date, transaction_date) creates days x days directories.
    """
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n  {_columns(LEDGER_SCHEMA)}\n)\n"
        f"USING parquet\nPARTITIONED BY ({', '.join(partition_cols)})\nLOCATION '{location}'"
    )


def create_ledger_table(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(ledger_ddl(table, location))
    # Partitions written by DataFrame writes are registered with the catalog.
    spark.sql(f"MSCK REPAIR TABLE {table}")


def publish_reports(spark: SparkSession, mart_location: str, prefix: str) -> dict[str, str]:
    """Temp views over a stored mart, for reports in SQL; returns their names by report.

    ``mart`` is the table itself, ``current`` its newest snapshot day. The newest day is a scalar subquery on the partition column: it is
    evaluated when a query runs, and then prunes the scan to one partition.
    """
    names = {n: f"{prefix}_{n}" for n in ("mart", "current")}
    spark.read.schema(MART_SCHEMA).parquet(mart_location).createOrReplaceTempView(names["mart"])
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {names["current"]} AS
        SELECT release_date, subsidiary, gmv_value, transaction_count, snapshot_date FROM {names["mart"]}
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM {names["mart"]})""")
    return names


def drop_reports(spark: SparkSession, names: dict[str, str]) -> None:
    for n in names.values():
        spark.catalog.dropTempView(n)
