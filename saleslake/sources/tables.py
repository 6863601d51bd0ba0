"""Catalog tables over the layer folders."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from saleslake.schemas import PARTITION_COLUMNS, RATES, with_partitions


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """A database, in the warehouse or in a folder of its own."""
    place = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_table(
    spark: SparkSession,
    database: str,
    name: str,
    schema: T.StructType,
    root: str,
    repair: bool = True,
) -> str:
    """(Re)define the external table of a layer and register the partitions found in storage.

    Dropping an external table removes its definition only; the files stay. The table has the
    partitions that the catalog knows, so none before the first repair.
    """
    table = f"{database}.{name}"
    create_database(spark, database)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl(with_partitions(schema))}) "
        f"USING PARQUET PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION {_quoted(root)}"
    )
    if repair:
        repair_partitions(spark, table)
    return table


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register the branch-months that storage has and the catalog doesn't."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def register_rates_table(spark: SparkSession, database: str, name: str, root: str) -> str:
    """(Re)define the external table over a folder of rates files with one header line each.

    Columns go by position, whatever the header calls them.
    """
    table = f"{database}.{name}"
    create_database(spark, database)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl(RATES)}) "
        f"USING CSV OPTIONS (header 'true') LOCATION {_quoted(root)}"
    )
    return table


def preview(spark: SparkSession, table: str, n: int = 10, order: Sequence[str | Column] = ()) -> DataFrame:
    """The first rows of a table: any, or the first in an order, which every task cuts to ``n`` rows itself."""
    rows = spark.table(table)
    return (rows.orderBy(*order) if order else rows).limit(n)
