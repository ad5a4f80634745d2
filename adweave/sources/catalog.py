"""Catalog registration, so that SQL clients can query written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_table(spark: SparkSession, database: str, name: str, path: str, fmt: str = "parquet") -> str:
    """Creates database and external table at ``path`` if they are missing; safe to repeat."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` USING {fmt} LOCATION '{path}'")
    return f"{database}.{name}"


def drop_table(spark: SparkSession, database: str, name: str) -> None:
    """Removes the catalog's entry of an external table; its files stay, and tables already read keep working."""
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Table names: second column of SHOW TABLES, or the first when there is only one."""
    rows = spark.sql(f"SHOW TABLES IN `{database}`").collect()
    return [r[1] if len(r) > 1 else r[0] for r in rows]


def preview(spark: SparkSession, table: str, n: int = 10) -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} LIMIT {int(n)}")
