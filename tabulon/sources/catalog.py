"""Databases and tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def recreate_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop the database with everything in it, then create it empty."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {name}{place}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def refresh(spark: SparkSession, *names: str) -> None:
    """Forget what is cached about tables whose files changed."""
    for name in names:
        spark.catalog.refreshTable(name)


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of the database; temporary views, which belong to the session, are left out."""
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")


def save_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> DataFrame:
    """Write a managed parquet table, bucketed on request so later joins need no shuffle."""
    writer = df.write.format("parquet").mode("overwrite")
    if bucket_by and buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    refresh(df.sparkSession, name)
    return df.sparkSession.table(name)


def csv_table(spark: SparkSession, name: str, columns: str, path: str) -> DataFrame:
    """A table with declared columns over CSV files that stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING csv OPTIONS (path '{path}', header 'true')")
    return spark.table(name)


def register(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name
