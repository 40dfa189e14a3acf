"""Readers and writers. Schemas are declared, so no file is read just to guess types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files under a path or glob, one row per line in ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None, header: bool = True, sep: str = ","
) -> DataFrame:
    """CSV with a declared schema; ``schema=None`` infers it with one more pass over the file."""
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_table_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_lines(df: DataFrame, path: str, value: str = "value") -> str:
    df.select(value).write.mode("errorifexists").text(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """CSV files; blanks around values are kept as they are."""
    writer = df.write.mode("errorifexists").option("header", header)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").json(path)
    return path


def first_lines(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """A look at the raw lines of what was written, in no stated order."""
    return read_lines(spark, path).limit(n)


def lowest_lines(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The raw lines that come first by their text: the same ones however the files are laid out."""
    lines = read_lines(spark, path)
    return lines.orderBy(lines.columns[0]).limit(n)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)
