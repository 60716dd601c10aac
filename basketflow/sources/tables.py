"""Readers: Parquet tables, JDBC tables, SQL files, and the is-there-data gate."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, base: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; select and where on it reach the scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base.rstrip('/')}/{name}")


def read_jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str,
                    lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A database table read in parallel ranges of a numeric column.

    Needs the database's JDBC driver on the class path.
    """
    return (spark.read.format("jdbc").options(**options)
            .option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions).load())


def has_data(df: DataFrame) -> bool:
    """Whether there is at least one row; reads no more than it must."""
    return not df.isEmpty()


def run_sql_file(spark: SparkSession, path: str | Path, args: dict | None = None,
                 **frames: DataFrame) -> DataFrame:
    """Run the query in a file.  ``{name}`` stands for a frame, ``:name`` for an argument."""
    text = Path(path).read_text(encoding="utf-8").strip().rstrip(";")
    return spark.sql(text, args=args, **frames)
