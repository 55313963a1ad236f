"""Table sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: Parquet scan, with an explicit schema when given."""
    r = spark.read
    return (r.schema(schema) if schema is not None else r).parquet(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table if present, else an empty frame of the same schema."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema every column is a string (no inference
    pass over the data; also avoids key type mismatches in lookups)."""
    r = spark.read.option("header", True)
    return (r.schema(schema) if schema is not None else r).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet sink. Never overwrite a path the same plan reads (Spark refuses);
    append, or write a new path and switch readers to it."""
    df.write.mode(mode).parquet(path)


def schema_from_dict(spark: SparkSession, columns: dict[str, str]) -> T.StructType:
    """{column: SQL type name} -> StructType, via Spark's DDL parser."""
    ddl = ", ".join(f"`{k}` {v}" for k, v in columns.items())
    return spark.createDataFrame([], ddl).schema


def sql_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SQL scan of a Parquet path."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")
