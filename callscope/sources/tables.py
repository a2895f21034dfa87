"""Readers for the driver's parquet tables and for our own logs.

Reads name their columns, so Catalyst prunes the parquet scan to what a
query uses; explicit schemas are used for JSON and streaming sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callscope import schemas


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_log(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a call, chunk or thread log with a fixed schema.

    `fmt` is any file source (`parquet`, `json`, `orc`); JSON logs are parsed
    with the schema, never inferred.
    """
    return spark.read.format(fmt).schema(schema).load(path)


def stream_log(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               max_files_per_trigger: int = 100) -> DataFrame:
    """S1-S3 on a stream: the same logs as new files arrive, with the same
    fixed schema; `max_files_per_trigger` bounds each micro-batch."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def read_calls(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Chat and completion calls with their static results."""
    return read_log(spark, path, schemas.CALLS, fmt)


def read_chunks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Streamed chunks; order comes from `seq`, never from file order."""
    return read_log(spark, path, schemas.CHUNKS, fmt)


def read_threads(spark: SparkSession, runs_path: str, assistants_path: str,
                 messages_path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3: runs, assistants and thread messages."""
    return (read_log(spark, runs_path, schemas.RUNS, fmt),
            read_log(spark, assistants_path, schemas.ASSISTANTS, fmt),
            read_log(spark, messages_path, schemas.MESSAGES, fmt))
