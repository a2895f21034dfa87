"""Derived logs written once to the shared checkpoint folder, then read
back through the schema'd readers (S1-S3), as production logs would be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callscope.session import scratch_path
from callscope.sources import fixtures as fx
from callscope.sources.tables import read_calls, read_chunks, read_threads

_WRITTEN: dict[tuple[str, str, str], str] = {}


def materialize(spark: SparkSession, df: DataFrame, name: str, sf_dir: str, fmt: str = "parquet") -> str:
    """Write `df` once per (scale, name, format) in this process; return its path."""
    key = (sf_dir, name, fmt)
    if key not in _WRITTEN:
        path = scratch_path(spark, "logs", name)
        df.write.mode("overwrite").format(fmt).save(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def calls_log(spark: SparkSession, sf_dir: str, fmt: str = "json") -> DataFrame:
    """The call log, stored as JSON lines and read with its schema."""
    return read_calls(spark, materialize(spark, fx.calls(spark, sf_dir), "calls", sf_dir, fmt), fmt)


def chunks_log(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> DataFrame:
    """The chunk log; order comes from `seq`, never from file order."""
    return read_chunks(spark, materialize(spark, fx.chunks(fx.calls(spark, sf_dir)), "chunks", sf_dir, fmt), fmt)


def thread_logs(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3: runs, assistants and messages."""
    return read_threads(spark, materialize(spark, fx.runs(spark, sf_dir), "runs", sf_dir, fmt),
                        materialize(spark, fx.assistants(spark, sf_dir), "assistants", sf_dir, fmt),
                        materialize(spark, fx.messages(spark, sf_dir), "messages", sf_dir, fmt), fmt)
