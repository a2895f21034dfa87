"""K3 on a stream: the results of chains as a table of deltas.

A micro-batch writes the state of the chains it touches, one row per chain,
to a folder named by its batch id, cut into buckets by chain. What is written
follows the batch, not the table; a batch that is run again writes the same
folder again. Reading merges: last write wins by (ts, update_id), counts are
added. `compact` writes the merged rows of all batches up to the newest one as
a new base and then records it; readers take the newest recorded base and the
deltas after it, so a compaction that dies midway changes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.operators.events import Config
from callscope.operators.feedback import chain_gate, chain_state, merge_chain_state

BUCKETS = 64
STATE = "id string, result string, ts timestamp, update_id bigint, n_updates bigint"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _write(state: DataFrame, path: str, buckets: int) -> None:
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    state.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def stream_chain_upsert(updates: DataFrame, table: str, checkpoint: str, buckets: int = BUCKETS, cfg: Config = Config()):
    """Start the job that adds a stream of chain updates to `table`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _write(chain_state(chain_gate(batch, cfg)), f"{table}/delta/upto={batch_id}", buckets)

    return (updates.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _base(spark: SparkSession, table: str) -> int:
    """The newest recorded compaction, -1 without one."""
    done = _read(spark, f"{table}/compactions", "upto bigint")
    newest = done.agg(F.max("upto")).first()[0] if done is not None else None
    return -1 if newest is None else newest


def _parts(spark: SparkSession, table: str) -> tuple[int, DataFrame | None]:
    """The newest base's number, and the base rows and deltas (with `upto`) to merge."""
    base = _base(spark, table)
    rows = _read(spark, f"{table}/delta", f"{STATE}, upto bigint")
    rows = rows.where(F.col("upto") > base) if rows is not None else None
    if base >= 0:
        old = spark.read.schema(STATE).parquet(f"{table}/base-{base}").withColumn("upto", F.lit(base).cast("bigint"))
        rows = old if rows is None else old.unionByName(rows)
    return base, rows


def read_chain_table(spark: SparkSession, table: str) -> DataFrame | None:
    """id, result, ts, update_id, n_updates of every chain; None before the first batch."""
    _, rows = _parts(spark, table)
    return None if rows is None else merge_chain_state(rows.drop("upto"), rows.drop("upto").limit(0))


def compact(spark: SparkSession, table: str, buckets: int = BUCKETS) -> int:
    """Merge base and deltas into a new base; returns the last batch in it.
    To be run by one job at a time; streams and readers may go on."""
    base, rows = _parts(spark, table)
    newest = rows.agg(F.max("upto")).first()[0] if rows is not None else None
    if newest is None or newest <= base:
        return base
    # a delta written after this moment belongs to the next compaction
    rows = rows.where(F.col("upto") <= newest).drop("upto")
    _write(merge_chain_state(rows, rows.limit(0)), f"{table}/base-{newest}", buckets)
    spark.range(1).select(F.lit(newest).cast("bigint").alias("upto")).write.mode("append").parquet(f"{table}/compactions")
    return newest
