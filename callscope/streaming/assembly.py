"""Whole results of streamed calls from an unbounded chunk log.

Keyed state gathers the chunks of a call until it is over; then all of them
leave the state together, and the micro-batch that gets them assembles them
with the batch operators (A1-A8). So a stream gives what a batch over the same
chunks gives: text, tool calls, function calls, usage, finish reason, first
chunk and last metrics.

A call is over once the watermark is `SETTLE_MS` past its last chunk, if it has
a chunk with usage or a finish reason, and once it is `TIMEOUT_MS` past it
otherwise: its result is then marked incomplete. Chunks may come in any order
within the watermark's delay, and again: a chunk is known by its `seq`. A call
that was sent leaves a mark for `TIMEOUT_MS`, so chunks that are delivered
again give no second row.

State is a map from a block of `seq` to its chunks: a micro-batch rewrites the
blocks it adds to, not the call.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from callscope import schemas
from callscope.operators.assemble import assemble_stream

# the processor runs in Python workers: shipped by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 256
SETTLE_MS = 10_000
TIMEOUT_MS = 600_000
#: What assembly reads of a chunk (all but the call it is grouped by and its time).
BODY = T.StructType([f for f in schemas.CHUNKS if f.name not in ("call_id", "seq", "ts")])
RELEASED = "call_id string, seq bigint, complete boolean, body string"


def ends_call() -> Column:
    """The chunk says that its call is over."""
    finish = F.col("finish_reason")
    return F.col("usage").isNotNull() | (finish.isNotNull() & (finish != ""))


class ChunkGatherer(StatefulProcessor):
    """Chunks of one call until it is over (see the module)."""

    def __init__(self, settle_ms: int, timeout_ms: int):
        self.settle_ms, self.timeout_ms = settle_ms, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block bigint", "seqs array<bigint>, bodies array<string>")
        self.call = handle.getValueState("call", "last_ms bigint, ended boolean, sent boolean, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, ended, sent, due = self.call.get() if self.call.exists() else (0, False, False, None)
        if due is not None and not sent and due <= timerValues.getCurrentWatermarkInMs():
            # it was over before these rows, whose timer comes after them
            yield from self._release(key, last, ended, timerValues)
            sent = True
        new: dict[int, dict[int, str]] = {}
        for pdf in rows:
            if sent:
                continue
            last = max(last, int(pdf["ms"].max()))
            ended = bool(ended or pdf["ends"].any())
            for seq, body in zip(pdf["seq"].tolist(), pdf["body"].tolist()):
                new.setdefault(seq // BLOCK, {})[seq] = body
        if sent:
            return
        for block, chunks in new.items():
            if self.blocks.containsKey((block,)):
                chunks = {**dict(zip(*self.blocks.getValue((block,)))), **chunks}
            self.blocks.updateValue((block,), (list(chunks), list(chunks.values())))
        if due is not None:
            self.handle.deleteTimer(due)
        due = last + (self.settle_ms if ended else self.timeout_ms)
        self.handle.registerTimer(due)
        self.call.update((last, ended, False, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, ended, sent, due = self.call.get()
        if due > timerValues.getCurrentWatermarkInMs():
            return   # the timer of a time that has moved on
        if sent:
            self.call.clear()
        else:
            yield from self._release(key, last, ended, timerValues)

    def _release(self, key, last: int, ended: bool, timerValues) -> Iterator[pd.DataFrame]:
        """All chunks of the call; a mark stays."""
        for block in sorted(k[0] for k in self.blocks.keys()):
            seqs, bodies = self.blocks.getValue((block,))
            yield pd.DataFrame({"call_id": key[0], "seq": seqs, "complete": ended, "body": bodies})
        self.blocks.clear()
        due = timerValues.getCurrentWatermarkInMs() + self.timeout_ms
        self.handle.registerTimer(due)
        self.call.update((last, ended, True, due))

    def close(self) -> None:
        pass


def released_chunks(chunks: DataFrame, delay: str = "10 minutes", settle_ms: int = SETTLE_MS,
                    timeout_ms: int = TIMEOUT_MS) -> DataFrame:
    """The chunks of each call (CHUNKS rows without `ts`) in the micro-batch in
    which it is over, with `complete`. Rows without call id, seq or ts are
    left out: no call or place can be told."""
    rows = chunks.where(F.col("call_id").isNotNull() & F.col("seq").isNotNull() & F.col("ts").isNotNull())
    rows = rows.withWatermark("ts", delay).select(
        "call_id", "seq", "ts", F.unix_millis("ts").alias("ms"), F.coalesce(ends_call(), F.lit(False)).alias("ends"),
        F.to_json(F.struct(*BODY.names)).alias("body"))
    out = rows.groupBy("call_id").transformWithStateInPandas(
        ChunkGatherer(settle_ms, timeout_ms), RELEASED, "append", "eventtime")
    return out.select("call_id", "seq", "complete", F.from_json("body", BODY).alias("b")).select(
        "call_id", "seq", "complete", "b.*")


def assemble_released(released: DataFrame) -> DataFrame:
    """The result of every call of one micro-batch, as `assemble_stream` has it, with `complete`."""
    whole = released.groupBy("call_id").agg(F.bool_and("complete").alias("complete"))
    return assemble_stream(released).join(whole, "call_id")


def write_results(chunks: DataFrame, out: str, checkpoint: str, **times):
    """Start the job: each micro-batch's results go to a folder named by the
    batch, so a batch that is run again writes the same folder again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # whether a call is complete stands on all its rows: read them once
        batch.persist()
        assemble_released(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id:012d}")
        batch.unpersist()

    return (released_chunks(chunks, **times).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_results(spark: SparkSession, out: str) -> DataFrame | None:
    """All results written so far (None before the first batch)."""
    try:
        return spark.read.parquet(out).drop("batch")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
