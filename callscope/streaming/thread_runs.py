"""Assistant events from unbounded logs of runs and thread messages.

Runs and messages of a thread meet in keyed state. A thread's first recorded
completed run (gates M1 and M2, by completion time, then id) reads its
messages: those after the cursor leave in `pos` order once the watermark has
passed their time and the run's, so whatever order they came in, they are sent
in the order of the thread, each with the columns of the run. The cursor, which
starts from the stored one, then moves to the last supported message sent.

A message at or before the cursor, delivered again or too late, is not an
event; it leaves at once with `late` set, for a side output. (Spark itself
drops rows older than the watermark and counts them in the query's metrics.)

Waiting messages are a map by (pos, msg_id), so copies take one place; a timer
stands at the earliest time at which something can be sent.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from callscope.operators.events import Config, conform_events, gate_api_key
from callscope.operators.threads import message_supported, run_error_events, run_gate, run_message_events, run_route

# the processor runs in Python workers: shipped by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN_COLUMNS = ("run_id", "assistant_id", "prompt_template_name", "api_key", "model")
#: What is known of a thread row: a message (pos is set) or a run.
ROW = "thread_id string, ts timestamp, msg_id string, pos bigint, role string, text string, supported boolean, " \
      "run_id string, assistant_id string, prompt_template_name string, api_key string, model string"
SENT = "thread_id string, msg_id string, pos bigint, role string, text string, run_id string, assistant_id string, " \
       "prompt_template_name string, api_key string, model string, completed_ms bigint, late boolean"


class ThreadReader(StatefulProcessor):
    """Messages of one thread, sent in order by its first completed run."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", "pos bigint, msg_id string")
        self.run = handle.getValueState("run", "ms bigint, run_id string, assistant_id string, "
                                               "prompt_template_name string, api_key string, model string")
        self.waiting = handle.getMapState("waiting", "pos bigint, msg_id string",
                                          "ms bigint, supported boolean, role string, text string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self.cursor.update((int(row["last_pos"]), str(row["last_msg_id"])))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        run = self.run.get() if self.run.exists() else None
        began = run is not None and timerValues.getCurrentWatermarkInMs() >= run[0]
        if began:
            # what is due goes before these rows, whose timer comes after them
            yield from self._send(key, run, timerValues)
        at = self.cursor.get()[0] if self.cursor.exists() else -1
        late, times = [], []
        for pdf in rows:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            for row in pdf.to_dict("records"):
                if row["pos"] is None:
                    found = (int(row["ms"]), *(row[c] for c in RUN_COLUMNS))
                    # the run that has begun to send stays the reader
                    if not began and (run is None or found[:2] < tuple(run[:2])):
                        run = found
                        times.append(run[0])
                elif row["pos"] <= at:
                    late.append(row)
                else:
                    self.waiting.updateValue((int(row["pos"]), row["msg_id"]),
                                             (int(row["ms"]), bool(row["supported"]), row["role"], row["text"]))
                    times.append(int(row["ms"]))
        if run is not None:
            self.run.update(tuple(run))
            if times or not began:
                self._wake(max(min(times, default=run[0]), run[0]), timerValues)
        if late:
            yield self._frame(key[0], [(r["msg_id"], int(r["pos"]), r["role"], r["text"]) for r in late], run, True)

    def _wake(self, ms: int, timerValues) -> None:
        """A timer at `ms`, or right after the watermark where that is past."""
        self.handle.registerTimer(max(ms, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        run = self.run.get()
        if run[0] > now:
            self._wake(run[0], timerValues)
        else:
            yield from self._send(key, run, timerValues)

    def _send(self, key, run: tuple, timerValues) -> Iterator[pd.DataFrame]:
        """The waiting messages that the watermark has passed, in thread order."""
        now = timerValues.getCurrentWatermarkInMs()
        sent, last = [], None
        for pos, msg_id in sorted(tuple(k) for k in self.waiting.keys()):
            ms, supported, role, text = self.waiting.getValue((pos, msg_id))
            if ms > now:
                # those behind it wait for it
                self._wake(ms, timerValues)
                break
            self.waiting.removeKey((pos, msg_id))
            if supported:
                sent.append((msg_id, pos, role, text))
                last = (pos, msg_id)
        if last is not None:
            self.cursor.update(last)
            yield self._frame(key[0], sent, run, False)

    @staticmethod
    def _frame(thread: str, rows: list, run: tuple | None, late: bool) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["msg_id", "pos", "role", "text"])
        out.insert(0, "thread_id", thread)
        for column, value in zip((*RUN_COLUMNS, "completed_ms"), (*run[1:], run[0]) if run else (None,) * 6):
            out[column] = pd.Series([value] * len(out), dtype="Int64" if column == "completed_ms" else object)
        out["late"] = late
        return out

    def close(self) -> None:
        pass


def _empty(columns: list[str]) -> list:
    types = dict(c.strip().split(" ") for c in ROW.split(","))
    return [F.lit(None).cast(types[c]).alias(c) for c in columns]


def thread_rows(runs: DataFrame, messages: DataFrame, delay: str) -> DataFrame:
    """Recorded completed runs (by `completed_at`) and messages (by `ts`) as
    one stream; each side has its watermark, the smaller one counts."""
    reading = run_route(run_gate(runs)).where((F.col("route") == "messages") & F.col("completed_at").isNotNull())
    r = reading.withColumnRenamed("completed_at", "ts").withWatermark("ts", delay).select(
        "thread_id", "ts", *_empty(["msg_id", "pos", "role", "text", "supported"]), *RUN_COLUMNS)
    m = messages.where(F.col("pos").isNotNull()).withWatermark("ts", delay).select(
        "thread_id", "ts", "msg_id", "pos", "role", F.get(F.col("content"), 0)["value"].alias("text"),
        message_supported().alias("supported"), *_empty(list(RUN_COLUMNS)))
    return r.unionByName(m).where(F.col("thread_id").isNotNull())


def sent_messages(runs: DataFrame, messages: DataFrame, cursors: DataFrame | None = None,
                  delay: str = "10 minutes") -> DataFrame:
    """The messages that runs send, in thread order, and the late ones
    (`late`). `runs` (RUNS) and `messages` (MESSAGES with `ts`) are streams,
    `cursors` (CURSORS) a table."""
    rows = thread_rows(runs, messages, delay).withColumn("ms", F.unix_millis("ts"))
    return rows.groupBy("thread_id").transformWithStateInPandas(
        ThreadReader(), SENT, "append", "eventtime",
        initialState=None if cursors is None else cursors.groupBy("thread_id"))


def stream_assistant_events(runs: DataFrame, assistants: DataFrame, messages: DataFrame, cursors: DataFrame | None = None,
                            cfg: Config = Config(), delay: str = "10 minutes") -> tuple[DataFrame, DataFrame]:
    """E3 with E6 on streams: (message events with `late`, run error events), each in
    the event schema; `assistants` is a table. Late rows are for a side
    output, see `write_assistant_events`."""
    sent = sent_messages(runs, messages, cursors, delay)
    sent = sent.withColumn("completed_at", F.timestamp_millis("completed_ms"))
    built = run_message_events(sent, assistants, cfg)
    errors = run_error_events(runs, assistants, cfg)
    return built, gate_api_key(conform_events(errors))


def write_assistant_events(message_events: DataFrame, errors: DataFrame, out: str, checkpoint: str) -> list:
    """Start the two jobs: events to `{out}/events`, late messages to
    `{out}/late`; folders are named by batch, so a batch that is run again
    writes the same folders again. Returns the started queries."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # state is read once for both outputs
        batch.persist()
        gate_api_key(conform_events(batch.where(~F.col("late")))).write.mode("overwrite").parquet(f"{out}/events/batch=m{batch_id:012d}")
        batch.where("late").select("call_id", "chat_id", "response").write.mode("overwrite").parquet(
            f"{out}/late/batch=m{batch_id:012d}")
        batch.unpersist()

    def write_errors(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/events/batch=e{batch_id:012d}")

    return [df.writeStream.foreachBatch(fn).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
            for df, fn, name in ((message_events, write, "messages"), (errors, write_errors, "errors"))]
