"""Assistant thread runs (M1-M8, J1, J2) and assistant events.

A batch step over four tables: runs, assistants, messages (with a `pos`
order per thread) and stored cursors. The cursor is a (message id, pos)
pair; `pos` survives the deletion of the message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscope.operators.events import MODEL_PROVIDER, Config, conform_events, gate_api_key
from callscope.operators.ordering import previous_within, rank_within

# Fixed values of the reference's run handling.
ERROR_STATUSES = ("failed", "cancelled", "incomplete")  # run statuses that give an error event
ASSISTANT_RESPONSE_TIME = 1  # assistant events carry 1 ms
ASSISTANT_TEMPLATE = (("assistant", None), ("chat_history", "{chat_history}"))  # None: the instructions


def run_route(runs: DataFrame) -> DataFrame:
    """M1: failed/cancelled/incomplete -> 'error'; completed -> 'messages';
    anything else -> 'ignore'."""
    s = F.col("status")
    return runs.withColumn("route", F.when(s.isin(*ERROR_STATUSES), "error")
                           .when(s == "completed", "messages").otherwise("ignore"))


def run_gate(runs: DataFrame) -> DataFrame:
    """M2: only runs that carry their own template name are recorded."""
    n = F.col("prompt_template_name")
    return runs.where(n.isNotNull() & (n != ""))


def run_assistant_join(runs: DataFrame, assistants: DataFrame) -> DataFrame:
    """The run's assistant, by id. Spark broadcasts `assistants` when its
    measured size is under `spark.sql.autoBroadcastJoinThreshold` (AQE also
    re-plans at run time) and shuffles both sides otherwise."""
    a = assistants.select("assistant_id", F.col("name").alias("a_name"),
                          F.col("instructions").alias("a_instructions"), F.col("model").alias("a_model"))
    return runs.join(a, "assistant_id", "left")


def messages_after_cursor(messages: DataFrame, cursors: DataFrame, unsupported_first: bool = False) -> DataFrame:
    """Per thread, all messages after the cursor, `n_in_run` numbering
    them oldest first (`unsupported_first` drops unsupported ones before).

    The cursor is one narrow row per thread; positions are counted without
    one task per thread (see `ordering`)."""
    c = cursors.select("thread_id", F.col("last_pos").alias("cursor_pos"))
    after = messages.join(c, "thread_id", "left").where(F.col("pos") > F.coalesce(F.col("cursor_pos"), F.lit(-1)))
    if unsupported_first:
        after = after.where(message_supported())
    return rank_within(after, "thread_id", ["pos", "msg_id"], "n_in_run")


def message_supported() -> Column:
    """M3: the message has content and its first part is text."""
    return F.coalesce(F.get(F.col("content"), 0)["type"] == "text", F.lit(False))


def _assistant_event(route_error: bool, cfg: Config) -> list[Column]:
    """E3 columns shared by message and error events (after J1); `completed_at`
    is when the run ended."""
    name = F.coalesce(F.col("a_name"), F.col("assistant_id"))
    template = F.array(*[
        F.struct(F.lit(role).alias("role"),
                 (F.col("a_instructions") if content is None else F.lit(content)).alias("content"))
        for role, content in ASSISTANT_TEMPLATE])
    return [
        F.lit("assistant").alias("event_kind"),
        F.coalesce(F.col("api_key"), F.lit(cfg.api_key).cast("string")).alias("api_key"),
        name.alias("prompt_template_name"),
        F.coalesce(F.col("prompt_template_name"), name).alias("api_name"),
        F.lit(None).cast("string").alias("prompt_template_text"),
        template.alias("prompt_template_chat"),
        F.lit(ASSISTANT_RESPONSE_TIME).cast("bigint").alias("response_time"),
        F.col("completed_at").alias("started_at"),
        F.struct(F.lit(MODEL_PROVIDER).alias("model_provider"), F.lit("assistants").alias("model_type"),
                 F.coalesce(F.col("model"), F.col("a_model")).alias("model"),
                 F.lit(None).cast("int").alias("max_tokens"),
                 F.lit(None).cast("string").alias("extra")).alias("model_parameters"),
    ]


def run_error_events(runs: DataFrame, assistants: DataFrame, cfg: Config = Config()) -> DataFrame:
    """M1 'error' route: one event per failed run, chat id = thread id."""
    r = run_assistant_join(run_route(run_gate(runs)).where(F.col("route") == "error"), assistants)
    return r.select(
        *_assistant_event(True, cfg),
        F.col("run_id").alias("call_id"),
        F.lit(None).cast("string").alias("feedback_key"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.lit(None).cast("map<string,array<struct<role:string,content:string>>>").alias("history_params"),
        F.lit(None).cast("string").alias("response"),
        F.array(F.to_json(F.col("last_error"))).alias("response_errors"),
        F.col("thread_id").alias("chat_id"),
    )


def reading_runs(runs: DataFrame, numbered: bool = False) -> DataFrame:
    """M1 'messages' route: the completed, recorded runs, each with its place
    `run_no` among those of its thread by completion (`completed_at` where
    the log has it, then run id), from 1. Not `numbered`: the first only,
    which a map-side limit keeps to one row per thread and task."""
    r = run_route(run_gate(runs)).where(F.col("route") == "messages")
    order = ([F.col("completed_at").asc_nulls_last()] if "completed_at" in r.columns else []) + [F.col("run_id")]
    r = r.withColumn("run_no", F.row_number().over(Window.partitionBy("thread_id").orderBy(*order)))
    return r if numbered else r.where(F.col("run_no") <= 1)


def run_messages(runs: DataFrame, messages: DataFrame, cursors: DataFrame, page: int | None = None) -> DataFrame:
    """J2 + M3: the supported messages that completed runs send, each with
    the columns of the run that reads it.

    A run reads everything after the cursor and moves it along, so the first
    completed run of a thread sends all its new messages and later ones find
    none. With `page`, a run reads at most that many (unsupported ones count
    too) and the next one goes on where it stopped; what no run reaches is
    read by a later batch.

    Runs and cursors are joined to one narrow row per thread first; messages
    are joined to it once."""
    c = cursors.select("thread_id", F.coalesce("last_pos", F.lit(-1)).alias("cursor_pos"))
    if page is None:
        r = reading_runs(runs).join(c, "thread_id", "left")
        m = messages.join(r, "thread_id").where(F.col("pos") > F.coalesce(F.col("cursor_pos"), F.lit(-1)))
    else:
        r = reading_runs(runs, numbered=True)
        known = r.select("thread_id").distinct().join(c, "thread_id", "left")
        narrow = messages.select("thread_id", "msg_id", "pos").join(known, "thread_id").where(
            F.col("pos") > F.coalesce(F.col("cursor_pos"), F.lit(-1)))
        at = rank_within(narrow, "thread_id", ["pos", "msg_id"], "n_in_run")
        at = at.withColumn("run_no", F.ceil(F.col("n_in_run") / F.lit(page)).cast("int")).drop("pos", "cursor_pos")
        m = messages.join(at.join(r, ["thread_id", "run_no"]), ["thread_id", "msg_id"])
    return m.where(message_supported())


def message_events(runs: DataFrame, assistants: DataFrame, messages: DataFrame, cursors: DataFrame,
                   cfg: Config = Config(), page: int | None = None) -> DataFrame:
    """M4 + E3: one event per supported message: response = its text,
    `chat_history` param = that message, chat id = feedback key = its id."""
    m = run_messages(runs, messages, cursors, page).withColumn("text", F.get(F.col("content"), 0)["value"])
    return run_message_events(m, assistants, cfg)


def run_message_events(sent: DataFrame, assistants: DataFrame, cfg: Config = Config()) -> DataFrame:
    """M4 + E3 from messages (msg_id, role, text) with the columns of the run
    that reads them, in a table or a stream; a `late` column is kept."""
    m = run_assistant_join(sent, assistants)
    text = F.col("text")
    hist = F.create_map(F.lit("chat_history"),
                        F.array(F.struct(F.col("role").alias("role"), text.alias("content"))))
    return m.select(
        *_assistant_event(False, cfg),
        F.col("msg_id").alias("call_id"),
        F.col("msg_id").alias("feedback_key"),
        F.create_map().cast("map<string,string>").alias("params"),
        hist.alias("history_params"),
        text.alias("response"),
        F.lit(None).cast("array<string>").alias("response_errors"),
        F.col("msg_id").alias("chat_id"),
        *[c for c in ("late",) if c in m.columns],
    )


def cursor_advance(runs: DataFrame, messages: DataFrame, cursors: DataFrame, page: int | None = None) -> DataFrame:
    """M5: the cursor moves to the last supported message sent; threads
    without a new message keep theirs."""
    moved = _last_per_thread(run_messages(runs, messages, cursors, page))
    j = cursors.join(moved, "thread_id", "full")
    return j.select("thread_id",
                    F.coalesce(F.col("new_id"), F.col("last_msg_id")).alias("last_msg_id"),
                    F.coalesce(F.col("new_pos"), F.col("last_pos")).alias("last_pos"))


def _last_per_thread(df: DataFrame) -> DataFrame:
    """The message with the highest position per thread, combined map-side."""
    return df.groupBy("thread_id").agg(F.max(F.struct("pos", "msg_id")).alias("_m")).select(
        "thread_id", F.col("_m.msg_id").alias("new_id"), F.col("_m.pos").alias("new_pos"))


def prev_message(messages: DataFrame) -> DataFrame:
    """M6: the message just before each one in its thread (null for the
    first), computed without sending a thread to one task."""
    m = messages.select("thread_id", "msg_id", "pos")
    return previous_within(m, "thread_id", ["pos", "msg_id"], "msg_id", "prev_msg_id")


def cursor_rewind(cursors: DataFrame, messages: DataFrame, deletes: DataFrame) -> DataFrame:
    """M7: a cursor whose message is deleted moves to the last remaining
    message before it, or to "" (pos -1). Independent of deletion order.

    The threads of such cursors come first: messages are cut to them and to
    the positions before the cursor, then freed of the deleted ones."""
    gone = deletes.select("thread_id", F.col("msg_id").alias("last_msg_id")).distinct().withColumn("_gone", F.lit(True))
    marked = cursors.join(gone, ["thread_id", "last_msg_id"], "left")
    hit = marked.where("_gone").select("thread_id", F.col("last_pos").alias("cpos"))
    before = (messages.select("thread_id", "msg_id", "pos").join(hit, "thread_id")
              .where(F.col("pos") < F.col("cpos")).select("thread_id", "msg_id", "pos"))
    live = before.join(deletes.select("thread_id", "msg_id"), ["thread_id", "msg_id"], "left_anti")
    j = marked.join(_last_per_thread(live), "thread_id", "left")
    moved = F.col("_gone")
    return j.select("thread_id",
                    F.when(moved, F.coalesce("new_id", F.lit(""))).otherwise(F.col("last_msg_id")).alias("last_msg_id"),
                    F.when(moved, F.coalesce("new_pos", F.lit(-1).cast("bigint"))).otherwise(F.col("last_pos"))
                    .alias("last_pos"))


def delete_tombstones(deletes: DataFrame, cfg: Config = Config()) -> DataFrame:
    """M8: each deletion is feedback {key = message id, is_deleted = true}."""
    return deletes.select(
        F.col("msg_id").alias("feedback_key"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("string").alias("better_response"),
        F.lit(True).alias("is_deleted"),
        F.lit(cfg.api_key).cast("string").alias("api_key"),
        F.lit(None).cast("timestamp").alias("ts"),
    )


def assistant_events(runs: DataFrame, assistants: DataFrame, messages: DataFrame, cursors: DataFrame,
                     cfg: Config = Config(), page: int | None = None) -> DataFrame:
    """E3 with E6: message events and run error events in the event schema,
    those without an API key left out. Their time is the run's completion."""
    found = conform_events(message_events(runs, assistants, messages, cursors, cfg, page)) \
        .unionByName(conform_events(run_error_events(runs, assistants, cfg)))
    return gate_api_key(found)
