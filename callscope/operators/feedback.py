"""Feedback, chains, sessions and rollups.

Feedback and chain updates are reduced to one row per key with
constant-size aggregates (`max_by`, `bool_or`) before they are joined to
events, so a join never multiplies rows and a hot key is combined
map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscope.operators.events import Config
from callscope.operators.ordering import rank_within
from callscope.session import stored

# Statuses whose failure log is limited to one per second,
# and the range of statuses that are logged at all.
RATE_LIMITED_STATUSES = (429, 499)
LOGGED_STATUS_RANGE = (400, 499)

# Fixed value: wire names of feedback fields that differ from ours.
FEEDBACK_WIRE_NAMES = {"feedback_key": "feedback_key", "rating": "rating", "better_response": "better_response",
                       "is_deleted": "is_deleted", "api_key": "apiKey"}


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def feedback_gate(feedback: DataFrame, cfg: Config = Config()) -> DataFrame:
    """B1: the key falls back to the default; feedback without a feedback
    key or an API key is dropped."""
    f = feedback.withColumn("api_key", F.coalesce(F.col("api_key"), F.lit(cfg.api_key).cast("string")))
    return f.where(_truthy(F.col("feedback_key")) & _truthy(F.col("api_key")))


def rating_in_range() -> Column:
    """Ratings are documented as 0..1 but not enforced: flag, never drop
    (null when there is no rating)."""
    return F.col("rating").between(0.0, 1.0)


def chain_gate(updates: DataFrame, cfg: Config = Config()) -> DataFrame:
    """B2: chain updates without id or API key are dropped."""
    u = updates.withColumn("api_key", F.coalesce(F.col("api_key"), F.lit(cfg.api_key).cast("string")))
    return u.where(_truthy(F.col("id")) & _truthy(F.col("api_key")))


def feedback_body(feedback: DataFrame) -> Column:
    """K2: JSON body with the wire names; other names unchanged."""
    return F.to_json(F.struct(*[F.col(c).alias(w) for c, w in FEEDBACK_WIRE_NAMES.items()]))


def chain_upsert(updates: DataFrame) -> DataFrame:
    """K3: the result of each chain, last write wins by (ts, update_id)."""
    return updates.groupBy("id").agg(
        F.max_by("result", F.struct("ts", "update_id")).alias("result"),
        F.count(F.lit(1)).alias("n_updates"))


def feedback_by_key(feedback: DataFrame) -> DataFrame:
    """One row per feedback key: the latest rating and better response
    (by ts; a row without ts counts as oldest; ties broken by the values),
    and whether any feedback marked it deleted."""
    order = F.struct(F.col("ts"), F.col("rating"), F.col("better_response"))
    return feedback.groupBy("feedback_key").agg(
        F.max_by(F.struct("rating", "better_response"),
                 F.when(F.col("rating").isNotNull() | F.col("better_response").isNotNull(), order))
        .alias("fb"),
        F.bool_or(F.coalesce(F.col("is_deleted"), F.lit(False))).alias("is_deleted"),
        F.count(F.lit(1)).alias("n_feedback"))


def event_feedback(events: DataFrame, feedback: DataFrame) -> DataFrame:
    """B3 + B4: events with their rating, better response and deleted flag
    (the event is kept; `is_deleted` marks it)."""
    fb = feedback_by_key(feedback).withColumnRenamed("feedback_key", "_fb_key")
    # rows without a key (run errors) match nothing; their call ids spread them over the join's tasks
    apart = F.col("call_id") if "call_id" in events.columns else F.lit("")
    key = F.coalesce(F.col("feedback_key"), F.concat(F.lit("none-"), apart))
    j = events.withColumn("_key", key).join(
        fb, (F.col("_key") == F.col("_fb_key")) & F.col("feedback_key").isNotNull(), "left").drop("_key", "_fb_key")
    return j.withColumns({
        "rating": F.col("fb.rating"),
        "better_response": F.col("fb.better_response"),
        "is_deleted": F.coalesce(F.col("is_deleted"), F.lit(False)),
    }).drop("fb", "n_feedback")


def live_events(events_with_feedback: DataFrame) -> DataFrame:
    """B4 live view: events not marked deleted."""
    return events_with_feedback.where(~F.col("is_deleted"))


def sessions(events: DataFrame) -> DataFrame:
    """Events of a chat id in order: position in the chat (by start
    time, then call id), computed without one task per chat. The events are
    built and stored once; cuts, counts and positions read the stored rows."""
    e = stored(events.where(F.col("chat_id").isNotNull()), "session-events")
    return rank_within(e, "chat_id", ["started_at", "call_id"], "session_seq")


def session_summary(events: DataFrame) -> DataFrame:
    """B5 per chat: size, span and tokens, all map-side combinable."""
    return events.where(F.col("chat_id").isNotNull()).groupBy("chat_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min_by("call_id", F.struct("started_at", "call_id")).alias("first_call"),
        F.max_by("call_id", F.struct("started_at", "call_id")).alias("last_call"),
        F.sum("response_metrics.usage.total_tokens").alias("total_tokens"),
        F.sum("response_time").alias("total_time_ms"))


def chains(events: DataFrame, updates: DataFrame) -> DataFrame:
    """Events grouped by chain id, with the chain's result from K3."""
    per_chain = events.where(F.col("chain_id").isNotNull()).groupBy("chain_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct("chat_id").alias("n_chats"),
        F.sum("response_metrics.usage.total_tokens").alias("total_tokens"))
    res = chain_upsert(updates).select(F.col("id").alias("chain_id"), "result", "n_updates")
    return per_chain.join(res, "chain_id", "left")


def template_rollup(events: DataFrame, feedback: DataFrame | None = None,
                    quantiles: tuple[tuple[float, str], ...] = ((0.5, "p50_ms"), (0.95, "p95_ms"))) -> DataFrame:
    """Per template name: calls, errors, tokens, latency (total and
    exact nearest-rank quantiles) and ratings, in one pass over the events.

    Events are first reduced to a (template, latency) histogram carrying
    every partial sum (map-side combined; its size is bounded by the
    distinct latencies of a template, never by its number of calls). The
    quantiles are a running count over that histogram, and the totals are
    sums of its rows.
    """
    e = event_feedback(events, feedback) if feedback is not None else events.withColumn(
        "rating", F.lit(None).cast("double"))
    key, rt = "prompt_template_name", "response_time"
    hist = e.groupBy(key, rt).agg(
        F.count(F.lit(1)).alias("_c"),
        F.count(F.col("response_errors")).alias("_err"),
        F.sum("response_metrics.usage.prompt_tokens").alias("_pt"),
        F.sum("response_metrics.usage.completion_tokens").alias("_ct"),
        F.count("rating").alias("_nr"),
        F.sum("rating").alias("_rs"),
    )
    running = Window.partitionBy(key).orderBy(rt).rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumns({"_cum": F.sum("_c").over(running), "_n": F.sum("_c").over(Window.partitionBy(key))})
    return h.groupBy(key).agg(
        F.sum("_c").alias("n_calls"),
        F.sum("_err").alias("n_errors"),
        F.sum("_pt").alias("prompt_tokens"),
        F.sum("_ct").alias("completion_tokens"),
        F.sum(F.col(rt) * F.col("_c")).alias("total_time_ms"),
        F.sum("_nr").alias("n_rated"),
        F.sum("_rs").alias("rating_sum"),
        *[F.min(F.when(F.col("_cum") >= F.ceil(F.col("_n") * F.lit(q)), F.col(rt))).alias(name)
          for q, name in quantiles],
    )


def error_log_sample(failures: DataFrame, debug: bool = False) -> DataFrame:
    """Which failed posts are logged. Debug logs all; otherwise only
    status 400-499, and 429 / 499 at most once per calendar second (the
    first one in it); other 4xx always."""
    if debug:
        return failures
    lo, hi = LOGGED_STATUS_RANGE
    f = failures.where(F.col("status").between(lo, hi))
    limited = F.col("status").isin(*RATE_LIMITED_STATUSES)
    # first failure per (status, second); the order counts for limited ones only
    w = Window.partitionBy("status", F.date_trunc("second", "ts")).orderBy("ts", "event_id")
    first = f.where(limited).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= 1).drop("_n")
    return f.where(~limited).unionByName(first)


def chain_state(updates: DataFrame) -> DataFrame:
    """K3 state per chain id: the winning update (result, ts, update_id)
    and the count, mergeable across batches."""
    return updates.groupBy("id").agg(
        F.max_by(F.struct("result", "ts", "update_id"), F.struct("ts", "update_id")).alias("w"),
        F.count(F.lit(1)).alias("n_updates")).select(
        "id", F.col("w.result").alias("result"), F.col("w.ts").alias("ts"),
        F.col("w.update_id").alias("update_id"), "n_updates")


def merge_chain_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Last write wins across both states, counts added."""
    both = old.unionByName(new)
    return both.groupBy("id").agg(
        F.max_by(F.struct("result", "ts", "update_id"), F.struct("ts", "update_id")).alias("w"),
        F.sum("n_updates").alias("n_updates")).select(
        "id", F.col("w.result").alias("result"), F.col("w.ts").alias("ts"),
        F.col("w.update_id").alias("update_id"), "n_updates")
