"""The flagship plan: calls and chunk logs -> assembled results ->
templates resolved -> gates -> redaction -> events (chat, completion,
assistant) -> feedback and deletions joined -> per-template rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callscope.operators import events as ev
from callscope.operators import feedback as fb
from callscope.operators import threads as th
from callscope.sources import fixtures as fx


def all_events(spark: SparkSession, sf_dir: str, cfg: ev.Config = ev.Config()) -> DataFrame:
    calls = fx.calls(spark, sf_dir)
    msgs = fx.messages(spark, sf_dir)
    call_ev = ev.call_events(calls, fx.chunks(calls), cfg)
    asst_ev = th.assistant_events(fx.runs(spark, sf_dir), fx.assistants(spark, sf_dir), msgs,
                                  fx.cursors(msgs), cfg)
    return ev.events_all(call_ev, asst_ev)


def all_feedback(spark: SparkSession, sf_dir: str, cfg: ev.Config = ev.Config()) -> DataFrame:
    msgs = fx.messages(spark, sf_dir)
    return fb.feedback_gate(fx.feedback(spark, sf_dir), cfg).unionByName(
        th.delete_tombstones(fx.deletes(msgs), cfg))


def flagship(spark: SparkSession, sf_dir: str, cfg: ev.Config = ev.Config()) -> DataFrame:
    return fb.template_rollup(all_events(spark, sf_dir, cfg), all_feedback(spark, sf_dir, cfg))
