"""Jobs over your own logs.

    python -m callscope events  --calls PATH --chunks PATH --out PATH --quarantine-out PATH
    python -m callscope threads --runs PATH --assistants PATH --messages PATH --cursors PATH
                                --out PATH --cursors-out PATH
    python -m callscope rollup  --events PATH --feedback PATH --out PATH
    python -m callscope deletes --cursors PATH --messages PATH --deletes PATH
                                --cursors-out PATH --feedback-out PATH
    python -m callscope chains  --updates PATH --out PATH

and the same on folders that logs keep arriving in; a run takes what is new
since the last one with the same --checkpoint and ends:

    python -m callscope stream-results --chunks DIR --out PATH --checkpoint PATH
    python -m callscope stream-threads --runs DIR --messages DIR --assistants PATH --cursors PATH
                                       --out PATH --checkpoint PATH
    python -m callscope stream-feedback --feedback DIR --out PATH --checkpoint PATH
    python -m callscope stream-chains  --updates DIR --out PATH --checkpoint PATH [--compact]

Logs are read with the schemas of `callscope.schemas`; outputs are written
to the given (shared) folders. Run with `spark-submit -m`-style launchers or
plain `python` for a local session.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from callscope import schemas
from callscope.operators import events as ev
from callscope.operators import feedback as fb
from callscope.operators import threads as th
from callscope.sources import sinks
from callscope.sources.tables import read_calls, read_chunks, read_log, stream_log


def _config(a: argparse.Namespace) -> ev.Config:
    return ev.Config(api_key=a.api_key, prompt_template_name=a.template_name,
                     allow_unnamed_prompts=a.allow_unnamed, redact_pii=not a.no_redact, chat_id=a.chat_id)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="callscope")
    p.add_argument("--format", default="parquet", help="input log format (parquet, json, orc)")
    p.add_argument("--api-key", default=None, help="default API key (E4)")
    p.add_argument("--template-name", default=None, help="default template name (E4)")
    p.add_argument("--chat-id", default=None, help="default chat id (E4)")
    p.add_argument("--allow-unnamed", action="store_true", help="record calls without a template name (E5)")
    p.add_argument("--no-redact", action="store_true", help="do not redact personal data")
    sub = p.add_subparsers(dest="job", required=True)
    e = sub.add_parser("events", help="calls + chunks -> event bodies (K1), by day")
    e.add_argument("--calls", required=True)
    e.add_argument("--chunks", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--quarantine-out", required=True, help="calls whose template cannot be resolved, with the reasons")
    e.add_argument("--strict", action="store_true", help="fail on a template error instead of quarantining")
    t = sub.add_parser("threads", help="one run step: assistant events (K1) and new cursors")
    for name in ("runs", "assistants", "messages", "cursors", "out", "cursors-out"):
        t.add_argument(f"--{name}", required=True)
    r = sub.add_parser("rollup", help="event table + feedback -> per-template figures (B7)")
    r.add_argument("--events", required=True, help="parquet event table (event schema)")
    r.add_argument("--feedback", required=True)
    r.add_argument("--out", required=True)
    d = sub.add_parser("deletes", help="deleted messages: rewound cursors (M7) and tombstone feedback (M8)")
    for name in ("cursors", "messages", "deletes", "cursors-out", "feedback-out"):
        d.add_argument(f"--{name}", required=True)
    c = sub.add_parser("chains", help="chain updates -> the last result of every chain (K3)")
    for name in ("updates", "out"):
        c.add_argument(f"--{name}", required=True)
    streams = {
        "stream-results": ("whole results of streamed calls from a chunk log (P1)", ("chunks",)),
        "stream-threads": ("assistant events from run and message logs, late messages beside them (P3)",
                           ("runs", "messages", "assistants", "cursors")),
        "stream-feedback": ("the latest feedback of every key (P5)", ("feedback",)),
        "stream-chains": ("chain updates as deltas of a chain table (K3)", ("updates",)),
    }
    for job, (text, names) in streams.items():
        s = sub.add_parser(job, help=text)
        for name in (*names, "out", "checkpoint"):
            s.add_argument(f"--{name}", required=True)
        if job == "stream-chains":
            s.add_argument("--compact", action="store_true", help="merge base and deltas into a new base afterwards")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"callscope-{a.job}").getOrCreate()
    cfg = _config(a)
    if a.job == "events":
        calls = read_calls(spark, a.calls, a.format)
        chunks = read_chunks(spark, a.chunks, a.format)
        if a.strict:
            ev.prepared_calls(calls, cfg, strict=True).write.format("noop").mode("overwrite").save()
        ev.quarantined_calls(calls, cfg).write.mode("overwrite").json(a.quarantine_out)
        sinks.write_event_bodies(ev.call_events(calls, chunks, cfg), a.out)
    elif a.job == "threads":
        runs = read_log(spark, a.runs, schemas.RUNS, a.format)
        asst = read_log(spark, a.assistants, schemas.ASSISTANTS, a.format)
        msgs = read_log(spark, a.messages, schemas.MESSAGES, a.format)
        cursors = read_log(spark, a.cursors, schemas.CURSORS, a.format)
        # events first, then cursors: a rerun after a failure sends the same keys again
        sinks.write_event_bodies(th.assistant_events(runs, asst, msgs, cursors, cfg), a.out)
        th.cursor_advance(runs, msgs, cursors).write.mode("overwrite").parquet(a.cursors_out)
    elif a.job == "deletes":
        cursors = read_log(spark, a.cursors, schemas.CURSORS, a.format)
        msgs = read_log(spark, a.messages, schemas.MESSAGES, a.format)
        deletes = read_log(spark, a.deletes, schemas.DELETES, a.format)
        # tombstones first, then cursors: a rerun sends the same keys again
        sinks.write_feedback_bodies(fb.feedback_gate(th.delete_tombstones(deletes, cfg), cfg), a.feedback_out)
        th.cursor_rewind(cursors, msgs, deletes).write.mode("overwrite").parquet(a.cursors_out)
    elif a.job == "rollup":
        events = spark.read.parquet(a.events)
        feedback = fb.feedback_gate(read_log(spark, a.feedback, schemas.FEEDBACK, a.format), cfg)
        fb.template_rollup(events, feedback).write.mode("overwrite").parquet(a.out)
    elif a.job == "chains":
        updates = read_log(spark, a.updates, schemas.CHAIN_UPDATES, a.format)
        fb.chain_upsert(fb.chain_gate(updates, cfg)).write.mode("overwrite").parquet(a.out)
    else:
        _stream(spark, a, cfg)


def _stream(spark: SparkSession, a: argparse.Namespace, cfg: ev.Config) -> None:
    """The stream jobs: start, take what is there, end."""
    from callscope.streaming import assembly, chain_table, jobs, thread_runs
    jobs.ensure_rocksdb(spark)
    if a.job == "stream-results":
        chunks = stream_log(spark, a.chunks, schemas.CHUNKS, a.format)
        queries = [assembly.write_results(chunks, a.out, a.checkpoint)]
    elif a.job == "stream-threads":
        sent, errors = thread_runs.stream_assistant_events(
            stream_log(spark, a.runs, schemas.RUNS, a.format), read_log(spark, a.assistants, schemas.ASSISTANTS, a.format),
            stream_log(spark, a.messages, schemas.MESSAGE_LOG, a.format), read_log(spark, a.cursors, schemas.CURSORS, a.format), cfg)
        queries = thread_runs.write_assistant_events(sent, errors, a.out, a.checkpoint)
    elif a.job == "stream-feedback":
        latest = jobs.latest_by_key(fb.feedback_gate(stream_log(spark, a.feedback, schemas.FEEDBACK, a.format), cfg))
        queries = [latest.writeStream.format("parquet").option("path", a.out).option("checkpointLocation", a.checkpoint)
                   .trigger(availableNow=True).start()]
    else:
        updates = stream_log(spark, a.updates, schemas.CHAIN_UPDATES, a.format)
        queries = [chain_table.stream_chain_upsert(updates, a.out, a.checkpoint, cfg=cfg)]
    for q in queries:
        q.awaitTermination()
    if a.job == "stream-chains" and a.compact:
        chain_table.compact(spark, a.out)


if __name__ == "__main__":
    main()
