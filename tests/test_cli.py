"""The batch jobs of `python -m callscope` on logs written to disk."""

from callscope.__main__ import main
from callscope.plans.flagship import all_events
from callscope.session import scratch_path
from callscope.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_jobs_on_written_logs(spark):
    d = scratch_path(spark, "tests", "cli")
    calls, msgs = fx.calls(spark, SF), fx.messages(spark, SF)
    calls.write.json(f"{d}/calls")
    fx.chunks(calls).write.json(f"{d}/chunks")
    fx.runs(spark, SF).write.parquet(f"{d}/runs")
    fx.assistants(spark, SF).write.parquet(f"{d}/asst")
    msgs.write.parquet(f"{d}/msgs")
    fx.cursors(msgs).write.parquet(f"{d}/cursors")
    events = all_events(spark, SF)
    events.write.parquet(f"{d}/events")
    fx.feedback(spark, SF).write.parquet(f"{d}/fb")
    main(["--format", "json", "--api-key", "key-default", "events", "--calls", f"{d}/calls",
          "--chunks", f"{d}/chunks", "--out", f"{d}/out_events", "--quarantine-out", f"{d}/out_bad"])
    # every named call is either quarantined or prepared for its event
    from callscope.operators import events as ev
    from callscope.sources.tables import read_calls
    calls, cfg = read_calls(spark, f"{d}/calls", "json"), ev.Config(api_key="key-default")
    named = ev.gate_named(ev.apply_config(calls, cfg), cfg)
    bad = spark.read.json(f"{d}/out_bad")
    assert bad.count() > 0 and bad.where("errors = ''").count() == 0
    assert bad.count() + ev.prepared_calls(calls, cfg).count() == named.count()
    main(["--api-key", "key-default", "threads", "--runs", f"{d}/runs", "--assistants", f"{d}/asst",
          "--messages", f"{d}/msgs", "--cursors", f"{d}/cursors", "--out", f"{d}/out_asst",
          "--cursors-out", f"{d}/out_cursors"])
    main(["--api-key", "key-default", "rollup", "--events", f"{d}/events", "--feedback", f"{d}/fb",
          "--out", f"{d}/out_rollup"])
    n_events = spark.read.text(f"{d}/out_events").count() + spark.read.text(f"{d}/out_asst").count()
    assert n_events == events.count()
    assert spark.read.parquet(f"{d}/out_rollup").count() == events.select("prompt_template_name").distinct().count()


def test_deletes_job(spark):
    d = scratch_path(spark, "tests", "cli-deletes")
    msgs = fx.messages(spark, SF)
    msgs.write.parquet(f"{d}/msgs")
    fx.cursors(msgs).write.parquet(f"{d}/cursors")
    dels = fx.deletes(msgs)
    dels.write.parquet(f"{d}/deletes")
    main(["--api-key", "key-default", "deletes", "--cursors", f"{d}/cursors", "--messages", f"{d}/msgs",
          "--deletes", f"{d}/deletes", "--cursors-out", f"{d}/out_cursors", "--feedback-out", f"{d}/out_fb"])
    assert spark.read.text(f"{d}/out_fb").count() == dels.count()
    from callscope.operators import threads as th
    want = {tuple(r) for r in th.cursor_rewind(fx.cursors(msgs), msgs, dels).collect()}
    assert {tuple(r) for r in spark.read.parquet(f"{d}/out_cursors").collect()} == want


def test_stream_jobs_go_on_from_their_checkpoint(spark):
    """Two runs of each job, a file arriving in between; the second takes only what is new."""
    import datetime as dt

    from pyspark.sql import functions as F

    from callscope import schemas
    from callscope.streaming.assembly import read_results
    from callscope.streaming.chain_table import read_chain_table
    d = scratch_path(spark, "tests", "cli-streams")
    t0, far = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{d}/{name}")

    def chunk(call, seq, content=None, finish=None, ts=t0):
        return (call, seq, ts, None, content, None, None, None, finish, None, None)

    def job(*args):
        main(["--api-key", "k", *args])

    put("chunks", [chunk("a", 0, "He"), chunk("b", 0, "cut")], schemas.CHUNKS)
    put("feedback", [("f", 0.0, None, None, "k", t0), ("f", 1.0, "x", None, "k", t0 + dt.timedelta(hours=1))], schemas.FEEDBACK)
    put("updates", [(1, "c", "one", "k", t0)], schemas.CHAIN_UPDATES)
    put("runs", [("r", "T", "completed", "as", "tmpl", None, None, None, t0)], schemas.RUNS)
    put("messages", [("T", "T-0", 0, "user", [("text", "hi")], t0), ("T", "T-1", 1, "user", [("text", "there")], t0)], schemas.MESSAGE_LOG)
    spark.createDataFrame([("as", "Ann", "be kind", "m")], schemas.ASSISTANTS).write.parquet(f"{d}/assistants")
    spark.createDataFrame([("T", "T-0", 0)], schemas.CURSORS).write.parquet(f"{d}/cursors")

    def run_all():
        job("stream-results", "--chunks", f"{d}/chunks", "--out", f"{d}/o1", "--checkpoint", f"{d}/c1")
        job("stream-threads", "--runs", f"{d}/runs", "--messages", f"{d}/messages", "--assistants", f"{d}/assistants",
            "--cursors", f"{d}/cursors", "--out", f"{d}/o2", "--checkpoint", f"{d}/c2")
        job("stream-feedback", "--feedback", f"{d}/feedback", "--out", f"{d}/o3", "--checkpoint", f"{d}/c3")
        job("stream-chains", "--updates", f"{d}/updates", "--out", f"{d}/o4", "--checkpoint", f"{d}/c4", "--compact")

    run_all()
    assert [tuple(r) for r in read_chain_table(spark, f"{d}/o4").select("id", "result", "n_updates").collect()] == [("c", "one", 1)]
    put("chunks", [chunk("a", 1, "llo", "stop"), chunk("end", 0, "x", ts=far)], schemas.CHUNKS)
    put("feedback", [("end", 1.0, None, None, "k", far)], schemas.FEEDBACK)
    put("updates", [(2, "c", "two", "k", far)], schemas.CHAIN_UPDATES)
    put("runs", [("end", "end", "completed", "as", "tmpl", None, None, None, far)], schemas.RUNS)
    put("messages", [("end", "end-0", 0, "user", [("text", "x")], far)], schemas.MESSAGE_LOG)
    run_all()
    got = {r.call_id: (r.chat_text, r.complete) for r in read_results(spark, f"{d}/o1").collect()}
    assert got == {"a": ("Hello", True), "b": ("cut", False)}
    events = spark.read.parquet(f"{d}/o2/events").collect()
    assert [(r.call_id, r.response, r.api_key, r.started_at) for r in events] == [("T-1", "there", "k", t0)]
    late = spark.read.parquet(f"{d}/o2/late")
    assert [r.call_id for r in late.collect()] == ["T-0"]
    feedback = spark.read.parquet(f"{d}/o3").where(F.col("feedback_key") == "f").collect()
    assert [(r.rating, r.better_response, r.n_copies) for r in feedback] == [(1.0, "x", 2)]
    job("chains", "--updates", f"{d}/updates", "--out", f"{d}/o5")
    want = [("c", "two", 2)]
    assert [tuple(r) for r in read_chain_table(spark, f"{d}/o4").select("id", "result", "n_updates").collect()] == want
    assert [tuple(r) for r in spark.read.parquet(f"{d}/o5").collect()] == want
