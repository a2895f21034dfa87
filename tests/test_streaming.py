"""A stream gives what its batch twin gives on the same rows."""

from callscope.streaming import jobs as sj

SF = "/root/testdata/sf0.001"


def test_stream_gate_equals_batch(spark):
    stream = {tuple(r) for r in sj.stream_gate(spark, SF).collect()}
    batch_in = spark.read.parquet(f"{SF}/events.parquet")
    batch = sj.gate_and_redact(sj.event_calls(batch_in)).select(
        "call_id", "api_key", "prompt_template_name", "chain_id", "response", "response_time")
    assert stream == {tuple(r) for r in batch.collect()}


def test_stream_event_sink_equals_batch_bodies(spark):
    from callscope.operators.events import conform_events
    from callscope.session import scratch_path
    from callscope.sources import sinks as sk
    base = scratch_path(spark, "tests", "bodies")
    events = conform_events(sj.gate_and_redact(sj.event_calls(sj.read_stream(spark, SF, "events", sj.EVENTS))))
    sk.stream_event_bodies(events, f"{base}/out", f"{base}/ckpt").awaitTermination()
    got = {tuple(r) for r in sk.read_event_bodies(spark, f"{base}/out").collect()}
    batch = conform_events(sj.gate_and_redact(sj.event_calls(spark.read.parquet(f"{SF}/events.parquet"))))
    want = {tuple(r) for r in sk.event_bodies(batch).select("call_id", "body").collect()}
    assert got == want and got


def test_restart_resumes_from_checkpoint(spark):
    from callscope.session import scratch_path
    base = scratch_path(spark, "tests", "resume")
    first = sj.run_available(sj.gate_and_redact(sj.event_calls(sj.read_stream(spark, SF, "events", sj.EVENTS))),
                             "resume", base=base).count()
    # the same job again: nothing new to read, nothing written twice
    again = sj.run_available(sj.gate_and_redact(sj.event_calls(sj.read_stream(spark, SF, "events", sj.EVENTS))),
                             "resume", base=base).count()
    assert first == again > 0


def test_log_stream_reads_what_the_batch_reader_reads(spark):
    from callscope import schemas
    from callscope.session import scratch_path
    from callscope.sources import fixtures as fx
    from callscope.sources.tables import read_chunks, stream_log
    base = scratch_path(spark, "tests", "logstream")
    fx.chunks(fx.calls(spark, SF)).write.json(f"{base}/chunks")
    stream = stream_log(spark, f"{base}/chunks", schemas.CHUNKS, "json", max_files_per_trigger=2)
    got = sj.run_available(stream.select("call_id", "seq", "content"), "logstream").collect()
    want = read_chunks(spark, f"{base}/chunks", "json").select("call_id", "seq", "content").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_stream_asm_session_writes_every_call(spark):
    got = {r.call_id: r.text for r in sj.stream_asm_session(spark, SF).collect()}
    conv = spark.read.parquet(f"{SF}/conversations.parquet").where("role = 'assistant'").collect()
    assert got == {f"call-{r.conv_id}-{r.turn}": r.text for r in conv}


def test_stream_dedup_keeps_the_latest_whole(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/events.parquet").collect():
        row = (r.ts, r.event_id % 5 / 4.0)
        key = f"fb-{r.event_id // 2}"
        n, best = want.get(key, (0, row))
        want[key] = n + 1, max(best, row)
    got = {r.feedback_key: (r.n_copies, r.rating, r.ts_us) for r in sj.stream_dedup(spark, SF).collect()}
    import datetime as dt
    assert got == {k: (n, rating, (ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)) for k, (n, (ts, rating)) in want.items()}


def test_stream_feedback_join_writes_matched_and_unmatched(spark):
    ids = [r.event_id for r in spark.read.parquet(f"{SF}/events.parquet").select("event_id").collect()]
    got = {r.call_id: r.rating for r in sj.stream_feedback_join(spark, SF).collect()}
    assert got == {f"ev-{i}": None if i % 7 == 3 or i % 11 == 5 else i % 5 / 4.0 for i in ids}


def test_latest_by_key_by_sessions(spark):
    """Copies in any order, ties, null keys and values, a key that comes back."""
    import datetime as dt

    from callscope.session import scratch_path
    base = scratch_path(spark, "tests", "latest")
    t0 = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    schema = "feedback_key string, ts timestamp, rating double, better_response string"
    parts = [[("a", t0 + hour, 0.5, "second"), ("a", t0, 1.0, "first"), (None, t0, 1.0, "no key"), ("b", t0, None, "x"), ("b", t0, None, None)],
             [("a", t0 + hour, 0.25, "tie"), ("a", t0 + 2 * hour, None, None)],
             [("a", t0 + 30 * hour, 0.0, "back")],
             [("z", t0 + 1000 * hour, 0.0, "end")]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{base}/in/p{i}")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{base}/in"))
    got = [tuple(r) for r in sj.run_available(sj.latest_by_key(stream), "latest").collect()]
    assert sorted(got, key=str) == sorted([("a", t0 + 2 * hour, None, None, 4), ("b", t0, None, "x", 2),
                                           ("a", t0 + 30 * hour, 0.0, "back", 1)], key=str)
