"""P1, P3 and K3 on streams: out of order, delivered again, ended early, run again."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from callscope import schemas
from callscope.operators import assemble as asm
from callscope.operators import feedback as fb
from callscope.operators import threads as th
from callscope.operators.events import conform_events, gate_api_key
from callscope.session import scratch_path
from callscope.sources import fixtures as fx
from callscope.streaming import assembly, chain_table, thread_runs
from callscope.streaming import jobs as sj

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def files(spark, base, parts, schema):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{base}/in/p{i}")
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(f"{base}/in"))


# ---------------------------------------------------------------- P1

def chunk(call, seq, s=None, **more):
    row = dict.fromkeys(schemas.CHUNKS.names)
    row.update(call_id=call, seq=seq, ts=T0 + dt.timedelta(seconds=seq if s is None else s), **more)
    return tuple(row[c] for c in schemas.CHUNKS.names)


def piece(index, id=None, name=None, arguments=None):
    return (index, id, "function" if id else None, name, arguments)


def assembled(spark, parts, name, **times):
    base = scratch_path(spark, "tests", name)
    sj.ensure_rocksdb(spark)
    chunks = files(spark, base, parts, schemas.CHUNKS)
    assembly.write_results(chunks, f"{base}/out", f"{base}/ckpt", **times).awaitTermination()
    return assembly.read_results(spark, f"{base}/out")


def as_rows(df):
    cols = ["call_id", "chat_text", "completion_text", "first_chunk", "usage", "finish_reason", "last_metrics", "n_chunks", "tool_calls"]
    return sorted((str(tuple(r)) for r in df.select(*cols).collect()))


END_CHUNK = [chunk("end", 0, 10_000_000)]


def test_results_equal_batch_out_of_order_and_delivered_again(spark, monkeypatch):
    rnd = random.Random(5)
    calls = fx.calls(spark, SF)
    rows = [tuple(r) for r in fx.chunks(calls).select(*schemas.CHUNKS.names).collect()]
    tools = [chunk("tools", 0, role="assistant", content="", tool_calls=[piece(1, "id1", "f", "{"), piece(None, "id0", "g", "")]),
             *[chunk("tools", i, tool_calls=[piece(i % 5, f"id{i % 5}" if i < 5 else None, "h", f"<{i}>"), piece(1, None, None, "!")])
               for i in range(1, 700)],
             chunk("tools", 700, usage=(1, 2, 3), content="ignored")]
    rows += tools
    # all within ten minutes of each other, whatever the file
    at = schemas.CHUNKS.names.index("ts")
    rows = [(*r[:at], T0 + dt.timedelta(seconds=rnd.randint(0, 500)), *r[at + 1:]) for r in rows]
    rnd.shuffle(rows)
    third = len(rows) // 3
    parts = [rows[:third] + rows[:50], rows[third:2 * third] + rows[:200], rows[2 * third:] + rows[third:third + 100], END_CHUNK]
    got = assembled(spark, parts, "p1")
    want = asm.assemble_stream(spark.createDataFrame(rows, schemas.CHUNKS))
    assert as_rows(got) == as_rows(want)
    assert {r.call_id for r in got.where("not complete").collect()} == set()


def test_early_end_gives_a_partial_result_and_a_call_is_sent_once(spark):
    parts = [
        [chunk("cut", 0, role="assistant", content="Hel"), chunk("cut", 1, content="lo"), chunk("whole", 0, content="do"),
         chunk("whole", 2, finish_reason="stop"), chunk("none", 0, content=None), chunk(None, 0, content="no call")],
        [chunk("whole", 1, content="ne"), chunk("whole", 1, content="ne")],
        # two hours on, the watermark is past all of them
        [chunk("later", 0, 7_200, content="x", usage=(1, 1, 2))],
        # delivered again; the rows are older than the watermark, or find the mark
        [chunk("cut", 0, role="assistant", content="Hel"), chunk("whole", 2, 6_700, finish_reason="stop"), chunk("cut", 2, 6_800, content="!")],
        END_CHUNK]
    got = {r.call_id: (r.chat_text, r.finish_reason, r.complete) for r in assembled(spark, parts, "early").collect()}
    assert got["cut"] == ("Hello", None, False) and got["whole"] == ("done", "stop", True)
    assert got["none"] == ("", None, False) and got["later"] == ("", None, True)
    assert set(got) == {"cut", "whole", "none", "later"}
    assert assembled(spark, parts, "early2").groupBy("call_id").count().where("count > 1").count() == 0


def test_no_results_before_the_first_batch(spark):
    assert assembly.read_results(spark, scratch_path(spark, "tests", "nothing")) is None


# ---------------------------------------------------------------- A2

def test_five_hundred_tools_in_a_call(spark):
    rnd = random.Random(2)
    parts = {i: [] for i in range(500)}
    rows = []
    for seq in range(2_000):
        pieces = []
        for _ in range(rnd.randint(1, 3)):
            i = rnd.randrange(500)
            first = not parts[i]
            parts[i].append(f"{seq}.")
            pieces.append((i if i else None, f"id{i}" if first else None, "function" if first else None, f"f{i}" if first else None, f"{seq}."))
        rows.append(("c", seq, pieces, None))
    schema = "call_id string, seq bigint, tool_calls array<struct<index:int,id:string,type:string,name:string,arguments:string>>, usage struct<total_tokens:bigint>"
    got = asm.assemble_tools(spark.createDataFrame(rows, schema).repartition(7)).collect()
    assert [(t["index"], t.id, t.name, t.arguments) for t in got[0].tool_calls] == [
        (i, f"id{i}", f"f{i}", "".join(p)) for i, p in parts.items() if p]


# ---------------------------------------------------------------- P3

MESSAGE_LOG = "thread_id string, msg_id string, pos bigint, role string, content array<struct<type:string,value:string>>, ts timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def run(run_id, thread, status="completed", minutes=0, name="tmpl", key="k"):
    return (run_id, thread, status, "a", name, key, None, (500, "x") if status == "failed" else None, at(minutes))


def msg(thread, pos, minutes, kind="text"):
    return (thread, f"{thread}-{pos}", pos, "user", [(kind, f"m{pos}")], at(minutes))


def streamed_threads(spark, name, run_parts, msg_parts, cursors):
    base = scratch_path(spark, "tests", name)
    sj.ensure_rocksdb(spark)
    runs = files(spark, f"{base}/r", run_parts, schemas.RUNS)
    msgs = files(spark, f"{base}/m", msg_parts, MESSAGE_LOG)
    asst = spark.createDataFrame([("a", "Ann", "be kind", "gpt")], schemas.ASSISTANTS)
    sent, errors = thread_runs.stream_assistant_events(runs, asst, msgs, spark.createDataFrame(cursors, schemas.CURSORS))
    for q in thread_runs.write_assistant_events(sent, errors, f"{base}/out", f"{base}/ckpt"):
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out/events"), spark.read.parquet(f"{base}/out/late"), asst


def test_thread_stream_equals_batch(spark):
    cursors = [("T", "T-1", 1), ("V", "", -1)]
    runs = [run("r2", "T", minutes=30), run("r1", "T", minutes=20), run("r3", "U", "failed", 5), run("r4", "V", name=None),
            run("r5", "W", "expired"), run("r6", "X", key=""), run("r7", "Y", minutes=3)]
    msgs = [msg("T", p, p, "image" if p % 4 == 3 else "text") for p in range(12)] + [msg("U", 0, 1), msg("V", 0, 1), msg("X", 0, 2), msg("Y", 0, 1)]
    rnd = random.Random(3)
    rnd.shuffle(msgs)
    far = [msg("end", 0, 100_000)]
    got, late, asst = streamed_threads(spark, "p3", [runs[:1], runs[1:], [run("end", "end", minutes=100_000)]],
                                       [msgs[:6], msgs[6:] + msgs[:3], far], cursors)
    want = th.assistant_events(spark.createDataFrame(runs, schemas.RUNS), asst,
                               spark.createDataFrame([m[:-1] for m in msgs], schemas.MESSAGES), spark.createDataFrame(cursors, schemas.CURSORS))
    cols = [c for c in want.columns]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    # before or at the cursor: a side output, no event
    assert {r.call_id for r in late.collect()} == {"T-0", "T-1"}
    by_run = {r.call_id: r.api_name for r in got.collect()}
    assert "X-0" not in by_run and "V-0" not in by_run and got.where("started_at is null").count() == 0


def test_messages_wait_for_their_run_and_keep_order(spark):
    """Messages before, with and after the run, later places earlier; a message behind the cursor is late."""
    runs = [[run("zz", "other", minutes=1)], [run("r", "T", minutes=60)], [run("end", "end", minutes=50_000)], [run("end1", "end", minutes=50_001)],
            [run("end2", "end", minutes=100_000)]]
    msgs = [[msg("T", 3, 10), msg("T", 1, 5)], [msg("T", 2, 40), msg("T", 1, 5)], [msg("T", 4, 90), msg("end", 0, 50_000)],
            [msg("end", 1, 50_001)], [msg("T", 2, 50_001), msg("T", 5, 50_002), msg("end", 2, 100_000)]]
    got, late, _ = streamed_threads(spark, "p3wait", runs, msgs, [("none", "", -1)])
    assert sorted(r.call_id for r in got.where("chat_id like 'T%'").collect()) == ["T-1", "T-2", "T-3", "T-4", "T-5"]
    assert {r.call_id for r in late.collect()} == {"T-2"}
    assert gate_api_key(conform_events(got)).count() == got.count()


def test_registered_threads_equal_batch(spark):
    runs, asst, msgs = fx.runs(spark, SF), fx.assistants(spark, SF), fx.messages(spark, SF)
    want = th.assistant_events(runs, asst, msgs, fx.cursors(msgs))
    got = sj.stream_cursor(spark, SF)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert runs.where("api_key = ''").count() and want.where("api_key = ''").count() == 0


# ---------------------------------------------------------------- K3

def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs)


def test_chain_table_equals_batch_and_writes_deltas(spark):
    base = scratch_path(spark, "tests", "chains")
    table = f"{base}/table"
    assert chain_table.read_chain_table(spark, table) is None and chain_table.compact(spark, table) == -1
    rows = [tuple(r) for r in fx.chain_updates(spark, SF).collect()]
    # the first batch touches many chains, each later one a single chain
    many = [(i, f"chain-{i}", f"r{i}" * 20, "k", T0) for i in range(2_000)]
    parts = [many + rows[:500], rows[500:503], rows[503:506], rows[506:]]
    stream = files(spark, base, parts, schemas.CHAIN_UPDATES)
    chain_table.stream_chain_upsert(stream, table, f"{base}/ckpt", buckets=4).awaitTermination()
    want = sorted(map(str, fb.chain_state(fb.chain_gate(spark.createDataFrame(many + rows, schemas.CHAIN_UPDATES))).collect()))

    def now():
        return sorted(map(str, chain_table.read_chain_table(spark, table).collect()))

    assert now() == want
    assert folder_bytes(f"{table}/delta/upto=1") < folder_bytes(f"{table}/delta/upto=0") / 5
    assert chain_table.compact(spark, table, buckets=4) == 3 and now() == want
    assert chain_table.compact(spark, table, buckets=4) == 3   # nothing new
    # a batch that is run again writes the same folder again, before and after a compaction
    again = fb.chain_state(fb.chain_gate(spark.createDataFrame(parts[3], schemas.CHAIN_UPDATES)))
    chain_table._write(again, f"{table}/delta/upto=3", 4)
    assert now() == want
    # a compaction that died before it was recorded changes nothing
    chain_table._write(again, f"{table}/base-9", 4)
    assert now() == want
    # the stream goes on from its checkpoint
    more = [(10**6, "chain-7", "newest", "k", T0 + dt.timedelta(days=400))]
    spark.createDataFrame(more, schemas.CHAIN_UPDATES).coalesce(1).write.parquet(f"{base}/in/p9")
    chain_table.stream_chain_upsert(stream, table, f"{base}/ckpt", buckets=4).awaitTermination()
    row = chain_table.read_chain_table(spark, table).where("id = 'chain-7'").first()
    assert (row.result, row.n_updates) == ("newest", 2)
    assert chain_table.read_chain_table(spark, table).groupBy("id").count().agg(F.max("count")).first()[0] == 1


def test_chain_table_on_the_update_stream(spark):
    base = scratch_path(spark, "tests", "chains2")
    ups = fx.chain_updates_from(sj.read_stream(spark, SF, "events", sj.EVENTS))
    chain_table.stream_chain_upsert(ups, f"{base}/table", f"{base}/ckpt").awaitTermination()
    got = {(r.id, r.result, r.n_updates) for r in chain_table.read_chain_table(spark, f"{base}/table").collect()}
    assert got == {(r.id, r.result, r.n_updates) for r in fb.chain_upsert(fb.chain_gate(fx.chain_updates(spark, SF))).collect()}
