"""Thread runs against brute force on small fixtures."""

from pyspark.sql import functions as F

from callscope.operators import threads as th
from callscope.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


RUN = ("run_id string, thread_id string, status string, assistant_id string, prompt_template_name string, "
       "api_key string, model string, last_error struct<status:int,message:string>, completed_at timestamp")
MSG = ("thread_id string, msg_id string, pos bigint, role string, "
       "content array<struct<type:string,value:string>>")
CUR = "thread_id string, last_msg_id string, last_pos bigint"


def test_all_messages_after_the_cursor_brute_force(spark):
    msgs = fx.messages(spark, SF)
    cursors = fx.cursors(msgs)
    got = {(r.thread_id, r.msg_id): r.n_in_run for r in th.messages_after_cursor(msgs, cursors).collect()}
    cur = {r.thread_id: r.last_pos for r in cursors.collect()}
    by_thread = {}
    for r in msgs.select("thread_id", "msg_id", "pos").collect():
        if r.pos > cur.get(r.thread_id, -1):
            by_thread.setdefault(r.thread_id, []).append((r.pos, r.msg_id))
    assert got == {(t, m): i + 1 for t, ms in by_thread.items() for i, (_, m) in enumerate(sorted(ms))}


def _long_thread(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("run-a", "T", "completed", "a", "tmpl", "k", None, None, t + dt.timedelta(minutes=9)),
         ("run-b", "T", "completed", "a", "tmpl", "k", None, None, t),
         ("run-c", "T", "completed", "a", "tmpl", "k", None, None, t + dt.timedelta(minutes=5)),
         ("run-d", "T", "failed", "a", "tmpl", "k", None, (500, "x"), None),
         ("run-e", "T", "completed", "a", None, "k", None, None, t),
         ("run-f", "U", "completed", "a", "tmpl", "k", None, None, None)], RUN)
    msgs = spark.createDataFrame(
        [("T", f"T-{i:03}", i, "user", [("image" if i % 50 == 7 else "text", f"m{i}")]) for i in range(260)]
        + [("U", "U-0", 0, "user", [("text", "hi")]), ("V", "V-0", 0, "user", [("text", "no run")])], MSG)
    cursors = spark.createDataFrame([("T", "T-009", 9), ("V", "", -1)], CUR)
    return runs, msgs, cursors


def test_first_completed_run_reads_everything(spark):
    runs, msgs, cursors = _long_thread(spark)
    got = {(r.msg_id, r.run_id) for r in th.run_messages(runs, msgs, cursors).collect()}
    want = {(f"T-{i:03}", "run-b") for i in range(10, 260) if i % 50 != 7} | {("U-0", "run-f")}
    assert got == want
    cur = {r.thread_id: (r.last_msg_id, r.last_pos) for r in th.cursor_advance(runs, msgs, cursors).collect()}
    assert cur == {"T": ("T-259", 259), "U": ("U-0", 0), "V": ("", -1)}


def test_pages_go_on_from_run_to_run(spark):
    runs, msgs, cursors = _long_thread(spark)
    order = ["run-b", "run-c", "run-a"]
    want = {(f"T-{10 + i:03}", order[i // 100]) for i in range(250) if (10 + i) % 50 != 7} | {("U-0", "run-f")}
    assert {(r.msg_id, r.run_id) for r in th.run_messages(runs, msgs, cursors, page=100).collect()} == want
    # what no run reaches waits for a later batch
    short = th.run_messages(runs, msgs, cursors, page=50)
    assert short.where("thread_id = 'T'").agg(F.max("pos")).first()[0] == 159


def test_cursor_rewind_independent_of_deletion_order(spark):
    msgs = fx.messages(spark, SF)
    cursors = fx.cursors(msgs)
    deletes = fx.deletes(msgs)
    together = {tuple(r) for r in th.cursor_rewind(cursors, msgs, deletes).collect()}
    # one deletion at a time, position 1 first, then position 0 (and the reverse)
    for order in ([1, 0], [0, 1]):
        c, live = cursors, msgs
        for p in order:
            d = deletes.where(F.col("pos") == p)
            c = th.cursor_rewind(c, live, d)
            live = live.join(d.select("thread_id", "msg_id"), ["thread_id", "msg_id"], "left_anti")
        assert {tuple(r) for r in c.collect()} == together


def test_failed_runs_give_error_events(spark):
    runs, asst = fx.runs(spark, SF), fx.assistants(spark, SF)
    ev = th.run_error_events(runs, asst).collect()
    assert ev and all(r.response_errors and r.chat_id for r in ev)
    statuses = {r.status for r in th.run_gate(runs).join(
        spark.createDataFrame([(e.call_id,) for e in ev], "run_id string"), "run_id").collect()}
    assert statuses <= {"failed", "cancelled", "incomplete"}


def test_unsupported_first_option(spark):
    msgs = fx.messages(spark, SF)
    cursors = fx.cursors(msgs)
    got = th.messages_after_cursor(msgs, cursors, unsupported_first=True).collect()
    assert all(r.content[0].type == "text" for r in got)
    per = {}
    for r in got:
        per.setdefault(r.thread_id, []).append(r.n_in_run)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per.values())
