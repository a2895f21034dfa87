"""Hot keys: one key holds a third of the rows; results stay exact."""

import datetime as dt
import random

from pyspark.sql import functions as F

from callscope.operators import feedback as fb
from callscope.operators import threads as th


def test_feedback_per_key_with_a_hot_key(spark):
    rng = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{i % 97}"
        rating = None if i % 10 == 0 else rng.random()
        rows.append((key, rating, None if i % 4 else f"b{i}", i % 50 == 7, "key", t0 + dt.timedelta(seconds=i)))
    f = spark.createDataFrame(rows, "feedback_key string, rating double, better_response string, "
                                    "is_deleted boolean, api_key string, ts timestamp").repartition(7)
    events = spark.createDataFrame([(k,) for k in {r[0] for r in rows} | {"none"}], "feedback_key string")
    got = {r.feedback_key: (r.rating, r.better_response, r.is_deleted) for r in fb.event_feedback(events, f).collect()}
    want = {"none": (None, None, False)}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        rated = [r for r in mine if r[1] is not None or r[2] is not None]
        last = max(rated, key=lambda r: r[5])
        want[key] = (last[1], last[2], any(r[3] for r in mine))
    assert got == want
    assert len(got) == events.count()


def test_all_messages_of_a_hot_thread(spark):
    msgs = [("hot", f"h{i}", i, [("text", "x")]) for i in range(3000)]
    msgs += [(f"t{i % 40}", f"m{i}", i, [("text", "y")]) for i in range(6000)]
    m = spark.createDataFrame(msgs, "thread_id string, msg_id string, pos bigint, "
                                    "content array<struct<type:string,value:string>>").repartition(9)
    c = spark.createDataFrame([("hot", "h999", 999)], "thread_id string, last_msg_id string, last_pos bigint")
    got = th.messages_after_cursor(m, c).groupBy("thread_id").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                                                                 F.count(F.lit(1)).alias("n")).collect()
    got = {r.thread_id: (r.lo, r.hi, r.n) for r in got}
    assert got["hot"] == (1000, 2999, 2000)
    for t, (lo, hi, n) in got.items():
        if t != "hot":
            want = sorted(p for th_, _, p, _ in msgs if th_ == t)
            assert (lo, hi, n) == (want[0], want[-1], len(want))
