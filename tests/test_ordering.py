"""Skew-safe positions equal window functions, with one hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callscope.operators.ordering import previous_within, rank_within


def _data(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randint(0, 500), f"h{i}") for i in range(2000)]
    rows += [(f"k{rng.randint(0, 40)}", rng.randint(0, 500), f"r{i}") for i in range(4000)]
    rows += [(None, 1, "n1"), (None, 2, "n2"), ("hot", None, "h-null")]
    return spark.createDataFrame(rows, "k string, t bigint, id string")


def test_rank_within_equals_row_number(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
    for buckets in (1, 3, 128):
        got = {r.id: r.rank for r in rank_within(df, "k", ["t", "id"], "rank", buckets=buckets).collect()}
        assert got == want


def test_previous_within_equals_lag(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r.id: r.p for r in df.select("id", F.lag("id").over(w).alias("p")).collect()}
    for buckets in (1, 3, 128):
        got = {r.id: r.prev for r in previous_within(df, "k", ["t", "id"], "id", "prev", buckets=buckets).collect()}
        assert got == want


@pytest.mark.parametrize("aqe, reuse", [("true", "true"), ("false", "true"), ("true", "false")])
def test_wide_rows_with_a_hot_key(spark, aqe, reuse):
    """300,000 rows, a third of them in one key, with a payload column."""
    keys = ("spark.sql.adaptive.enabled", "spark.sql.exchange.reuse")
    old = [spark.conf.get(k, "true") for k in keys]
    try:
        for k, v in zip(keys, (aqe, reuse)):
            spark.conf.set(k, v)
        df = spark.range(300_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string")))
            .alias("k"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("t"), F.col("id"),
            F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("payload"))
        w = Window.partitionBy("k").orderBy("t", "id")
        want = df.select("id", F.row_number().over(w).alias("rn"), F.lag("id").over(w).alias("p"))
        rank = rank_within(df, "k", ["t", "id"], "rank").join(want, "id")
        prev = previous_within(df, "k", ["t", "id"], "id", "prev").join(want, "id")
        ok = F.col("payload") == F.repeat(F.sha2(F.col("id").cast("string"), 256), 2)
        assert rank.where((F.col("rank") == F.col("rn")) & ok).count() == 300_000
        assert prev.where(F.col("prev").eqNullSafe(F.col("p")) & ok).count() == 300_000
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)


def test_sessions_of_whole_events(spark):
    """Positions in a chat over full event rows, call and assistant events alike."""
    from callscope.operators import feedback as fb
    from callscope.plans.flagship import all_events
    events = all_events(spark, "/root/testdata/sf0.001").cache()
    got = fb.sessions(events)
    assert set(events.columns) < set(got.columns)
    per = {}
    for r in events.where("chat_id is not null").select("chat_id", "started_at", "call_id").collect():
        per.setdefault(r.chat_id, []).append((r.started_at is not None, r.started_at, r.call_id))
    want = {(c, x[2]): i + 1 for c, xs in per.items() for i, x in enumerate(sorted(xs, key=lambda x: (x[0], x[1] or 0, x[2])))}
    assert {(r.chat_id, r.call_id): r.session_seq for r in got.collect()} == want
