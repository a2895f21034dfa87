"""Plan guards: the scale properties the design relies on, checked on the
physical plans so a change cannot lose them silently (the per-query guard
against cross joins and Python evaluators runs in test_oracle.py)."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_thread_joins_shuffle_messages_once(spark):
    """With broadcast joins off, the message table meets one narrow table of
    runs and cursors: one exchange of its content."""
    from callscope.operators import threads as th
    from callscope.sources import fixtures as fx
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        msgs = fx.messages(spark, SF)
        df = th.run_messages(fx.runs(spark, SF), msgs, fx.cursors(msgs))
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_chunk_log_is_read_once_and_hash_aggregated(spark):
    from callscope.operators.assemble import assemble_stream
    from callscope.sources import fixtures as fx
    df = assemble_stream(fx.chunks(fx.calls(spark, SF)))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # text, tools and metrics in one pass: the chunk log is read once
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_redaction_reads_two_columns(spark):
    plan = _plan(spark, "redact_text")
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["doc_id:bigint,text:string"]
