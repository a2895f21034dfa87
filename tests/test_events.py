"""Event build details not covered by the oracle queries."""

import json

import pytest
from pyspark.sql import functions as F

from callscope.operators import events as ev
from callscope.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_strict_templates_fail_the_job(spark):
    calls = fx.calls(spark, SF)
    resolved = ev.resolve_templates(calls)
    assert resolved.where(F.size("template_errors") > 0).count() > 0
    with pytest.raises(Exception, match="template error in call"):
        ev.drop_template_errors(resolved, strict=True).count()
    ok = resolved.where(F.size("template_errors") == 0)
    assert ev.drop_template_errors(ok, strict=True).count() == ok.count()


def test_event_body_is_json_with_merged_params(spark):
    calls = fx.calls(spark, SF)
    e = ev.call_events(calls, fx.chunks(calls))
    rows = e.select("call_id", "params", "history_params", ev.event_body(e).alias("b")).collect()
    assert rows
    for r in rows:
        body = json.loads(r.b)
        want = dict(r.params or {})
        want.update({k: [m.asDict() for m in v] for k, v in (r.history_params or {}).items()})
        assert body["params"] == want
        assert set(body) >= {"feedbackKey", "apiKey", "promptTemplateName", "responseTime", "modelParameters"}


def test_feedback_keys_are_stable(spark):
    calls = fx.calls(spark, SF)
    a = {r.call_id: r.feedback_key for r in ev.with_feedback_key(calls).collect()}
    b = {r.call_id: r.feedback_key for r in ev.with_feedback_key(calls.repartition(5)).collect()}
    assert a == b


def test_session_summary_and_live_view(spark):
    from callscope.operators import feedback as fb
    from callscope.plans.flagship import all_events, all_feedback
    e = all_events(spark, SF)
    rows = e.select("chat_id", "call_id", "started_at", "response_metrics.usage.total_tokens").collect()
    want = {}
    for r in rows:
        if r.chat_id is None:
            continue
        n, tok, calls = want.get(r.chat_id, (0, 0, []))
        want[r.chat_id] = (n + 1, tok + (r.total_tokens or 0), calls + [((r.started_at is not None, r.started_at), r.call_id)])
    got = {r.chat_id: r for r in fb.session_summary(e).collect()}
    assert set(got) == set(want)
    for k, (n, tok, _) in want.items():
        assert got[k].n_events == n and (got[k].total_tokens or 0) == tok
    with_fb = fb.event_feedback(e, all_feedback(spark, SF))
    live = fb.live_events(with_fb)
    assert live.count() == with_fb.where("NOT is_deleted").count()


def test_quarantine_holds_exactly_the_failed_templates(spark):
    calls = fx.calls(spark, SF)
    resolved = ev.resolve_templates(calls)
    q = {r.call_id: r.errors for r in ev.quarantine(resolved).collect()}
    bad = {r.call_id for r in resolved.where(F.size("template_errors") > 0).collect()}
    assert set(q) == bad and bad
    assert all(e and ("missing variable" in e or "history" in e) for e in q.values())
    kept = {r.call_id for r in ev.drop_template_errors(resolved).collect()}
    assert kept.isdisjoint(bad) and len(kept) + len(bad) == calls.count()


def test_uuid_gate_takes_no_trailing_newline(spark):
    from pyspark.sql import functions as F

    from callscope.functions.ids import is_uuid
    good = "123e4567-e89b-42d3-a456-426614174000"
    df = spark.createDataFrame([(good,), (good + "\n",), (good.upper(),), ("x" + good,)], "c string")
    assert [r[0] for r in df.select(is_uuid(F.col("c"))).collect()] == [True, False, True, False]
