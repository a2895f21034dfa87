"""

Every query takes (spark, sf_dir), reads the driver's tables there (or
logs Spark derives from them) and returns a DataFrame whose columns are
scalars or JSON text, so it can be compared with its DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.functions import templates as tp
from callscope.functions.redact import redact_text, redact_value
from callscope.operators import assemble as asm
from callscope.operators import events as ev
from callscope.operators import feedback as fb
from callscope.operators import threads as th
from callscope.plans import oracle as osql
from callscope.plans import sql_stages as sp
from callscope.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CFG = ev.Config()


def shared(fn):
    """Build a shared intermediate DataFrame once per (session, scale):
    queries that start from it then only add their own projection, and
    its plan is analysed once."""
    cache: dict = {}

    def wrapper(spark, sf):
        key = (spark.sparkContext.applicationId, sf)
        if key not in cache:
            cache[key] = fn(spark, sf)
        return cache[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def js(c) -> Column:
    """JSON text of a nested value, nulls kept (as DuckDB renders them)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_json(c, {"ignoreNullFields": "false"})


_ALL = {**osql.FIXTURES, **sp.STAGES}


def sql(names: list[str], body: str) -> str:
    """Oracle SQL: the named fixture / pipeline CTEs, then `body`."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _ALL[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_ALL[n][1].strip()})" for n in order)
    return ("WITH " + ctes + "\n" if ctes else "") + body.strip()


# ---------------------------------------------------------------- redaction

@register("redact_text", sql([], f"""
SELECT doc_id, {osql.sql_redact('text')} AS text_redacted FROM documents"""))
def q_redact_text(spark, sf):
    """R1 over whole documents."""
    from callscope.sources.tables import read_table
    d = read_table(spark, sf, "documents", "doc_id", "text")
    return d.select("doc_id", redact_text("text").alias("text_redacted"))


@register("redact_nested", sql(["calls"], f"""
SELECT call_id, to_json({sp.redact_params('params')}) AS params,
       to_json({sp.redact_history('history_params')}) AS history_params FROM calls"""))
def q_redact_nested(spark, sf):
    """R2 over the params and history params of every call."""
    c = fx.calls(spark, sf)
    return c.select("call_id", js(redact_value(F.col("params"), c.schema["params"].dataType)).alias("params"),
                    js(redact_value(F.col("history_params"), c.schema["history_params"].dataType))
                    .alias("history_params"))


@shared
def _events(spark, sf) -> DataFrame:
    calls = fx.calls(spark, sf)
    return ev.call_events(calls, fx.chunks(calls), CFG)


def flat_events(e: DataFrame, *more: str) -> DataFrame:
    return e.select(
        "event_kind", "call_id", "feedback_key", "api_key", "prompt_template_name", "api_name",
        "prompt_template_text", js("prompt_template_chat").alias("prompt_template_chat"),
        js("params").alias("params"), js("history_params").alias("history_params"), "response",
        "raw_response", js("tool_calls").alias("tool_calls"), "response_time",
        js("response_errors").alias("response_errors"), js("response_metrics").alias("response_metrics"),
        js("model_parameters").alias("model_parameters"), "chat_id", "chain_id", js("context").alias("context"),
        "tools", *more)


@register("redact_chat", sql(["call_events"], """
SELECT call_id, response, to_json(params) AS params, to_json(history_params) AS history_params,
       to_json(tool_calls) AS tool_calls, raw_response
FROM call_events WHERE event_kind = 'chat' AND response_errors IS NULL"""))
def q_redact_chat(spark, sf):
    """Chat events after redaction (raw response kept as sent)."""
    e = _events(spark, sf).where((F.col("event_kind") == "chat") & F.col("response_errors").isNull())
    return e.select("call_id", "response", js("params").alias("params"),
                    js("history_params").alias("history_params"), js("tool_calls").alias("tool_calls"),
                    "raw_response")


@register("redact_completion", sql(["call_events"], """
SELECT call_id, response, to_json(params) AS params
FROM call_events WHERE event_kind = 'completion' AND response_errors IS NULL"""))
def q_redact_completion(spark, sf):
    """Completion events after redaction."""
    e = _events(spark, sf).where((F.col("event_kind") == "completion") & F.col("response_errors").isNull())
    return e.select("call_id", "response", js("params").alias("params"))


@register("redact_error", sql(["call_events"], """
SELECT call_id, to_json(params) AS params, to_json(history_params) AS history_params, response
FROM call_events WHERE response_errors IS NOT NULL"""))
def q_redact_error(spark, sf):
    """Failed calls: params redacted, no response."""
    e = _events(spark, sf).where(F.col("response_errors").isNotNull())
    return e.select("call_id", js("params").alias("params"), js("history_params").alias("history_params"),
                    "response")


# ---------------------------------------------------------------- templates

def _valid(t: str, p: str) -> Column:
    return F.size(tp.missing_vars(F.col(t), F.col(p))) == 0


@register("tmpl_vars", sql(["templated"], f"""
SELECT row_id, array_to_string({osql.sql_vars('template')}, ',') AS vars FROM templated"""))
def q_tmpl_vars(spark, sf):
    """Distinct variables of each order template, first seen first."""
    t = fx.templated(spark, sf)
    return t.select("row_id", F.array_join(tp.template_vars("template"), ",").alias("vars"))


@register("tmpl_format", sql(["templated"], f"""
SELECT row_id, CASE WHEN len({sp.missing_vars('template', 'params')}) = 0
                    THEN {osql.sql_substitute('template', 'params')} END AS formatted
FROM templated"""))
def q_tmpl_format(spark, sf):
    """One-pass substitution (escapes not yet removed); rows with a
    missing variable give null."""
    t = fx.templated(spark, sf)
    return t.select("row_id", F.when(_valid("template", "params"),
                                     tp.substitute(F.col("template"), F.col("params"))).alias("formatted"))


@register("tmpl_unescape", sql(["templated"], f"""
SELECT row_id, CASE WHEN len({sp.missing_vars('template', 'params')}) = 0
                    THEN {osql.sql_format('template', 'params')} END AS formatted
FROM templated"""))
def q_tmpl_unescape(spark, sf):
    """T2 + T3: substitution, then `\\{x\\}` -> `{x}`."""
    t = fx.templated(spark, sf)
    return t.select("row_id", F.when(_valid("template", "params"),
                                     tp.format_template("template", "params")).alias("formatted"))


@register("tmpl_missing", sql(["templated"], f"""
SELECT row_id, array_to_string(m, ',') AS missing_vars
FROM (SELECT row_id, {sp.missing_vars('template', 'params')} AS m FROM templated) WHERE len(m) > 0"""))
def q_tmpl_missing(spark, sf):
    """T4: the quarantine of templates with missing variables."""
    t = fx.templated(spark, sf).select("row_id", tp.missing_vars("template", "params").alias("m"))
    return t.where(F.size("m") > 0).select("row_id", F.array_join("m", ",").alias("missing_vars"))


@register("map_format", sql(["templated"], f"""
SELECT row_id,
  array_to_string(list_transform(map_keys(map_template), lambda k: {osql.sql_format('k', 'params')}), '|') AS keys,
  array_to_string(list_transform(map_values(map_template), lambda v: {osql.sql_format('v', 'params')}), '|')
    AS vals
FROM templated"""))
def q_map_format(spark, sf):
    """Keys and values of a map template are both formatted."""
    t = fx.templated(spark, sf).select("row_id", tp.format_map("map_template", "params").alias("m"))
    return t.select("row_id", F.array_join(F.map_keys("m"), "|").alias("keys"),
                    F.array_join(F.map_values("m"), "|").alias("vals"))


@register("msg_vars", sql(["calls"], f"""
SELECT call_id, array_to_string({sp.msg_vars('messages')}, ',') AS vars FROM calls WHERE kind = 'chat'"""))
def q_msg_vars(spark, sf):
    """T5: variables of each chat message list, leaf by leaf."""
    c = fx.calls(spark, sf).where(F.col("kind") == "chat")
    return c.select("call_id", F.array_join(tp.message_vars("messages"), ",").alias("vars"))


@register("msg_format", sql(["calls"], f"""
SELECT call_id, to_json(list_transform(messages, lambda m: {sp.fmt_msg('m', 'params')})) AS formatted
FROM calls WHERE kind = 'chat'"""))
def q_msg_format(spark, sf):
    """Role and content of every message formatted."""
    c = fx.calls(spark, sf).where(F.col("kind") == "chat")
    return c.select("call_id", js(tp.format_messages("messages", "params")).alias("formatted"))


@register("history_splice", sql(["calls"], f"""
SELECT call_id, to_json({sp.splice('messages', 'params', 'history_params')}) AS spliced
FROM calls WHERE kind = 'chat' AND is_template"""))
def q_history_splice(spark, sf):
    """chat_history slots replaced by the listed history messages."""
    c = fx.calls(spark, sf).where((F.col("kind") == "chat") & F.col("is_template"))
    return c.select("call_id", js(tp.splice_history("messages", "params", "history_params")).alias("spliced"))


@register("history_errors", sql(["calls"], f"""
SELECT call_id, array_to_string(e, '; ') AS errors
FROM (SELECT call_id, {sp.history_errors('messages', 'history_params')} AS e
      FROM calls WHERE kind = 'chat' AND is_template) WHERE len(e) > 0"""))
def q_history_errors(spark, sf):
    """Chat templates whose history slot cannot be filled."""
    c = fx.calls(spark, sf).where((F.col("kind") == "chat") & F.col("is_template"))
    e = c.select("call_id", tp.history_errors("messages", "history_params").alias("e"))
    return e.where(F.size("e") > 0).select("call_id", F.array_join("e", "; ").alias("errors"))


@register("resolve_messages", sql(["resolved"], """
SELECT call_id, to_json(resolved_messages) AS resolved, to_json(template_messages) AS template,
       array_to_string(template_errors, '; ') AS errors
FROM resolved WHERE kind = 'chat'"""))
def q_resolve_messages(spark, sf):
    """Resolved messages, the template kept, errors for quarantine."""
    r = ev.resolve_templates(fx.calls(spark, sf)).where(F.col("kind") == "chat")
    return r.select("call_id", js("resolved_messages").alias("resolved"), js("template_messages").alias("template"),
                    F.array_join("template_errors", "; ").alias("errors"))


@register("resolve_prompt", sql(["resolved"], """
SELECT call_id, resolved_prompt, template_prompt, array_to_string(template_errors, '; ') AS errors
FROM resolved WHERE kind = 'completion'"""))
def q_resolve_prompt(spark, sf):
    """Completion prompt: template formatted, or text, or parts joined."""
    r = ev.resolve_templates(fx.calls(spark, sf)).where(F.col("kind") == "completion")
    return r.select("call_id", "resolved_prompt", "template_prompt",
                    F.array_join("template_errors", "; ").alias("errors"))


# ---------------------------------------------------------------- assembly

@shared
def _calls_chunks(spark, sf):
    calls = fx.calls(spark, sf)
    return calls, fx.chunks(calls)


def _streamed(calls: DataFrame, kind: str) -> DataFrame:
    return calls.where(F.col("is_stream") & (F.col("kind") == kind) & F.col("error").isNull()).select("call_id")


@register("asm_content", sql(["streamed", "calls"], """
SELECT s.call_id, s.s_chat_text AS text FROM streamed s JOIN calls c ON s.call_id = c.call_id
WHERE c.kind = 'chat'"""))
def q_asm_content(spark, sf):
    """A1 (with A3, A5): the text of each streamed chat call."""
    calls, chunks = _calls_chunks(spark, sf)
    a = asm.assemble_stream(chunks).join(_streamed(calls, "chat"), "call_id", "left_semi")
    return a.select("call_id", F.coalesce("chat_text", F.lit("")).alias("text"))


@register("asm_tools", sql(["tool_chunks"], f"""
SELECT call_id, CAST(to_json(tool_calls) AS VARCHAR) AS tool_calls FROM ({sp.tools_from('tool_chunks')})"""))
def q_asm_tools(spark, sf):
    """A2: tool calls put back together from their streamed pieces."""
    t = asm.assemble_tools(fx.tool_chunks(spark, sf))
    return t.select("call_id", js("tool_calls").alias("tool_calls"))


@register("asm_function_call", sql(["chunks"], f"""
SELECT call_id, seq, {sp.CHAT_PIECE} AS piece FROM chunks WHERE function_call IS NOT NULL"""))
def q_asm_function_call(spark, sf):
    """A3: the text each function-call chunk adds (none when the chunk
    also has tool calls)."""
    _, chunks = _calls_chunks(spark, sf)
    return chunks.where(F.col("function_call").isNotNull()).select("call_id", "seq",
                                                                   asm.chat_piece().alias("piece"))


@register("asm_last_metrics", sql(["streamed", "calls"], """
SELECT s.call_id, CAST(to_json(s.s_chat_usage) AS VARCHAR) AS usage, s.s_chat_finish AS finish_reason
FROM streamed s JOIN calls c ON s.call_id = c.call_id WHERE c.kind = 'chat'"""))
def q_asm_last_metrics(spark, sf):
    """A4: last usage, last non-empty finish reason of a chat stream."""
    calls, chunks = _calls_chunks(spark, sf)
    a = asm.assemble_stream(chunks).join(_streamed(calls, "chat"), "call_id", "left_semi")
    return a.select("call_id", js("usage").alias("usage"), "finish_reason")


@register("usage_chunk_filter", sql(["chunks"], """
SELECT call_id, seq, content, text FROM chunks WHERE usage IS NULL"""))
def q_usage_chunk_filter(spark, sf):
    """A5: chunks passed on to the caller (usage chunks are absorbed)."""
    _, chunks = _calls_chunks(spark, sf)
    return chunks.where(F.col("usage").isNull()).select("call_id", "seq", "content", "text")


@register("stamp_feedback_key", sql(["chunks", "cfg_calls"], """
SELECT k.call_id, k.seq, c.feedback_key FROM chunks k JOIN cfg_calls c ON k.call_id = c.call_id"""))
def q_stamp_feedback_key(spark, sf):
    """Every chunk carries its call's feedback key."""
    calls, chunks = _calls_chunks(spark, sf)
    keys = ev.with_feedback_key(calls).select("call_id", "feedback_key")
    return chunks.select("call_id", "seq").join(keys, "call_id")


@shared
def _results(spark, sf) -> tuple[DataFrame, DataFrame]:
    calls, chunks = _calls_chunks(spark, sf)
    return calls, asm.resolve_results(calls, chunks)


@register("asm_raw", sql(["results", "calls"], """
SELECT r.call_id, r.raw_response FROM results r JOIN calls c ON r.call_id = c.call_id
WHERE c.is_stream AND c.kind = 'chat'"""))
def q_asm_raw(spark, sf):
    """The raw response rebuilt from the first chunk of a chat stream."""
    calls, res = _results(spark, sf)
    return res.join(_streamed(calls, "chat"), "call_id", "left_semi").select("call_id", "raw_response")


@register("asm_completion", sql(["results", "calls"], """
SELECT r.call_id, r.response AS text, CAST(to_json(r.usage) AS VARCHAR) AS usage, r.finish_reason, r.logprobs
FROM results r JOIN calls c ON r.call_id = c.call_id WHERE c.is_stream AND c.kind = 'completion'"""))
def q_asm_completion(spark, sf):
    """Completion stream: all text; metrics of the last chunk."""
    calls, res = _results(spark, sf)
    r = res.join(_streamed(calls, "completion"), "call_id", "left_semi")
    return r.select("call_id", F.col("response").alias("text"), js("usage").alias("usage"), "finish_reason",
                    "logprobs")


@register("extract_chat", sql(["calls"], f"""
SELECT call_id, coalesce(CAST(to_json(function_call) AS VARCHAR), content) AS response,
       CAST(to_json(tool_calls) AS VARCHAR) AS tool_calls, CAST(to_json(usage) AS VARCHAR) AS usage,
       finish_reason, logprobs
FROM calls WHERE kind = 'chat' AND NOT is_stream AND error IS NULL"""))
def q_extract_chat(spark, sf):
    """Static chat results."""
    c = fx.calls(spark, sf).where((F.col("kind") == "chat") & ~F.col("is_stream") & F.col("error").isNull())
    s = asm.static_chat(c)
    return s.select("call_id", "response", js("tool_calls").alias("tool_calls"), js("usage").alias("usage"),
                    "finish_reason", "logprobs")


@register("extract_completion", sql(["calls"], """
SELECT call_id, CASE WHEN content <> '' THEN content END AS response, '[]' AS tool_calls,
       CASE WHEN content <> '' THEN CAST(to_json(usage) AS VARCHAR) END AS usage,
       CASE WHEN content <> '' THEN finish_reason END AS finish_reason,
       CASE WHEN content <> '' THEN logprobs END AS logprobs
FROM calls WHERE kind = 'completion' AND NOT is_stream AND error IS NULL"""))
def q_extract_completion(spark, sf):
    """A10: static completion results (empty text gives neither text nor metrics)."""
    c = fx.calls(spark, sf).where((F.col("kind") == "completion") & ~F.col("is_stream")
                                  & F.col("error").isNull())
    s = asm.static_completion(c)
    return s.select("call_id", "response", js("tool_calls").alias("tool_calls"), js("usage").alias("usage"),
                    "finish_reason", "logprobs")


@register("resolve_result", sql(["results"], """
SELECT call_id, response, CAST(to_json(tool_calls) AS VARCHAR) AS tool_calls,
       CAST(to_json(usage) AS VARCHAR) AS usage, finish_reason, logprobs, raw_response FROM results"""))
def q_resolve_result(spark, sf):
    """One result per call, streamed or static, chat or completion."""
    _, res = _results(spark, sf)
    return res.select("call_id", "response", js("tool_calls").alias("tool_calls"), js("usage").alias("usage"),
                      "finish_reason", "logprobs", "raw_response")


# ---------------------------------------------------------------- events

FLAT = sp.FLAT_EVENT_COLUMNS


@register("event_chat", sql(["call_events"], f"""
SELECT {FLAT} FROM call_events WHERE event_kind = 'chat' AND response_errors IS NULL"""))
def q_event_chat(spark, sf):
    """Chat events."""
    e = _events(spark, sf)
    return flat_events(e.where((F.col("event_kind") == "chat") & F.col("response_errors").isNull()))


@register("event_completion", sql(["call_events"], f"""
SELECT {FLAT} FROM call_events WHERE event_kind = 'completion' AND response_errors IS NULL"""))
def q_event_completion(spark, sf):
    """Completion events."""
    e = _events(spark, sf)
    return flat_events(e.where((F.col("event_kind") == "completion") & F.col("response_errors").isNull()))


@shared
def _thread_tables(spark, sf):
    msgs = fx.messages(spark, sf)
    return fx.runs(spark, sf), fx.assistants(spark, sf), msgs, fx.cursors(msgs)


@shared
def _assistant_events(spark, sf) -> DataFrame:
    runs, assistants, msgs, cursors = _thread_tables(spark, sf)
    return th.assistant_events(runs, assistants, msgs, cursors, CFG)


@register("event_assistant", sql(["assistant_events"], f"SELECT {FLAT} FROM assistant_events"))
def q_event_assistant(spark, sf):
    """Assistant events (messages of completed runs, failed runs)."""
    return flat_events(_assistant_events(spark, sf))


@register("config_fallback", sql(["cfg_calls"], """
SELECT call_id, api_key, prompt_template_name, chat_id, chain_id FROM cfg_calls"""))
def q_config_fallback(spark, sf):
    """Key, template name, chat id and chain id after the defaults."""
    c = ev.apply_config(fx.calls(spark, sf), CFG)
    return c.select("call_id", "api_key", "prompt_template_name", "chat_id", "chain_id")


@register("gate_named", sql(["cfg_calls"], """
SELECT call_id, prompt_template_name FROM cfg_calls
WHERE prompt_template_name IS NOT NULL AND prompt_template_name <> ''"""))
def q_gate_named(spark, sf):
    """E5: calls recorded because they carry a template name."""
    c = ev.gate_named(ev.apply_config(fx.calls(spark, sf), CFG), CFG)
    return c.select("call_id", "prompt_template_name")


@shared
def _raw_events(spark, sf) -> DataFrame:
    calls, chunks = _calls_chunks(spark, sf)
    return ev.call_events(calls, chunks, ev.Config(redact_pii=False), gate=False)


@register("gate_api_key", sql(["raw_events"], """
SELECT call_id, api_key FROM raw_events WHERE api_key IS NOT NULL AND api_key <> ''"""))
def q_gate_api_key(spark, sf):
    """Events that have an API key."""
    return ev.gate_api_key(_raw_events(spark, sf)).select("call_id", "api_key")


@register("gate_chain_uuid", sql(["raw_events"], f"""
SELECT call_id, chain_id FROM raw_events
WHERE chain_id IS NULL OR regexp_matches(chain_id, '{sp.UUID_RE}')"""))
def q_gate_chain_uuid(spark, sf):
    """Events whose chain id is absent or a UUID."""
    return ev.gate_chain_uuid(_raw_events(spark, sf)).select("call_id", "chain_id")


@register("feedback_key", sql(["cfg_calls"], "SELECT call_id, feedback_key FROM cfg_calls"))
def q_feedback_key(spark, sf):
    """The caller's feedback key or a retry-stable UUID."""
    return ev.with_feedback_key(fx.calls(spark, sf)).select("call_id", "feedback_key")


@register("response_time", sql(["calls"], """
SELECT call_id, CAST(date_diff('millisecond', started_at, ended_at) AS BIGINT) AS response_time FROM calls"""))
def q_response_time(spark, sf):
    """Milliseconds from start to end of each call."""
    return fx.calls(spark, sf).select("call_id", ev.response_time().alias("response_time"))


@register("event_errors", sql(["all_events"], f"""
SELECT {FLAT} FROM all_events WHERE response_errors IS NOT NULL"""))
def q_event_errors(spark, sf):
    """Events of failed calls and failed runs."""
    e = ev.events_all(_events(spark, sf), _assistant_events(spark, sf))
    return flat_events(e.where(F.col("response_errors").isNotNull()))


@register("events_all", sql(["all_events"], f"SELECT {FLAT} FROM all_events"))
def q_events_all(spark, sf):
    """All producers as one event table."""
    return flat_events(ev.events_all(_events(spark, sf), _assistant_events(spark, sf)))


# ---------------------------------------------------------------- thread runs

@register("run_route", sql(["runs"], """
SELECT run_id, thread_id, status,
       CASE WHEN status IN ('failed', 'cancelled', 'incomplete') THEN 'error'
            WHEN status = 'completed' THEN 'messages' ELSE 'ignore' END AS route FROM runs"""))
def q_run_route(spark, sf):
    """M1: what each run yields."""
    return th.run_route(fx.runs(spark, sf)).select("run_id", "thread_id", "status", "route")


@register("run_gate", sql(["runs_gated"], "SELECT run_id, prompt_template_name FROM runs_gated"))
def q_run_gate(spark, sf):
    """M2: runs recorded (they carry a template name)."""
    return th.run_gate(fx.runs(spark, sf)).select("run_id", "prompt_template_name")


@register("run_assistant_join", sql(["runs", "assistants"], """
SELECT r.run_id, r.assistant_id, a.name AS a_name, a.instructions AS a_instructions, a.model AS a_model
FROM runs r LEFT JOIN assistants a ON r.assistant_id = a.assistant_id"""))
def q_run_assistant_join(spark, sf):
    """Each run with its assistant."""
    j = th.run_assistant_join(fx.runs(spark, sf), fx.assistants(spark, sf))
    return j.select("run_id", "assistant_id", "a_name", "a_instructions", "a_model")


@register("messages_after_cursor", sql(["after_cursor"], """
SELECT thread_id, msg_id, pos, n_in_run FROM after_cursor"""))
def q_messages_after_cursor(spark, sf):
    """All messages after each thread's cursor, oldest first."""
    _, _, msgs, cursors = _thread_tables(spark, sf)
    return th.messages_after_cursor(msgs, cursors).select("thread_id", "msg_id", "pos", "n_in_run")


@register("message_supported", sql(["messages"], """
SELECT msg_id, coalesce(content[1].type = 'text', false) AS supported FROM messages"""))
def q_message_supported(spark, sf):
    """M3: whether a message can become an event."""
    return fx.messages(spark, sf).select("msg_id", th.message_supported().alias("supported"))


@register("message_events", sql(["asst_msg_events"], f"SELECT {FLAT} FROM asst_msg_events"))
def q_message_events(spark, sf):
    """M4: one event per supported message sent."""
    runs, assistants, msgs, cursors = _thread_tables(spark, sf)
    return flat_events(ev.conform_events(th.message_events(runs, assistants, msgs, cursors, CFG)))


@register("cursor_advance", sql(["sent", "cursors"], """
SELECT coalesce(c.thread_id, m.thread_id) AS thread_id, coalesce(m.new_id, c.last_msg_id) AS last_msg_id,
       coalesce(m.new_pos, c.last_pos) AS last_pos
FROM cursors c FULL OUTER JOIN (SELECT thread_id, arg_max(msg_id, pos) AS new_id, max(pos) AS new_pos
                                FROM sent GROUP BY thread_id) m ON c.thread_id = m.thread_id"""))
def q_cursor_advance(spark, sf):
    """M5: each thread's cursor after the run."""
    runs, _, msgs, cursors = _thread_tables(spark, sf)
    return th.cursor_advance(runs, msgs, cursors)


@register("prev_message", sql(["messages"], """
SELECT thread_id, msg_id, lag(msg_id) OVER (PARTITION BY thread_id ORDER BY pos, msg_id) AS prev_msg_id
FROM messages"""))
def q_prev_message(spark, sf):
    """M6: the message before each message of a thread."""
    return th.prev_message(fx.messages(spark, sf)).select("thread_id", "msg_id", "prev_msg_id")


@register("cursor_rewind", sql(["cursors", "messages", "deletes"], """
SELECT c.thread_id, c.last_msg_id, c.last_pos FROM cursors c
  ANTI JOIN deletes d ON c.thread_id = d.thread_id AND c.last_msg_id = d.msg_id
UNION ALL
SELECT h.thread_id, coalesce(b.prev_id, '') AS last_msg_id, coalesce(b.prev_pos, -1) AS last_pos
FROM (SELECT c.* FROM cursors c SEMI JOIN deletes d ON c.thread_id = d.thread_id AND c.last_msg_id = d.msg_id) h
LEFT JOIN (
  SELECT l.thread_id, arg_max(l.msg_id, l.pos) AS prev_id, max(l.pos) AS prev_pos
  FROM (SELECT m.* FROM messages m ANTI JOIN deletes d ON m.thread_id = d.thread_id AND m.msg_id = d.msg_id) l
  JOIN cursors c2 ON l.thread_id = c2.thread_id
  WHERE l.pos < c2.last_pos GROUP BY l.thread_id) b ON h.thread_id = b.thread_id"""))
def q_cursor_rewind(spark, sf):
    """M7: cursors after deletions."""
    msgs = fx.messages(spark, sf)
    return th.cursor_rewind(fx.cursors(msgs), msgs, fx.deletes(msgs))


@register("delete_tombstones", sql(["tombstones"], "SELECT feedback_key, is_deleted, api_key FROM tombstones"))
def q_delete_tombstones(spark, sf):
    """M8: deletions as feedback that marks the message's event deleted."""
    t = th.delete_tombstones(fx.deletes(fx.messages(spark, sf)), CFG)
    return t.select("feedback_key", "is_deleted", "api_key")


# ---------------------------------------------------------------- feedback

@register("feedback_gate", sql(["fb_gated"], """
SELECT feedback_key, rating, better_response, is_deleted, api_key, rating BETWEEN 0.0 AND 1.0 AS rating_in_range
FROM fb_gated"""))
def q_feedback_gate(spark, sf):
    """B1: feedback with both a feedback key and an API key; ratings outside
    0..1 are flagged, not dropped."""
    f = fb.feedback_gate(fx.feedback(spark, sf), CFG)
    return f.select("feedback_key", "rating", "better_response", "is_deleted", "api_key",
                    fb.rating_in_range().alias("rating_in_range"))


@register("chain_gate", sql(["chains_gated"], "SELECT update_id, id, api_key FROM chains_gated"))
def q_chain_gate(spark, sf):
    """B2: chain updates with an id and an API key."""
    return fb.chain_gate(fx.chain_updates(spark, sf), CFG).select("update_id", "id", "api_key")


@shared
def _all_feedback(spark, sf) -> DataFrame:
    msgs = fx.messages(spark, sf)
    return fb.feedback_gate(fx.feedback(spark, sf), CFG).unionByName(
        th.delete_tombstones(fx.deletes(msgs), CFG))


@shared
def _events_fb(spark, sf) -> DataFrame:
    e = ev.events_all(_events(spark, sf), _assistant_events(spark, sf))
    return fb.event_feedback(e, _all_feedback(spark, sf))


@register("event_feedback", sql(["events_fb"], """
SELECT call_id, feedback_key, rating, better_response FROM events_fb"""))
def q_event_feedback(spark, sf):
    """Events with the rating and better response sent for them."""
    return _events_fb(spark, sf).select("call_id", "feedback_key", "rating", "better_response")


@register("event_deleted_flag", sql(["events_fb"], "SELECT call_id, feedback_key, is_deleted FROM events_fb"))
def q_event_deleted_flag(spark, sf):
    """Events kept, marked deleted when a deletion refers to them."""
    return _events_fb(spark, sf).select("call_id", "feedback_key", "is_deleted")


@register("sessions", sql(["all_events"], f"""
SELECT {FLAT}, row_number() OVER (PARTITION BY chat_id ORDER BY started_at NULLS FIRST, call_id) AS session_seq
FROM all_events WHERE chat_id IS NOT NULL"""))
def q_sessions(spark, sf):
    """Every event of a chat, whole, with its position in the session."""
    return flat_events(fb.sessions(ev.events_all(_events(spark, sf), _assistant_events(spark, sf))), "session_seq")


@register("chains", sql(["call_events", "chain_results"], """
SELECT e.chain_id, e.n_events, e.n_chats, e.total_tokens, r.result, r.n_updates
FROM (SELECT chain_id, count(*) AS n_events, count(DISTINCT chat_id) AS n_chats,
             sum(response_metrics.usage.total_tokens) AS total_tokens
      FROM call_events WHERE chain_id IS NOT NULL GROUP BY chain_id) e
LEFT JOIN chain_results r ON e.chain_id = r.id"""))
def q_chains(spark, sf):
    """Events per chain with the chain's last result."""
    upd = fb.chain_gate(fx.chain_updates(spark, sf), CFG)
    return fb.chains(_events(spark, sf), upd).select("chain_id", "n_events", "n_chats", "total_tokens",
                                                    "result", "n_updates")


ROLLUP_SQL = """
SELECT b.*, q.p50_ms, q.p95_ms FROM (
  SELECT prompt_template_name, count(*) AS n_calls, count(response_errors) AS n_errors,
         sum(response_metrics.usage.prompt_tokens) AS prompt_tokens,
         sum(response_metrics.usage.completion_tokens) AS completion_tokens,
         sum(response_time) AS total_time_ms, count(rating) AS n_rated, sum(rating) AS rating_sum
  FROM events_fb GROUP BY prompt_template_name) b
LEFT JOIN (
  SELECT prompt_template_name,
         min(response_time) FILTER (WHERE cum >= ceil(n * 0.5)) AS p50_ms,
         min(response_time) FILTER (WHERE cum >= ceil(n * 0.95)) AS p95_ms
  FROM (SELECT prompt_template_name, response_time,
               sum(c) OVER (PARTITION BY prompt_template_name ORDER BY response_time
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
               sum(c) OVER (PARTITION BY prompt_template_name) AS n
        FROM (SELECT prompt_template_name, response_time, count(*) AS c FROM events_fb
              GROUP BY prompt_template_name, response_time))
  GROUP BY prompt_template_name) q
ON b.prompt_template_name IS NOT DISTINCT FROM q.prompt_template_name"""


@register("template_rollup", sql(["events_fb"], ROLLUP_SQL))
def q_template_rollup(spark, sf):
    """Per template: calls, errors, tokens, latency, ratings."""
    e = ev.events_all(_events(spark, sf), _assistant_events(spark, sf))
    return fb.template_rollup(e, _all_feedback(spark, sf))


@register("error_log_sample", sql(["failures"], """
SELECT event_id, status FROM failures WHERE status >= 400 AND status < 500 AND status NOT IN (429, 499)
UNION ALL
SELECT arg_min(event_id, (ts, event_id)), status FROM failures WHERE status IN (429, 499)
GROUP BY status, date_trunc('second', ts)"""))
def q_error_log_sample(spark, sf):
    """Failures that get logged (429 / 499 at most once per second)."""
    return fb.error_log_sample(fx.failures(spark, sf)).select("event_id", "status")


@register("sink_feedback", sql(["fb_gated"], """
SELECT feedback_key, concat('{', concat_ws(',',
    '"feedback_key":' || CAST(to_json(feedback_key) AS VARCHAR),
    CASE WHEN rating IS NOT NULL THEN '"rating":' || CAST(to_json(rating) AS VARCHAR) END,
    CASE WHEN better_response IS NOT NULL THEN '"better_response":' || CAST(to_json(better_response) AS VARCHAR) END,
    CASE WHEN is_deleted IS NOT NULL THEN '"is_deleted":' || CAST(to_json(is_deleted) AS VARCHAR) END,
    '"apiKey":' || CAST(to_json(api_key) AS VARCHAR)), '}') AS body
FROM fb_gated"""))
def q_sink_feedback(spark, sf):
    """K2: feedback bodies with the wire names (absent fields left out)."""
    f = fb.feedback_gate(fx.feedback(spark, sf), CFG)
    return f.select("feedback_key", fb.feedback_body(f).alias("body"))


@register("chain_upsert", sql(["chain_results"], "SELECT id, result, n_updates FROM chain_results"))
def q_chain_upsert(spark, sf):
    """K3: each chain's result, last write wins."""
    return fb.chain_upsert(fb.chain_gate(fx.chain_updates(spark, sf), CFG))


# ---------------------------------------------------------------- sources and sinks

from callscope.sources import logs as lg  # noqa: E402
from callscope.sources import sinks as sk  # noqa: E402
from callscope.session import scratch_path  # noqa: E402


@register("src_calls", sql(["calls"], """
SELECT call_id, kind, is_stream, is_template, api_key, prompt_template_name, feedback_key, chat_id, chain_id,
  parent_event_id, model, max_tokens, parameters, epoch_ms(started_at) AS started_ms, epoch_ms(ended_at) AS ended_ms, tools,
  CAST(to_json(context) AS VARCHAR) AS context, CAST(to_json(messages) AS VARCHAR) AS messages,
  CAST(to_json(params) AS VARCHAR) AS params, CAST(to_json(history_params) AS VARCHAR) AS history_params,
  CAST(to_json(template_chat) AS VARCHAR) AS template_chat, prompt,
  CAST(to_json(prompt_parts) AS VARCHAR) AS prompt_parts, CAST(to_json(error) AS VARCHAR) AS error, content,
  CAST(to_json(function_call) AS VARCHAR) AS function_call, CAST(to_json(tool_calls) AS VARCHAR) AS tool_calls,
  finish_reason, CAST(to_json(usage) AS VARCHAR) AS usage, logprobs
FROM calls"""))
def q_src_calls(spark, sf):
    """The call log read back from JSON lines with its schema."""
    c = lg.calls_log(spark, sf)
    return c.select(
        "call_id", "kind", "is_stream", "is_template", "api_key", "prompt_template_name", "feedback_key",
        "chat_id", "chain_id", "parent_event_id", "model", "max_tokens", "parameters",
        F.unix_millis("started_at").alias("started_ms"), F.unix_millis("ended_at").alias("ended_ms"), "tools",
        *[js(c_).alias(c_) for c_ in ("context", "messages", "params", "history_params", "template_chat")],
        "prompt", js("prompt_parts").alias("prompt_parts"), js("error").alias("error"), "content",
        js("function_call").alias("function_call"), js("tool_calls").alias("tool_calls"), "finish_reason",
        js("usage").alias("usage"), "logprobs")


@register("src_chunks", sql(["chunks"], """
SELECT call_id, seq, epoch_ms(ts) AS ts_ms, role, content, text,
  CAST(to_json(function_call) AS VARCHAR) AS function_call, CAST(to_json(tool_calls) AS VARCHAR) AS tool_calls,
  finish_reason, CAST(to_json(usage) AS VARCHAR) AS usage, logprobs
FROM chunks"""))
def q_src_chunks(spark, sf):
    """The chunk log read back from parquet with its schema."""
    c = lg.chunks_log(spark, sf)
    return c.select("call_id", "seq", F.unix_millis("ts").alias("ts_ms"), "role", "content", "text",
                    js("function_call").alias("function_call"), js("tool_calls").alias("tool_calls"),
                    "finish_reason", js("usage").alias("usage"), "logprobs")


@register("src_threads", sql(["messages", "runs", "assistants"], """
SELECT m.thread_id, m.msg_id, m.pos, m.role, CAST(to_json(m.content) AS VARCHAR) AS content,
       r.run_id, r.status, a.name AS assistant_name
FROM messages m LEFT JOIN runs r ON m.thread_id = r.thread_id
LEFT JOIN assistants a ON r.assistant_id = a.assistant_id"""))
def q_src_threads(spark, sf):
    """S3: runs, assistants and messages read back with their schemas."""
    runs, asst, msgs = lg.thread_logs(spark, sf)
    j = msgs.join(runs.select("thread_id", "run_id", "status", "assistant_id"), "thread_id", "left") \
        .join(asst.select("assistant_id", F.col("name").alias("assistant_name")), "assistant_id", "left")
    return j.select("thread_id", "msg_id", "pos", "role", js("content").alias("content"), "run_id", "status",
                    "assistant_name")


@register("sink_events", sql(["event_bodies"], "SELECT call_id, body FROM event_bodies"))
def q_sink_events(spark, sf):
    """K1: every event written as a JSON body (partitioned by day) to the
    shared folder, read back."""
    path = scratch_path(spark, "sinks", "events")
    sk.write_event_bodies(ev.events_all(_events(spark, sf), _assistant_events(spark, sf)), path)
    return sk.read_event_bodies(spark, path)


# ---------------------------------------------------------------- streaming

from callscope.streaming import jobs as sj  # noqa: E402

_EV_UUID = ("concat_ws('-', substring(md5(CAST(event_id AS VARCHAR)), 1, 8), substring(md5(CAST(event_id AS VARCHAR)), 9, 4), "
            "substring(md5(CAST(event_id AS VARCHAR)), 13, 4), substring(md5(CAST(event_id AS VARCHAR)), 17, 4), "
            "substring(md5(CAST(event_id AS VARCHAR)), 21, 12))")

register("stream_gate", sql([], f"""
SELECT call_id, api_key, prompt_template_name, chain_id, {osql.sql_redact('response')} AS response, response_time
FROM (SELECT concat('ev-', event_id) AS call_id,
        coalesce(CASE WHEN event_id % 11 = 0 THEN NULL ELSE concat('key-', event_id % 3) END, {sp.DEFAULT_KEY}) AS api_key,
        CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('tmpl-', event_type) END AS prompt_template_name,
        {_EV_UUID} AS chain_id,
        concat('Event ', event_type, ' by user', user_id, '@example.com: ', props) AS response,
        CAST(round(value * 1000) AS BIGINT) AS response_time
      FROM events)
WHERE prompt_template_name IS NOT NULL AND prompt_template_name <> '' AND api_key IS NOT NULL AND api_key <> ''
  AND (chain_id IS NULL OR regexp_matches(chain_id, '{sp.UUID_RE}'))"""))(sj.stream_gate)

@register("stream_asm", sql(["results", "calls"], """
SELECT r.call_id, true AS complete, r.response, CAST(to_json(r.tool_calls) AS VARCHAR) AS tool_calls,
       CAST(to_json(r.usage) AS VARCHAR) AS usage, r.finish_reason, r.logprobs, r.raw_response
FROM results r JOIN calls c ON r.call_id = c.call_id WHERE c.is_stream"""))
def q_stream_asm(spark, sf):
    """The results of all streamed calls, from the chunk log as a stream."""
    r = sj.stream_asm(spark, sf)
    return r.select("call_id", "complete", "response", js("tool_calls").alias("tool_calls"), js("usage").alias("usage"),
                    "finish_reason", "logprobs", "raw_response")


@register("stream_cursor", sql(["assistant_events"], f"SELECT {FLAT} FROM assistant_events"))
def q_stream_cursor(spark, sf):
    """Assistant events from runs and messages as streams."""
    return flat_events(sj.stream_cursor(spark, sf))


register("stream_asm_session", sql([], """
SELECT concat('call-', conv_id, '-', turn) AS call_id, text FROM conversations WHERE role = 'assistant'"""))(sj.stream_asm_session)
register("stream_feedback_join", sql([], """
SELECT concat('ev-', event_id) AS call_id, concat('fb-', event_id) AS feedback_key,
       CASE WHEN event_id % 7 <> 3 AND event_id % 11 <> 5 THEN CAST(event_id % 5 AS DOUBLE) / 4.0 END AS rating
FROM events"""))(sj.stream_feedback_join)
register("stream_dedup", sql([], """
SELECT feedback_key, last.rating AS rating, epoch_us(last.ts) AS ts_us, n_copies
FROM (SELECT concat('fb-', event_id // 2) AS feedback_key, count(*) AS n_copies,
             arg_max({'ts': ts, 'rating': CAST(event_id % 5 AS DOUBLE) / 4.0}, (ts, event_id % 5)) AS last
      FROM events GROUP BY event_id // 2)"""))(sj.stream_dedup)
