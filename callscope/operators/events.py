"""Event build (E1-E11), template resolution (T10, T11) and the
redaction of calls (R3-R5).

All stages are projections and filters over the call log joined once to
its assembled results, so Catalyst fuses them into one stage after the
join; the gates run before redaction, so the regex chain sees fewer rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.functions import templates as tp
from callscope.functions.ids import is_uuid, stable_uuid
from callscope.functions.redact import redact_text, redact_value
from callscope.operators.assemble import DEFAULT_BLOCK, KEEP_NULLS, result_columns, streamed_results

PARAMS_T = "map<string,string>"
# Fixed value of the event contract: the provider every event names.
MODEL_PROVIDER = "openai"
HISTORY_T = "map<string,array<struct<role:string,content:string>>>"


@dataclass(frozen=True)
class Config:
    """Client defaults (E4). `api_key` stands for the key the client
    would find in its own settings or environment."""

    api_key: str | None = "key-default"
    prompt_template_name: str | None = None
    allow_unnamed_prompts: bool = False
    redact_pii: bool = True
    chat_id: str | None = None


def _lit(v, t: str = "string") -> Column:
    return F.lit(v).cast(t)


def apply_config(calls: DataFrame, cfg: Config) -> DataFrame:
    """The call's value, else the client default (`??` semantics: only
    null falls through; an empty string stays). `chain_id` falls back to
    the deprecated `parent_event_id`."""
    return calls.withColumns({
        "api_key": F.coalesce(F.col("api_key"), _lit(cfg.api_key)),
        "prompt_template_name": F.coalesce(F.col("prompt_template_name"), _lit(cfg.prompt_template_name)),
        "chat_id": F.coalesce(F.col("chat_id"), _lit(cfg.chat_id)),
        "chain_id": F.coalesce(F.col("chain_id"), F.col("parent_event_id")),
    })


def gate_named(calls: DataFrame, cfg: Config) -> DataFrame:
    """E5: keep calls with a template name, or all when unnamed are allowed."""
    if cfg.allow_unnamed_prompts:
        return calls
    name = F.col("prompt_template_name")
    return calls.where(name.isNotNull() & (name != ""))


def gate_api_key(events: DataFrame) -> DataFrame:
    """Drop events without an API key."""
    return events.where(F.col("api_key").isNotNull() & (F.col("api_key") != ""))


def gate_chain_uuid(events: DataFrame) -> DataFrame:
    """Drop events whose chain id is present but not a UUID."""
    return events.where(F.col("chain_id").isNull() | is_uuid("chain_id"))


def with_feedback_key(calls: DataFrame) -> DataFrame:
    """The caller's feedback key, else a UUID stable across retries."""
    return calls.withColumn("feedback_key", F.coalesce(F.col("feedback_key"), stable_uuid(F.col("call_id"))))


def response_time(start: str = "started_at", end: str = "ended_at") -> Column:
    """Milliseconds between the start and the end of the call."""
    return F.timestamp_diff("MILLISECOND", F.col(start), F.col(end))


def _non_history_vars(messages: Column) -> Column:
    items = F.filter(messages, lambda m: ~F.coalesce(m["role"] == F.lit(tp.CHAT_HISTORY_ROLE), F.lit(False)))
    return tp.message_vars(items)


def resolve_templates(calls: DataFrame) -> DataFrame:
    """T10 + T11: resolved messages / prompt and the template they came from.

    Adds `resolved_messages`, `template_messages` (chat), `resolved_prompt`,
    `template_prompt` (completion) and `template_errors` (empty when fine).
    A template without params, with a missing variable (T4) or a bad history
    slot (T9) gets errors; `quarantine` / `drop_template_errors` split them.
    """
    is_chat = F.col("kind") == "chat"
    tmpl = F.col("is_template")
    msgs, params, hist = F.col("messages"), F.col("params"), F.col("history_params")
    no_params = F.when(tmpl & params.isNull(), F.array(F.lit("template requires params")))
    chat_missing = F.transform(
        F.filter(F.array_distinct(_non_history_vars(msgs)),
                 lambda n: ~F.coalesce(F.map_contains_key(params, n), F.lit(False))),
        lambda n: F.concat(F.lit("missing variable "), n))
    prompt_missing = F.transform(tp.missing_vars(F.col("prompt"), params),
                                 lambda n: F.concat(F.lit("missing variable "), n))
    empty = F.array().cast("array<string>")
    errors = F.when(~tmpl, empty).when(is_chat, F.concat(
        F.coalesce(no_params, empty), F.coalesce(chat_missing, empty),
        F.coalesce(tp.history_errors(msgs, hist), empty))) \
        .otherwise(F.concat(F.coalesce(no_params, empty), F.coalesce(prompt_missing, empty)))
    return calls.withColumns({
        "resolved_messages": F.when(is_chat & tmpl, tp.splice_history(msgs, params, hist))
        .when(is_chat, msgs),
        "template_messages": F.when(is_chat & tmpl, msgs),
        "resolved_prompt": F.when(~is_chat & tmpl, tp.format_template(F.col("prompt"), params))
        .when(~is_chat, tp.resolve_prompt_text(F.col("prompt"), F.col("prompt_parts"))),
        "template_prompt": F.when(~is_chat & tmpl, F.col("prompt")),
        "template_errors": errors,
    })


def drop_template_errors(resolved: DataFrame, strict: bool = False) -> DataFrame:
    """Keep the calls whose template resolved. With `strict`, a bad
    template fails the job (`raise_error`), as the reference throws."""
    if strict:
        bad = F.size("template_errors") > 0
        fail = F.raise_error(F.concat(F.lit("template error in call "), F.col("call_id"), F.lit(": "),
                                      F.array_join("template_errors", "; ")))
        return resolved.where(F.when(bad, fail).isNull())
    return resolved.where(F.size("template_errors") == 0)


def quarantine(resolved: DataFrame) -> DataFrame:
    """Calls whose template could not be resolved, with the reasons."""
    return resolved.where(F.size("template_errors") > 0).select(
        "call_id", "kind", F.array_join("template_errors", "; ").alias("errors"))


def redact_call(df: DataFrame, redact_all: bool = False) -> DataFrame:
    """R3 (chat), R4 (completion), R5 (failed call).

    Response, params (history included) and tool-call arguments are
    redacted; raw response and untemplated prompts are kept as sent, unless
    `redact_all`.
    """
    # a failed call has neither response nor tool calls: only params change
    out = df.withColumns({
        "params": redact_value(F.col("params"), df.schema["params"].dataType),
        "history_params": redact_value(F.col("history_params"), df.schema["history_params"].dataType),
        "response": redact_text(F.col("response")),
        "tool_calls": F.transform("tool_calls", lambda t: t.withField("arguments", redact_text(t["arguments"]))),
    })
    if redact_all:
        mt = df.schema["prompt_template_chat"].dataType
        out = out.withColumns({
            "raw_response": redact_text(F.col("raw_response")),
            "prompt_template_chat": redact_value(F.col("prompt_template_chat"), mt),
            "prompt_template_text": redact_text(F.col("prompt_template_text")),
        })
    return out


EVENT_COLUMNS = [
    "event_kind", "call_id", "started_at", "feedback_key", "api_key", "prompt_template_name", "api_name",
    "prompt_template_text", "prompt_template_chat", "params", "history_params", "response",
    "raw_response", "tool_calls", "response_time", "response_errors", "response_metrics",
    "model_parameters", "chat_id", "chain_id", "context", "tools",
]


def _events_from(j: DataFrame) -> DataFrame:
    """E1 (chat), E2 (completion), E10 (failed call) from calls joined to
    their results; one projection, chosen by `kind`."""
    is_chat = F.col("kind") == "chat"
    failed = F.col("error").isNotNull()
    return j.select(
        F.col("kind").alias("event_kind"),
        "call_id", "started_at", "feedback_key", "api_key", "prompt_template_name",
        F.col("prompt_template_name").alias("api_name"),
        F.when(~is_chat, F.coalesce(F.col("template_prompt"), F.col("resolved_prompt")))
        .alias("prompt_template_text"),
        F.when(is_chat, F.coalesce(F.col("template_chat"), F.col("template_messages"),
                                   F.col("resolved_messages"))).alias("prompt_template_chat"),
        F.coalesce(F.col("params"), F.create_map().cast(PARAMS_T)).alias("params"),
        F.col("history_params").cast(HISTORY_T).alias("history_params"),
        F.when(~failed, F.col("r_response")).alias("response"),
        F.when(is_chat & ~failed, F.col("raw_response")).alias("raw_response"),
        F.when(is_chat & ~failed, F.col("r_tool_calls")).alias("tool_calls"),
        response_time().alias("response_time"),
        F.when(failed, F.array(F.to_json(F.col("error")))).alias("response_errors"),
        F.when(~failed, F.struct(F.col("r_usage").alias("usage"), F.col("r_finish").alias("finish_reason"),
                                 F.col("r_logprobs").alias("logprobs"))).alias("response_metrics"),
        F.struct(F.lit(MODEL_PROVIDER).alias("model_provider"), F.col("kind").alias("model_type"),
                 F.col("model").alias("model"), F.col("max_tokens").alias("max_tokens"),
                 F.col("parameters").alias("extra")).alias("model_parameters"),
        "chat_id", "chain_id",
        F.when(~is_chat, F.col("context")).alias("context"),
        F.when(is_chat, F.col("tools")).alias("tools"),
    )


def quarantined_calls(calls: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The named calls that give no event because their template cannot be
    resolved (T4, T9, T10), with the reasons; with `prepared_calls` they
    make up all named calls."""
    return quarantine(resolve_templates(with_feedback_key(gate_named(apply_config(calls, cfg), cfg))))


def prepared_calls(calls: DataFrame, cfg: Config, strict: bool = False) -> DataFrame:
    """E4, E5, E8, then T10/T11 with template failures removed (or, with
    `strict`, failing the job)."""
    c = gate_named(apply_config(calls, cfg), cfg)
    return drop_template_errors(resolve_templates(with_feedback_key(c)), strict)


def call_events(calls: DataFrame, chunks: DataFrame, cfg: Config = Config(),
                block: int = DEFAULT_BLOCK, gate: bool = True) -> DataFrame:
    """E1, E2, E10 with E4-E9 and R3-R5: one event per chat or completion call.

    The gated, resolved call log is joined once to the assembled chunk
    aggregates on `call_id` (a single branch over the call log); redaction
    runs after the gates.
    """
    c = prepared_calls(calls, cfg)
    # the chunk log, the largest table, is cut to the calls that become events before it is assembled
    wanted = c.where(F.coalesce(F.col("is_stream"), F.lit(False)) & F.col("error").isNull())
    wanted = gate_chain_uuid(gate_api_key(wanted)) if gate else wanted
    chunks = chunks.join(wanted.select("call_id"), "call_id", "left_semi")
    j = c.join(streamed_results(chunks, block), "call_id", "left")
    ev = _events_from(j.select("*", *result_columns(j)))
    if gate:
        ev = gate_chain_uuid(gate_api_key(ev))
    if cfg.redact_pii:
        ev = redact_call(ev)
    return ev.select(*EVENT_COLUMNS)


EVENT_TYPES = {
    "event_kind": "string", "call_id": "string", "started_at": "timestamp", "feedback_key": "string",
    "api_key": "string", "prompt_template_name": "string", "api_name": "string",
    "prompt_template_text": "string", "prompt_template_chat": "array<struct<role:string,content:string>>",
    "params": PARAMS_T, "history_params": HISTORY_T, "response": "string", "raw_response": "string",
    "tool_calls": "array<struct<index:int,id:string,type:string,name:string,arguments:string>>",
    "response_time": "bigint", "response_errors": "array<string>",
    "response_metrics": "struct<usage:struct<prompt_tokens:bigint,completion_tokens:bigint,"
                        "total_tokens:bigint>,finish_reason:string,logprobs:string>",
    "model_parameters": "struct<model_provider:string,model_type:string,model:string,max_tokens:int,"
                        "extra:string>",
    "chat_id": "string", "chain_id": "string", "context": PARAMS_T, "tools": "string",
}


def conform_events(df: DataFrame) -> DataFrame:
    """Any producer's events in the one event schema (absent columns null)."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                       for c, t in EVENT_TYPES.items()])


def events_all(*parts: DataFrame) -> DataFrame:
    """Chat, completion and assistant events as one table."""
    out = conform_events(parts[0])
    for p in parts[1:]:
        out = out.unionByName(conform_events(p))
    return out


def _json_string(c: Column) -> Column:
    """A string as a JSON string literal (quotes and escapes)."""
    arr = F.to_json(F.array(c))  # ["..."]
    return F.substr(arr, F.lit(2), F.length(arr) - 2)


def _json_object(members: list[Column]) -> Column:
    """A JSON object of ready `"name":value` texts; null ones are left out."""
    return F.concat(F.lit("{"), F.array_join(F.array(*members), ","), F.lit("}"))


def event_body(events: DataFrame) -> Column:
    """K1 body: one JSON object per event, wire names in camel case as the
    event contract has them. Null fields are left out; `prompt` is always an
    empty object; `params` merges scalar and history params; open request
    parameters (`extra`, a JSON object) stand beside the model's."""
    def text(name: str, c: Column) -> Column:
        return F.when(c.isNotNull(), F.concat(F.lit(f'"{name}":'), _json_string(c)))

    def nested(name: str, c: Column) -> Column:
        return F.when(c.isNotNull(), F.concat(F.lit(f'"{name}":'), F.to_json(c)))

    def ready(name: str, c: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), c)

    entries = F.concat(
        F.transform(F.map_entries(F.coalesce(F.col("params"), F.create_map().cast(PARAMS_T))),
                    lambda e: F.concat(_json_string(e["key"]), F.lit(":"),
                                       F.coalesce(_json_string(e["value"]), F.lit("null")))),
        F.transform(F.map_entries(F.coalesce(F.col("history_params"), F.create_map().cast(HISTORY_T))),
                    lambda e: F.concat(_json_string(e["key"]), F.lit(":"),
                                       F.coalesce(F.to_json(e["value"], KEEP_NULLS), F.lit("null")))))
    m = F.col("model_parameters")
    model = _json_object([
        text("modelProvider", m["model_provider"]), text("modelType", m["model_type"]), text("model", m["model"]),
        ready("max_tokens", m["max_tokens"].cast("string")),
        F.when(F.length(m["extra"]) > 2, F.substring(m["extra"], F.lit(2), F.length(m["extra"]) - 2))])
    return _json_object([
        text("feedbackKey", F.col("feedback_key")), text("apiKey", F.col("api_key")),
        text("promptTemplateName", F.col("prompt_template_name")), text("apiName", F.col("api_name")),
        text("promptTemplateText", F.col("prompt_template_text")),
        nested("promptTemplateChat", F.col("prompt_template_chat")),
        text("response", F.col("response")), nested("toolCalls", F.col("tool_calls")),
        ready("responseTime", F.col("response_time").cast("string")),
        nested("responseErrors", F.col("response_errors")), nested("responseMetrics", F.col("response_metrics")),
        text("chatId", F.col("chat_id")), text("chainId", F.col("chain_id")), nested("context", F.col("context")),
        ready("params", F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))),
        F.when(m.isNotNull(), ready("modelParameters", model)),
        ready("rawResponse", F.col("raw_response")), ready("tools", F.col("tools")), F.lit('"prompt":{}')])
