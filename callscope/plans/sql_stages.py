"""DuckDB SQL for the operator pipeline (oracle side).

Each CTE restates one stage of the Spark operators in plain SQL over the
fixture CTEs of `callscope.plans.oracle`. Nested outputs are compared as
JSON text with nulls kept, as the Spark queries render them.
"""

from __future__ import annotations

from callscope.plans.oracle import MSG_T, TOOL_T, sql_format, sql_redact, sql_uuid, sql_vars

UUID_RE = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$"
DEFAULT_KEY = "'key-default'"


def leaf_vars(m: str) -> str:
    return f"list_concat(coalesce({sql_vars(m + '.role')}, []::VARCHAR[]), coalesce({sql_vars(m + '.content')}, []::VARCHAR[]))"


def fmt_msg(m: str, p: str) -> str:
    return f"{{'role': {sql_format(m + '.role', p)}, 'content': {sql_format(m + '.content', p)}}}"


def splice(msgs: str, p: str, h: str) -> str:
    return (f"flatten(list_transform({msgs}, lambda m: CASE WHEN m.role = 'chat_history' "
            f"THEN flatten(list_transform({leaf_vars('m')}, lambda n: coalesce({h}[n], []::{MSG_T}[]))) "
            f"ELSE [{fmt_msg('m', p)}] END))")


def history_errors(msgs: str, h: str) -> str:
    items = f"list_filter({msgs}, lambda m: m.role = 'chat_history')"
    no_var = (f"list_transform(list_filter({items}, lambda m: len({leaf_vars('m')}) = 0), "
              f"lambda m: 'chat_history item without a variable')")
    missing = (f"list_transform(list_filter(flatten(list_transform({items}, lambda m: {leaf_vars('m')})), "
               f"lambda n: {h}[n] IS NULL), lambda n: concat('no history for variable ', n))")
    return f"list_concat(coalesce({no_var}, []::VARCHAR[]), coalesce({missing}, []::VARCHAR[]))"


def missing_vars(t: str, p: str) -> str:
    return f"list_filter({sql_vars(t)}, lambda n: NOT coalesce(map_contains({p}, n), false))"


def msg_vars(msgs: str) -> str:
    return f"flatten(list_transform({msgs}, lambda m: {leaf_vars('m')}))"


def redact_params(p: str) -> str:
    return (f"map_from_entries(list_transform(map_entries({p}), "
            f"lambda e: {{'key': e.key, 'value': {sql_redact('e.value')}}}))")


def redact_history(h: str) -> str:
    inner = f"list_transform(e.value, lambda m: {{'role': {sql_redact('m.role')}, 'content': {sql_redact('m.content')}}})"
    return f"map_from_entries(list_transform(map_entries({h}), lambda e: {{'key': e.key, 'value': {inner}}}))"


CHAT_PIECE = ("CASE WHEN usage IS NULL THEN concat_ws('', CASE WHEN content <> '' THEN content END, "
              "CASE WHEN tool_calls IS NULL AND function_call IS NOT NULL THEN CAST(to_json(function_call) AS VARCHAR) END) END")


def tools_from(chunks: str) -> str:
    """A2 over a chunk CTE: call_id -> tool_calls list ordered by index."""
    return f"""
SELECT call_id, list({{'index': idx, 'id': head.id, 'type': head.type, 'name': head.name,
                      'arguments': args}}::{TOOL_T} ORDER BY idx) AS tool_calls
FROM (
  SELECT call_id, idx, coalesce(string_agg(arguments, '' ORDER BY seq, pos), '') AS args,
         arg_min_null({{'id': id, 'type': type, 'name': name}}, seq * 1000000 + pos) AS head
  FROM (
    SELECT call_id, seq, coalesce(p['index'], 0) AS idx, p.id AS id, p.type AS type, p.name AS name,
           p.arguments AS arguments, pos
    FROM (SELECT call_id, seq, unnest(tool_calls) AS p, unnest(generate_series(1, len(tool_calls))) AS pos
          FROM {chunks} WHERE usage IS NULL AND tool_calls IS NOT NULL))
  GROUP BY call_id, idx)
GROUP BY call_id
"""


STAGES: dict[str, tuple[list[str], str]] = {}

STAGES["streamed"] = (["chunks"], f"""
SELECT call_id,
  coalesce(string_agg({CHAT_PIECE}, '' ORDER BY seq), '') AS s_chat_text,
  coalesce(string_agg(text, '' ORDER BY seq), '') AS s_completion_text,
  arg_min_null({{'role': role, 'content': content, 'function_call': function_call, 'tool_calls': tool_calls,
                'finish_reason': finish_reason, 'usage': usage, 'logprobs': logprobs}}, seq) AS first_chunk,
  arg_max_null(usage, seq) FILTER (WHERE usage IS NOT NULL) AS s_chat_usage,
  arg_max_null(finish_reason, seq) FILTER (WHERE usage IS NULL AND finish_reason <> '') AS s_chat_finish,
  arg_max_null({{'usage': usage, 'finish_reason': finish_reason, 'logprobs': logprobs}}, seq) AS s_last,
  count(*) AS s_n_chunks
FROM chunks GROUP BY call_id
""")

STAGES["stools"] = (["chunks"], tools_from("chunks"))

STAGES["results"] = (["calls", "streamed", "stools"], f"""
SELECT c.call_id,
  CASE WHEN c.is_stream THEN CASE WHEN c.kind = 'chat' THEN coalesce(s.s_chat_text, '')
                                  ELSE coalesce(s.s_completion_text, '') END
       WHEN c.kind = 'chat' THEN coalesce(CAST(to_json(c.function_call) AS VARCHAR), c.content)
       WHEN c.content <> '' THEN c.content END AS response,
  CASE WHEN c.is_stream AND c.kind = 'chat' THEN t.tool_calls
       WHEN c.is_stream THEN NULL
       WHEN c.kind = 'chat' THEN c.tool_calls ELSE []::{TOOL_T}[] END AS tool_calls,
  CASE WHEN c.is_stream THEN CASE WHEN c.kind = 'chat' THEN s.s_chat_usage ELSE s.s_last.usage END
       WHEN c.kind = 'chat' OR c.content <> '' THEN c.usage END AS usage,
  CASE WHEN c.is_stream THEN CASE WHEN c.kind = 'chat' THEN s.s_chat_finish ELSE s.s_last.finish_reason END
       WHEN c.kind = 'chat' OR c.content <> '' THEN c.finish_reason END AS finish_reason,
  CASE WHEN c.is_stream THEN CASE WHEN c.kind <> 'chat' THEN s.s_last.logprobs END
       WHEN c.kind = 'chat' OR c.content <> '' THEN c.logprobs END AS logprobs,
  CASE WHEN c.is_stream AND c.kind = 'chat' THEN to_json({{
         'role': s.first_chunk.role,
         'content': CASE WHEN coalesce(s.s_chat_text, '') <> '' AND s.first_chunk.content <> ''
                         THEN coalesce(s.s_chat_text, '') ELSE s.first_chunk.content END,
         'function_call': s.first_chunk.function_call,
         'tool_calls': CASE WHEN t.tool_calls IS NOT NULL AND s.first_chunk.tool_calls IS NOT NULL
                            THEN t.tool_calls ELSE s.first_chunk.tool_calls END,
         'finish_reason': CASE WHEN s.s_chat_finish <> '' AND s.first_chunk.finish_reason <> ''
                               THEN s.s_chat_finish ELSE s.first_chunk.finish_reason END,
         'usage': coalesce(s.s_chat_usage, s.first_chunk.usage),
         'is_stream': true}})::VARCHAR
       WHEN NOT c.is_stream THEN to_json({{'content': c.content, 'function_call': c.function_call,
         'tool_calls': c.tool_calls, 'finish_reason': c.finish_reason, 'usage': c.usage,
         'logprobs': c.logprobs}})::VARCHAR END AS raw_response
FROM calls c LEFT JOIN streamed s ON c.call_id = s.call_id LEFT JOIN stools t ON c.call_id = t.call_id
WHERE c.error IS NULL
""")

_NON_HISTORY = "list_filter(messages, lambda m: coalesce(m.role <> 'chat_history', true))"
_CHAT_MISSING = (f"list_filter(list_distinct({msg_vars(_NON_HISTORY)}), "
                 "lambda n: NOT coalesce(map_contains(params, n), false))")

STAGES["cfg_calls"] = (["calls"], f"""
SELECT * REPLACE (coalesce(api_key, {DEFAULT_KEY}) AS api_key,
                  coalesce(chain_id, parent_event_id) AS chain_id,
                  coalesce(feedback_key, {sql_uuid('call_id')}) AS feedback_key)
FROM calls
""")

STAGES["resolved"] = (["cfg_calls"], f"""
SELECT *,
  CASE WHEN kind = 'chat' AND is_template THEN {splice('messages', 'params', 'history_params')}
       WHEN kind = 'chat' THEN messages END AS resolved_messages,
  CASE WHEN kind = 'chat' AND is_template THEN messages END AS template_messages,
  CASE WHEN kind <> 'chat' AND is_template THEN {sql_format('prompt', 'params')}
       WHEN kind <> 'chat' THEN coalesce(prompt, array_to_string(prompt_parts, '')) END AS resolved_prompt,
  CASE WHEN kind <> 'chat' AND is_template THEN prompt END AS template_prompt,
  CASE WHEN NOT is_template THEN []::VARCHAR[]
       WHEN kind = 'chat' THEN list_concat(list_concat(
            CASE WHEN params IS NULL THEN ['template requires params'] ELSE []::VARCHAR[] END,
            coalesce(list_transform({_CHAT_MISSING}, lambda n: concat('missing variable ', n)), []::VARCHAR[])),
            coalesce({history_errors('messages', 'history_params')}, []::VARCHAR[]))
       ELSE list_concat(CASE WHEN params IS NULL THEN ['template requires params'] ELSE []::VARCHAR[] END,
            coalesce(list_transform({missing_vars('prompt', 'params')}, lambda n: concat('missing variable ', n)),
                     []::VARCHAR[])) END AS template_errors
FROM cfg_calls
""")

STAGES["prepared"] = (["resolved"], """
SELECT * FROM resolved
WHERE prompt_template_name IS NOT NULL AND prompt_template_name <> '' AND len(template_errors) = 0
""")

STAGES["raw_events"] = (["prepared", "results"], f"""
SELECT p.kind AS event_kind, p.call_id, p.started_at, p.feedback_key, p.api_key, p.prompt_template_name,
  p.prompt_template_name AS api_name,
  CASE WHEN p.kind <> 'chat' THEN coalesce(p.template_prompt, p.resolved_prompt) END AS prompt_template_text,
  CASE WHEN p.kind = 'chat' THEN coalesce(p.template_chat, p.template_messages, p.resolved_messages)
       END AS prompt_template_chat,
  coalesce(p.params, map([]::VARCHAR[], []::VARCHAR[])) AS params,
  p.history_params,
  CASE WHEN p.error IS NULL THEN r.response END AS response,
  CASE WHEN p.kind = 'chat' AND p.error IS NULL THEN r.raw_response END AS raw_response,
  CASE WHEN p.kind = 'chat' AND p.error IS NULL THEN r.tool_calls END AS tool_calls,
  CAST(date_diff('millisecond', p.started_at, p.ended_at) AS BIGINT) AS response_time,
  CASE WHEN p.error IS NOT NULL THEN [CAST(to_json(p.error) AS VARCHAR)] END AS response_errors,
  CASE WHEN p.error IS NULL THEN {{'usage': r.usage, 'finish_reason': r.finish_reason, 'logprobs': r.logprobs}}
       END AS response_metrics,
  {{'model_provider': 'openai', 'model_type': p.kind, 'model': p.model, 'max_tokens': p.max_tokens,
    'extra': p.parameters}}
       AS model_parameters,
  p.chat_id, p.chain_id,
  CASE WHEN p.kind <> 'chat' THEN p.context END AS context,
  CASE WHEN p.kind = 'chat' THEN p.tools END AS tools
FROM prepared p LEFT JOIN results r ON p.call_id = r.call_id
""")

STAGES["gated_events"] = (["raw_events"], f"""
SELECT * FROM raw_events
WHERE api_key IS NOT NULL AND api_key <> ''
  AND (chain_id IS NULL OR regexp_matches(chain_id, '{UUID_RE}'))
""")

STAGES["call_events"] = (["gated_events"], f"""
SELECT * REPLACE (
  {redact_params('params')} AS params,
  {redact_history('history_params')} AS history_params,
  {sql_redact('response')} AS response,
  list_transform(tool_calls, lambda t: {{'index': t['index'], 'id': t.id, 'type': t.type, 'name': t.name,
                                         'arguments': {sql_redact('t.arguments')}}}) AS tool_calls)
FROM gated_events
""")

FLAT_EVENT_COLUMNS = (
    "event_kind, call_id, feedback_key, api_key, prompt_template_name, api_name, prompt_template_text, "
    "to_json(prompt_template_chat) AS prompt_template_chat, to_json(params) AS params, "
    "to_json(history_params) AS history_params, response, raw_response, to_json(tool_calls) AS tool_calls, "
    "response_time, to_json(response_errors) AS response_errors, to_json(response_metrics) AS response_metrics, "
    "to_json(model_parameters) AS model_parameters, chat_id, chain_id, to_json(context) AS context, tools"
)

# ------------------------------------------------------------ thread runs

ASSISTANT_TEMPLATE = ("[{'role': 'assistant', 'content': a.instructions}, "
                      "{'role': 'chat_history', 'content': '{chat_history}'}]")

STAGES["runs_gated"] = (["runs"], """
SELECT *, CASE WHEN status IN ('failed', 'cancelled', 'incomplete') THEN 'error'
               WHEN status = 'completed' THEN 'messages' ELSE 'ignore' END AS route
FROM runs WHERE prompt_template_name IS NOT NULL AND prompt_template_name <> ''
""")

STAGES["msg_runs"] = (["runs_gated"], """
SELECT * FROM runs_gated r WHERE route = 'messages' AND NOT EXISTS (
  SELECT 1 FROM runs_gated o WHERE o.route = 'messages' AND o.thread_id = r.thread_id
    AND (o.completed_at < r.completed_at OR (o.completed_at = r.completed_at AND o.run_id < r.run_id)))
""")

STAGES["after_cursor"] = (["messages", "cursors"], """
SELECT m.*, row_number() OVER (PARTITION BY m.thread_id ORDER BY m.pos, m.msg_id) AS n_in_run
FROM messages m LEFT JOIN cursors c ON m.thread_id = c.thread_id
WHERE m.pos > coalesce(c.last_pos, -1)
""")

STAGES["sent"] = (["after_cursor", "msg_runs"], """
SELECT a.thread_id, a.msg_id, a.pos, a.role, a.content, a.n_in_run,
       r.run_id, r.status, r.assistant_id, r.prompt_template_name, r.api_key, r.model, r.completed_at
FROM after_cursor a JOIN msg_runs r ON a.thread_id = r.thread_id
WHERE coalesce(a.content[1].type = 'text', false)
""")

STAGES["asst_msg_events"] = (["sent", "assistants"], f"""
SELECT 'assistant' AS event_kind, s.msg_id AS call_id, s.msg_id AS feedback_key,
  coalesce(s.api_key, {DEFAULT_KEY}) AS api_key,
  coalesce(a.name, s.assistant_id) AS prompt_template_name,
  coalesce(s.prompt_template_name, a.name, s.assistant_id) AS api_name,
  CAST(NULL AS VARCHAR) AS prompt_template_text,
  {ASSISTANT_TEMPLATE} AS prompt_template_chat,
  map([]::VARCHAR[], []::VARCHAR[]) AS params,
  map(['chat_history'], [[{{'role': s.role, 'content': s.content[1].value}}]]) AS history_params,
  s.content[1].value AS response,
  CAST(1 AS BIGINT) AS response_time,
  CAST(NULL AS VARCHAR[]) AS response_errors,
  {{'model_provider': 'openai', 'model_type': 'assistants', 'model': coalesce(s.model, a.model),
    'max_tokens': CAST(NULL AS INTEGER), 'extra': CAST(NULL AS VARCHAR)}} AS model_parameters,
  s.completed_at AS started_at, CAST(NULL AS VARCHAR) AS raw_response,
  CAST(NULL AS {TOOL_T}[]) AS tool_calls,
  CAST(NULL AS STRUCT(usage STRUCT(prompt_tokens BIGINT, completion_tokens BIGINT, total_tokens BIGINT),
                      finish_reason VARCHAR, logprobs VARCHAR)) AS response_metrics,
  CAST(NULL AS VARCHAR) AS chain_id, CAST(NULL AS MAP(VARCHAR, VARCHAR)) AS context,
  CAST(NULL AS VARCHAR) AS tools,
  s.msg_id AS chat_id
FROM sent s LEFT JOIN assistants a ON s.assistant_id = a.assistant_id
""")

STAGES["asst_err_events"] = (["runs_gated", "assistants"], f"""
SELECT 'assistant' AS event_kind, r.run_id AS call_id, CAST(NULL AS VARCHAR) AS feedback_key,
  coalesce(r.api_key, {DEFAULT_KEY}) AS api_key,
  coalesce(a.name, r.assistant_id) AS prompt_template_name,
  coalesce(r.prompt_template_name, a.name, r.assistant_id) AS api_name,
  CAST(NULL AS VARCHAR) AS prompt_template_text,
  {ASSISTANT_TEMPLATE} AS prompt_template_chat,
  map([]::VARCHAR[], []::VARCHAR[]) AS params,
  CAST(NULL AS MAP(VARCHAR, {MSG_T}[])) AS history_params,
  CAST(NULL AS VARCHAR) AS response,
  CAST(1 AS BIGINT) AS response_time,
  [CAST(to_json(r.last_error) AS VARCHAR)] AS response_errors,
  {{'model_provider': 'openai', 'model_type': 'assistants', 'model': coalesce(r.model, a.model),
    'max_tokens': CAST(NULL AS INTEGER), 'extra': CAST(NULL AS VARCHAR)}} AS model_parameters,
  r.completed_at AS started_at, CAST(NULL AS VARCHAR) AS raw_response,
  CAST(NULL AS {TOOL_T}[]) AS tool_calls,
  CAST(NULL AS STRUCT(usage STRUCT(prompt_tokens BIGINT, completion_tokens BIGINT, total_tokens BIGINT),
                      finish_reason VARCHAR, logprobs VARCHAR)) AS response_metrics,
  CAST(NULL AS VARCHAR) AS chain_id, CAST(NULL AS MAP(VARCHAR, VARCHAR)) AS context,
  CAST(NULL AS VARCHAR) AS tools,
  r.thread_id AS chat_id
FROM runs_gated r LEFT JOIN assistants a ON r.assistant_id = a.assistant_id
WHERE r.route = 'error'
""")

STAGES["assistant_events"] = (["asst_msg_events", "asst_err_events"], """
SELECT * FROM (SELECT * FROM asst_msg_events UNION ALL BY NAME SELECT * FROM asst_err_events)
WHERE api_key IS NOT NULL AND api_key <> ''
""")

STAGES["all_events"] = (["call_events", "assistant_events"], """
SELECT * FROM call_events UNION ALL BY NAME SELECT * FROM assistant_events
""")

# ---------------------------------------------------------------- feedback

STAGES["tombstones"] = (["deletes"], f"""
SELECT msg_id AS feedback_key, CAST(NULL AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS better_response,
       true AS is_deleted, {DEFAULT_KEY} AS api_key, CAST(NULL AS TIMESTAMP) AS ts
FROM deletes
""")

STAGES["fb_gated"] = (["feedback"], f"""
SELECT * REPLACE (coalesce(api_key, {DEFAULT_KEY}) AS api_key) FROM feedback
WHERE feedback_key IS NOT NULL AND feedback_key <> '' AND coalesce(api_key, {DEFAULT_KEY}) <> ''
""")

STAGES["fb_all"] = (["fb_gated", "tombstones"], """
SELECT * FROM fb_gated UNION ALL BY NAME SELECT * FROM tombstones
""")

STAGES["fb_by_key"] = (["fb_all"], """
SELECT feedback_key,
  arg_max_null({'rating': rating, 'better_response': better_response}, ts)
    FILTER (WHERE rating IS NOT NULL OR better_response IS NOT NULL) AS fb,
  bool_or(coalesce(is_deleted, false)) AS is_deleted
FROM fb_all GROUP BY feedback_key
""")

STAGES["events_fb"] = (["all_events", "fb_by_key"], """
SELECT e.*, f.fb.rating AS rating, f.fb.better_response AS better_response,
       coalesce(f.is_deleted, false) AS is_deleted
FROM all_events e LEFT JOIN fb_by_key f ON e.feedback_key = f.feedback_key
""")

STAGES["chains_gated"] = (["chain_updates"], f"""
SELECT * REPLACE (coalesce(api_key, {DEFAULT_KEY}) AS api_key) FROM chain_updates
WHERE id IS NOT NULL AND id <> '' AND coalesce(api_key, {DEFAULT_KEY}) <> ''
""")

STAGES["chain_results"] = (["chains_gated"], """
SELECT id, arg_max_null(result, (ts, update_id)) AS result, count(*) AS n_updates
FROM chains_gated GROUP BY id
""")


def _js(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


_PARAMS_JSON = (
    "'{' || array_to_string(list_concat("
    "list_transform(map_entries(coalesce(params, map([]::VARCHAR[], []::VARCHAR[]))), "
    f"lambda e: {_js('e.key')} || ':' || coalesce({_js('e.value')}, 'null')), "
    f"list_transform(map_entries(coalesce(history_params, map([]::VARCHAR[], []::{MSG_T}[][]))), "
    f"lambda e: {_js('e.key')} || ':' || coalesce({_js('e.value')}, 'null'))), ',') || '}}'"
)

# written from the event contract: camel case names, null members left out,
# `prompt` always an empty object, open request parameters beside the model
STAGES["event_bodies"] = (["all_events"], f"""
SELECT call_id, '{{' || array_to_string(list_filter([
    '"feedbackKey":' || {_js('feedback_key')}, '"apiKey":' || {_js('api_key')},
    '"promptTemplateName":' || {_js('prompt_template_name')}, '"apiName":' || {_js('api_name')},
    '"promptTemplateText":' || {_js('prompt_template_text')},
    '"promptTemplateChat":' || {_js('prompt_template_chat')},
    '"response":' || {_js('response')}, '"toolCalls":' || {_js('tool_calls')},
    '"responseTime":' || {_js('response_time')}, '"responseErrors":' || {_js('response_errors')},
    '"responseMetrics":' || CAST(json_merge_patch('{{}}', to_json(response_metrics)) AS VARCHAR),
    '"chatId":' || {_js('chat_id')}, '"chainId":' || {_js('chain_id')}, '"context":' || {_js('context')},
    '"params":' || {_PARAMS_JSON},
    '"modelParameters":{{' || array_to_string(list_filter([
        '"modelProvider":' || {_js('model_parameters.model_provider')},
        '"modelType":' || {_js('model_parameters.model_type')}, '"model":' || {_js('model_parameters.model')},
        '"max_tokens":' || {_js('model_parameters.max_tokens')},
        substring(model_parameters.extra, 2, length(model_parameters.extra) - 2)], lambda x: x IS NOT NULL), ',') || '}}',
    '"rawResponse":' || raw_response, '"tools":' || tools, '"prompt":{{}}'], lambda x: x IS NOT NULL), ',') || '}}' AS body
FROM all_events
""")
