"""DuckDB SQL for the derived inputs, used by `oracle_sql()`.

Each fixture of `callscope.sources.fixtures` is written again here as a
CTE over the driver's views, by a different route where one exists (self
joins instead of a copy-and-group, `unnest(generate_series)` instead of
`explode`), so the oracle checks the recipe as well as the operator.
"""

from __future__ import annotations

# Classes and patterns of personal data, from the survey's rule
# table, in its order; written here again, so that the operator's table is
# checked against it. `\\1` is RE2's first group.
REDACTION = [
    (r'(?i)\bhttps?://[^\s<>"]*[^\s<>".,;:!?)]', "URL"),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", "EMAIL_ADDRESS"),
    (r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b|\b(?:[0-9A-Fa-f]{1,4}:){5,8}[0-9A-Fa-f]{1,4}\b", "IP_ADDRESS"),
    (r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b|\b[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}\b", "CREDIT_CARD_NUMBER"),
    (r"\b[0-9]{3}[ .-][0-9]{2}[ .-][0-9]{4}\b", "US_SOCIAL_SECURITY_NUMBER"),
    (r"(?:\(?\+[0-9]{1,3}\)?[ .-]?|\b[0-9][ .-])?(?:\([0-9]{3}\)|\b[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}\b", "PHONE_NUMBER"),
    (r"(?i)\b[0-9]{1,5}(?: [A-Za-z]+){1,3} (?:st|street|ave|avenue|rd|road|blvd|ln|lane|dr|drive)\b\.?(?: (?:apt|suite|unit) [0-9A-Za-z]+)?",
     "STREET_ADDRESS"),
    (r"\b[0-9]{5}(?:-[0-9]{4})?\b", "ZIPCODE"),
    (r"\b(Hi|Hello|Hey|Dear) [A-Z][a-z]+\b", r"\1 PERSON_NAME"),
]


def sql_uuid(expr: str) -> str:
    h = f"md5(CAST({expr} AS VARCHAR))"
    return (f"concat(substring({h},1,8),'-',substring({h},9,4),'-4',substring({h},14,3),"
            f"'-a',substring({h},18,3),'-',substring({h},21,12))")


MSG_T = "STRUCT(role VARCHAR, content VARCHAR)"
TOOL_T = 'STRUCT("index" INTEGER, id VARCHAR, type VARCHAR, name VARCHAR, arguments VARCHAR)'


def sql_redact(expr: str) -> str:
    """R1 as a DuckDB `regexp_replace` chain (RE2)."""
    out = expr
    for pattern, token in REDACTION:
        out = f"regexp_replace({out}, '{pattern}', '{token}', 'g')"
    return out


PLACEHOLDER = r"\{([a-zA-Z0-9_\[\].]+)\}"
ESCAPED = r"\\\{([a-zA-Z0-9_\[\].]+)\\\}"


def sql_vars(t: str) -> str:
    """Distinct names in first-seen order."""
    ex = f"regexp_extract_all({t}, '{PLACEHOLDER}', 1)"
    return f"list_filter({ex}, lambda x, i: list_position({ex}, x) = i)"


def sql_substitute(t: str, p: str) -> str:
    """T2 on text `t` with MAP(VARCHAR, VARCHAR) `p`: one pass, no unescape."""
    parts = f"string_split_regex({t}, '{PLACEHOLDER}')"
    names = f"regexp_extract_all({t}, '{PLACEHOLDER}', 1)"
    return (f"array_to_string(list_transform(generate_series(1, len({parts})), lambda i: "
            f"{parts}[i] || CASE WHEN i > len({names}) THEN '' "
            f"ELSE coalesce({p}[{names}[i]], 'null') END), '')")


def sql_format(t: str, p: str) -> str:
    """T2 + T3."""
    return (f"CASE WHEN {t} IS NULL THEN NULL "
            f"ELSE regexp_replace({sql_substitute(t, p)}, '{ESCAPED}', '{{\\1}}', 'g') END")


FIXTURES: dict[str, tuple[list[str], str]] = {}

FIXTURES["call_base"] = ([], """
SELECT a.conv_id, a.turn, u.text AS user_text, a.text AS reply,
  CASE WHEN a.conv_id %% 4 = 3 THEN 'completion' ELSE 'chat' END AS kind,
  (a.conv_id + a.turn) %% 4 IN (0, 1) AS is_template,
  concat('call-', a.conv_id, '-', a.turn) AS call_id,
  coalesce((SELECT list({'role': p.role, 'content': p.text} ORDER BY p.turn) FROM conversations p
            WHERE p.conv_id = a.conv_id AND p.turn < a.turn - 2), []::%(MSG)s[]) AS h1,
  CASE WHEN p2.conv_id IS NOT NULL THEN [{'role': p2.role, 'content': p2.text}]
       ELSE []::%(MSG)s[] END AS h2,
  (1704067200 + a.conv_id * 3600 + a.turn * 60) * 1000 AS start_ms
FROM conversations a
JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
LEFT JOIN conversations p2 ON p2.conv_id = a.conv_id AND p2.turn = a.turn - 2
WHERE a.role = 'assistant' AND u.role = 'user'
""" % {"MSG": MSG_T})

FIXTURES["calls"] = (["call_base"], """
SELECT call_id, conv_id, turn, kind,
  (conv_id + turn) %% 2 = 0 AS is_stream,
  is_template,
  epoch_ms(start_ms) AS started_at,
  epoch_ms(start_ms + length(reply) * 13 %% 5000 + 20) AS ended_at,
  CASE WHEN conv_id %% 11 = 0 THEN NULL WHEN conv_id %% 11 = 5 THEN ''
       ELSE concat('key-', conv_id %% 3) END AS api_key,
  CASE WHEN conv_id %% 5 = 0 THEN NULL ELSE concat('tmpl-', conv_id %% 7) END AS prompt_template_name,
  CASE WHEN turn %% 3 = 0 THEN concat('fb-', conv_id * 8 + turn) END AS feedback_key,
  CASE WHEN conv_id %% 6 = 5 THEN NULL ELSE CAST(conv_id AS VARCHAR) END AS chat_id,
  CASE WHEN conv_id %% 13 = 0 THEN 'not-a-uuid' WHEN conv_id %% 3 = 0 THEN NULL
       ELSE %(CHAIN)s END AS chain_id,
  CASE WHEN conv_id %% 3 = 0 THEN %(PARENT)s END AS parent_event_id,
  ['gpt-4o-mini', 'gpt-4o', 'gpt-3.5-turbo'][conv_id %% 3 + 1] AS model,
  CAST(256 + (conv_id %% 4) * 128 AS INTEGER) AS max_tokens,
  CASE WHEN conv_id %% 2 = 0 THEN concat('{"temperature":0.', turn %% 10, ',"stop":["END"]}') END AS parameters,
  CASE WHEN kind = 'chat' AND conv_id %% 8 = 6
       THEN '[{"type":"function","function":{"name":"search"}}]' END AS tools,
  CASE WHEN kind <> 'chat' THEN map(['conv', 'turn'], [CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)])
       END AS context,
  CASE WHEN kind = 'chat' AND is_template
         THEN [{'role': 'system', 'content': 'You help {name}'},
               {'role': 'chat_history', 'content': '{h1} {h2}'},
               {'role': 'user', 'content': '{q}'}]
       WHEN kind = 'chat' THEN list_concat(list_concat(h1, h2), [{'role': 'user', 'content': user_text}])
       END AS messages,
  CASE WHEN conv_id %% 9 = 7
       THEN map(['name', 'contact'], [concat('user-', conv_id), concat('user', conv_id, '@example.com')])
       ELSE map(['name', 'q', 'contact'],
                [concat('user-', conv_id), user_text, concat('user', conv_id, '@example.com')]) END AS params,
  CASE WHEN kind = 'chat' AND is_template THEN
       CASE WHEN conv_id %% 9 = 4 THEN map(['h1'], [h1]) ELSE map(['h1', 'h2'], [h1, h2]) END
       END AS history_params,
  CASE WHEN kind = 'chat' AND conv_id %% 10 = 1
       THEN [{'role': 'system', 'content': 'Custom view of {name}'}] END AS template_chat,
  CASE WHEN kind <> 'chat' AND is_template THEN 'Answer {name}: {q}'
       WHEN kind <> 'chat' AND turn %% 3 <> 0 THEN user_text END AS prompt,
  CASE WHEN kind <> 'chat' AND NOT is_template AND turn %% 3 = 0
       THEN [substring(user_text, 1, 10), substring(user_text, 11)] END AS prompt_parts,
  CASE WHEN (conv_id * 7 + turn) %% 19 = 0
       THEN {'status': 500, 'message': 'upstream failure'} END AS error,
  CASE WHEN kind <> 'chat' AND conv_id %% 10 = 7 THEN '' ELSE reply END AS content,
  CASE WHEN kind = 'chat' AND conv_id %% 8 = 5
       THEN {'name': 'lookup', 'arguments': concat('{"turn":', turn, '}')} END AS function_call,
  CASE WHEN kind = 'chat' AND conv_id %% 8 = 6
       THEN [{'index': 0, 'id': concat('call_', call_id), 'type': 'function', 'name': 'search',
              'arguments': concat('{"q":"', conv_id, '"}')}] END AS tool_calls,
  CASE WHEN length(reply) > 1500 THEN 'length' ELSE 'stop' END AS finish_reason,
  {'prompt_tokens': CAST(length(user_text) // 4 AS BIGINT),
   'completion_tokens': CAST(length(reply) // 4 AS BIGINT),
   'total_tokens': CAST(length(user_text) // 4 + length(reply) // 4 AS BIGINT)} AS usage,
  CASE WHEN kind <> 'chat' AND conv_id %% 3 = 0 THEN '{"tokens":["x"]}' END AS logprobs
FROM call_base
""" % {"CHAIN": sql_uuid("concat('chain-', conv_id % 40)"),
       "PARENT": sql_uuid("concat('parent-', conv_id)")})

FIXTURES["chunk_base"] = (["calls"], """
SELECT *, unnest(generate_series(0, last)) AS seq FROM (
  SELECT *,
    CASE WHEN kind = 'chat' THEN n + 3 WHEN conv_id % 10 = 9 THEN n ELSE n - 1 END AS last
  FROM (SELECT *, CAST(greatest(ceil(length(content) / 16), 1) AS BIGINT) AS n,
               kind = 'chat' AND conv_id % 8 = 5 AS fc_call,
               kind = 'chat' AND conv_id % 8 = 6 AS tool_call
        FROM calls WHERE is_stream AND error IS NULL))
""")

FIXTURES["chunks"] = (["chunk_base"], """
SELECT call_id, CAST(seq AS BIGINT) AS seq,
  epoch_ms(epoch_ms(started_at) + seq * 10) AS ts,
  CASE WHEN kind = 'chat' AND seq = 0 THEN 'assistant' END AS role,
  CASE WHEN kind = 'chat' AND seq < n THEN substring(content, CAST(seq * 16 + 1 AS INTEGER), 16)
       WHEN kind = 'chat' AND seq = n + 2 THEN ''
       WHEN kind = 'chat' AND seq = n + 3 THEN 'ignored usage content' END AS content,
  CASE WHEN kind <> 'chat' AND seq < n THEN substring(content, CAST(seq * 16 + 1 AS INTEGER), 16)
       WHEN kind <> 'chat' THEN '' END AS text,
  CASE WHEN kind = 'chat' AND seq = n AND fc_call THEN function_call
       WHEN kind = 'chat' AND seq = n + 1 AND tool_call THEN {'name': 'ignored', 'arguments': '{}'}
       END AS function_call,
  CASE WHEN kind = 'chat' AND seq = n AND tool_call
         THEN [{'index': 0, 'id': concat('call_', call_id), 'type': 'function', 'name': 'search',
                'arguments': '{"q":'}]::%(TOOL)s[]
       WHEN kind = 'chat' AND seq = n + 1 AND tool_call
         THEN [{'index': 0, 'id': NULL, 'type': NULL, 'name': NULL,
                'arguments': concat('"', conv_id, '"}')}]::%(TOOL)s[] END AS tool_calls,
  CASE WHEN kind = 'chat' AND seq = n + 2 THEN finish_reason
       WHEN kind <> 'chat' AND seq = n - 1 THEN finish_reason END AS finish_reason,
  CASE WHEN kind = 'chat' AND seq = n + 3 THEN usage
       WHEN kind <> 'chat' AND seq = n - 1 THEN usage END AS usage,
  CASE WHEN kind <> 'chat' AND seq = n - 1 THEN logprobs END AS logprobs
FROM chunk_base
WHERE kind <> 'chat' OR seq < n OR seq >= n + 2 OR (seq = n AND (fc_call OR tool_call))
   OR (seq = n + 1 AND tool_call)
""" % {"TOOL": TOOL_T})

FIXTURES["tool_chunks"] = ([], """
SELECT call_id, seq, list(piece ORDER BY piece."index") AS tool_calls,
  CAST(NULL AS STRUCT(prompt_tokens BIGINT, completion_tokens BIGINT, total_tokens BIGINT)) AS usage FROM (
  SELECT concat('tc-', event_id // 3) AS call_id, CAST(0 AS BIGINT) AS seq,
         {'index': CAST(event_id %% 3 AS INTEGER), 'id': concat('call_', event_id), 'type': 'function',
          'name': event_type, 'arguments': substring(props, 1, 4)}::%(TOOL)s AS piece
  FROM events
  UNION ALL
  SELECT concat('tc-', event_id // 3), CAST(1 AS BIGINT),
         {'index': CAST(event_id %% 3 AS INTEGER), 'id': NULL, 'type': NULL, 'name': NULL,
          'arguments': substring(props, 5)}::%(TOOL)s
  FROM events)
GROUP BY call_id, seq
""" % {"TOOL": TOOL_T})

FIXTURES["templated"] = ([], r"""
SELECT o.o_orderkey AS row_id,
  CASE WHEN o.o_orderkey % 3 = 0
       THEN 'Dear {name}, order {order.id} is {status}. \{keep\} {name} ({priority})'
       ELSE concat('Dear {name}, order {order.id} is {status}. \{keep\} {name} [', o.o_orderpriority, ']')
       END AS template,
  CASE WHEN o.o_orderkey % 7 = 0
       THEN map(['name', 'order.id', 'priority'],
                [CASE WHEN o.o_orderkey % 10 = 0 THEN '{status}' ELSE c.c_name END,
                 CAST(o.o_orderkey AS VARCHAR), o.o_orderpriority])
       ELSE map(['name', 'order.id', 'status', 'priority'],
                [CASE WHEN o.o_orderkey % 10 = 0 THEN '{status}' ELSE c.c_name END,
                 CAST(o.o_orderkey AS VARCHAR), o.o_orderstatus, o.o_orderpriority]) END AS params,
  map(['k_{order.id}', 'state'], ['Dear {name}', '{status}']) AS map_template
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")

FIXTURES["runs"] = ([], """
SELECT concat('run-', conv_id, '-', k) AS run_id, CAST(conv_id AS VARCHAR) AS thread_id, status,
  concat('asst-', (conv_id + k) % 25) AS assistant_id,
  CASE WHEN (conv_id + k) % 4 = 1 THEN NULL ELSE concat('run-tmpl-', conv_id % 3) END AS prompt_template_name,
  CASE WHEN conv_id % 7 = 3 THEN NULL WHEN (conv_id + k) % 9 = 5 THEN ''
       ELSE concat('key-', conv_id % 3) END AS api_key,
  CASE WHEN conv_id % 5 = 2 THEN 'gpt-4o' END AS model,
  CASE WHEN status IN ('failed', 'cancelled', 'incomplete')
       THEN {'status': 500, 'message': concat('run ', status)} END AS last_error,
  CASE WHEN status <> 'expired' THEN epoch_ms((1704067200 + conv_id * 3600 - k * 60) * 1000) END AS completed_at
FROM (SELECT conv_id, k,
        ['completed', 'failed', 'cancelled', 'incomplete', 'expired', 'completed'][(conv_id + 5 * k) % 6 + 1] AS status
      FROM (SELECT DISTINCT conv_id FROM conversations), (VALUES (0), (1), (2)) t(k) WHERE k <= conv_id % 3)
""")

FIXTURES["assistants"] = ([], """
SELECT concat('asst-', n.n_nationkey) AS assistant_id,
  CASE WHEN n.n_nationkey % 5 = 0 THEN NULL ELSE n.n_name END AS name,
  concat('You serve ', r.r_name) AS instructions, 'gpt-4o-mini' AS model
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")

FIXTURES["messages"] = ([], """
SELECT CAST(conv_id AS VARCHAR) AS thread_id, concat(conv_id, '-', turn) AS msg_id, CAST(turn AS BIGINT) AS pos, role,
  [{'type': CASE WHEN (conv_id + turn) % 7 = 0 THEN 'image' ELSE 'text' END, 'value': text}] AS content
FROM conversations
UNION ALL
SELECT CAST(1000000000 + c_nationkey % 5 AS VARCHAR), concat(1000000000 + c_nationkey % 5, '-', c_custkey),
  CAST(c_custkey AS BIGINT), 'user', [{'type': 'text', 'value': c_name}]
FROM customer
""")

FIXTURES["cursors"] = (["messages"], """
SELECT thread_id, msg_id AS last_msg_id, pos AS last_pos FROM messages
WHERE CAST(thread_id AS BIGINT) % 3 = 0 AND pos = 1
""")

FIXTURES["deletes"] = (["messages"], """
SELECT thread_id, msg_id, pos FROM messages
WHERE (CAST(thread_id AS BIGINT) % 6 = 0 AND pos = 1) OR (CAST(thread_id AS BIGINT) % 12 = 0 AND pos = 0)
""")

FIXTURES["feedback"] = ([], """
SELECT CASE WHEN doc_id % 13 = 0 THEN NULL ELSE concat('fb-', doc_id) END AS feedback_key,
  CAST(quality AS DOUBLE) AS rating,
  CASE WHEN quality = 0 THEN concat('better answer for doc ', doc_id) END AS better_response,
  toxic = 1 AS is_deleted,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat('key-', doc_id % 3) END AS api_key,
  epoch_ms((1704067200 + doc_id) * 1000) AS ts
FROM labels
""")

FIXTURES["chain_updates"] = ([], """
SELECT event_id AS update_id,
  CASE WHEN event_id %% 17 = 0 THEN NULL ELSE %(CHAIN)s END AS id,
  props AS result,
  CASE WHEN event_id %% 11 = 0 THEN NULL ELSE concat('key-', event_id %% 3) END AS api_key,
  ts
FROM events
""" % {"CHAIN": sql_uuid("concat('chain-', event_id % 40)")})

FIXTURES["failures"] = ([], """
SELECT event_id, ts,
  CASE event_type WHEN 'error' THEN 429 WHEN 'click' THEN 499 WHEN 'view' THEN 404
                  WHEN 'purchase' THEN 500 WHEN 'signup' THEN 200 END AS status
FROM events
""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_fixtures(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """`WITH <fixture CTEs>, <extra CTEs> <body>` for DuckDB."""
    ctes = [f"{n} AS ({FIXTURES[n][1].strip()})" for n in _order(names)]
    ctes += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
