"""Explicit schemas of the logs this library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("role", T.StringType()),
                        T.StructField("content", T.StringType())])
MESSAGES_T = T.ArrayType(MESSAGE)

USAGE = T.StructType([T.StructField("prompt_tokens", T.LongType()),
                      T.StructField("completion_tokens", T.LongType()),
                      T.StructField("total_tokens", T.LongType())])

FUNCTION_CALL = T.StructType([T.StructField("name", T.StringType()),
                              T.StructField("arguments", T.StringType())])

TOOL_PIECE = T.StructType([T.StructField("index", T.IntegerType()),
                           T.StructField("id", T.StringType()),
                           T.StructField("type", T.StringType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("arguments", T.StringType())])

ERROR = T.StructType([T.StructField("status", T.IntegerType()),
                      T.StructField("message", T.StringType())])

CALLS = T.StructType([
    T.StructField("call_id", T.StringType()),
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("is_stream", T.BooleanType()),
    T.StructField("is_template", T.BooleanType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("api_key", T.StringType()),
    T.StructField("prompt_template_name", T.StringType()),
    T.StructField("feedback_key", T.StringType()),
    T.StructField("chat_id", T.StringType()),
    T.StructField("chain_id", T.StringType()),
    T.StructField("parent_event_id", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("max_tokens", T.IntegerType()),
    T.StructField("parameters", T.StringType()),  # other request parameters, a JSON object
    T.StructField("tools", T.StringType()),
    T.StructField("context", T.MapType(T.StringType(), T.StringType())),
    T.StructField("messages", MESSAGES_T),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("history_params", T.MapType(T.StringType(), MESSAGES_T)),
    T.StructField("template_chat", MESSAGES_T),
    T.StructField("prompt", T.StringType()),
    T.StructField("prompt_parts", T.ArrayType(T.StringType())),
    T.StructField("error", ERROR),
    T.StructField("content", T.StringType()),
    T.StructField("function_call", FUNCTION_CALL),
    T.StructField("tool_calls", T.ArrayType(TOOL_PIECE)),
    T.StructField("finish_reason", T.StringType()),
    T.StructField("usage", USAGE),
    T.StructField("logprobs", T.StringType()),
])

CHUNKS = T.StructType([
    T.StructField("call_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("function_call", FUNCTION_CALL),
    T.StructField("tool_calls", T.ArrayType(TOOL_PIECE)),
    T.StructField("finish_reason", T.StringType()),
    T.StructField("usage", USAGE),
    T.StructField("logprobs", T.StringType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("thread_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("assistant_id", T.StringType()),
    T.StructField("prompt_template_name", T.StringType()),
    T.StructField("api_key", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("last_error", ERROR),
    T.StructField("completed_at", T.TimestampType()),
])

ASSISTANTS = T.StructType([
    T.StructField("assistant_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("instructions", T.StringType()),
    T.StructField("model", T.StringType()),
])

CONTENT_PART = T.StructType([T.StructField("type", T.StringType()),
                             T.StructField("value", T.StringType())])

MESSAGES = T.StructType([
    T.StructField("thread_id", T.StringType()),
    T.StructField("msg_id", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("content", T.ArrayType(CONTENT_PART)),
])

# as they arrive on a stream: with the time of the message
MESSAGE_LOG = T.StructType([*MESSAGES, T.StructField("ts", T.TimestampType())])

CURSORS = T.StructType([
    T.StructField("thread_id", T.StringType()),
    T.StructField("last_msg_id", T.StringType()),
    T.StructField("last_pos", T.LongType()),
])

DELETES = T.StructType([
    T.StructField("thread_id", T.StringType()),
    T.StructField("msg_id", T.StringType()),
    T.StructField("pos", T.LongType()),
])

FEEDBACK = T.StructType([
    T.StructField("feedback_key", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("better_response", T.StringType()),
    T.StructField("is_deleted", T.BooleanType()),
    T.StructField("api_key", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

CHAIN_UPDATES = T.StructType([
    T.StructField("update_id", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("api_key", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])
