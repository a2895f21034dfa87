"""Response assembly (A1-A11): chunk logs and static results become one
result record per call.

Ordered text is joined in two levels: first per (call, block of `block`
consecutive chunks), then per call over the few block pieces. A call with
a huge stream is thus spread over many tasks, and every other figure
(first chunk, last usage, last finish reason...) is a constant-size
`min_by`/`max_by` that Spark combines map-side before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BLOCK = 4096
# raw responses keep null fields as JSON nulls
KEEP_NULLS = {"ignoreNullFields": "false"}


def _ordered_join(order: Column, text: Column) -> Column:
    """Aggregate: `text` values joined in `order` order (nulls skipped)."""
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t")))),
                    lambda x: x["t"]), "")


def ordered_text(df: DataFrame, keys: list[str], order: str, text: str, out: str,
                 block: int = DEFAULT_BLOCK) -> DataFrame:
    """Join `text` in `order` order per `keys`, in two salted levels."""
    lvl1 = df.groupBy(*keys, F.floor(F.col(order) / block).alias("_blk")).agg(
        _ordered_join(F.col(order), F.col(text)).alias("_part"))
    return lvl1.groupBy(*keys).agg(_ordered_join(F.col("_blk"), F.col("_part")).alias(out))


def chat_piece() -> Column:
    """A1 + A3 + A5: the text a chat chunk adds to the response.

    Non-empty `content`, then the deprecated `function_call` as JSON when the
    chunk has no tool calls; chunks carrying usage add nothing.
    """
    content = F.when(F.col("content") != "", F.col("content"))
    fc = F.when(F.col("tool_calls").isNull() & F.col("function_call").isNotNull(),
                F.to_json(F.col("function_call")))
    return F.when(F.col("usage").isNull(), F.concat_ws("", content, fc))


def assemble_stream(chunks: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """One row per streamed call with every streamed figure.

    Columns: call_id, chat_text (A1/A3/A5), completion_text (A8), usage and
    finish_reason as a chat stream sees them (A4), last_metrics as a
    completion stream sees them (A8), first_chunk (A7), n_chunks and
    tool_calls (A2), all from one pass over the chunk log.
    """
    seq = F.col("seq")
    no_usage = F.col("usage").isNull()
    finish_ok = no_usage & F.col("finish_reason").isNotNull() & (F.col("finish_reason") != "")
    first = F.struct("role", "content", "function_call", "tool_calls", "finish_reason", "usage", "logprobs")
    last = F.struct("usage", "finish_reason", "logprobs")
    lvl1 = chunks.groupBy("call_id", F.floor(seq / block).alias("_blk")).agg(
        _ordered_join(seq, chat_piece()).alias("chat_part"),
        _ordered_join(seq, F.col("text")).alias("text_part"),
        F.min_by(first, seq).alias("first_chunk"),
        F.min(seq).alias("first_seq"),
        F.max_by(F.col("usage"), F.when(F.col("usage").isNotNull(), seq)).alias("usage"),
        F.max(F.when(F.col("usage").isNotNull(), seq)).alias("usage_seq"),
        F.max_by(F.col("finish_reason"), F.when(finish_ok, seq)).alias("finish_reason"),
        F.max(F.when(finish_ok, seq)).alias("finish_seq"),
        F.max_by(last, seq).alias("last_metrics"),
        F.max(seq).alias("last_seq"),
        F.count(F.lit(1)).alias("n"),
        _tool_block().alias("tool_part"),
    )
    blk = F.col("_blk")
    return lvl1.groupBy("call_id").agg(
        _ordered_join(blk, F.col("chat_part")).alias("chat_text"),
        _ordered_join(blk, F.col("text_part")).alias("completion_text"),
        F.min_by("first_chunk", "first_seq").alias("first_chunk"),
        F.max_by("usage", "usage_seq").alias("usage"),
        F.max_by("finish_reason", "finish_seq").alias("finish_reason"),
        F.max_by("last_metrics", "last_seq").alias("last_metrics"),
        F.sum("n").alias("n_chunks"),
        _merge_tool_blocks().alias("tool_calls"),
    )


TOOL_T = "array<struct<index:int,id:string,type:string,name:string,arguments:string>>"


def _tool_block() -> Column:
    """Aggregate (per call and block): the block's tool-call chunks in seq
    order; chunks with usage carry none (A5)."""
    has = F.col("usage").isNull() & F.col("tool_calls").isNotNull()
    return F.array_sort(F.collect_list(F.when(has, F.struct(F.col("seq").alias("seq"),
                                                            F.col("tool_calls").alias("tc")))))


def _merge_tool_blocks() -> Column:
    """Aggregate (per call): block parts in block order, then the tools.

    A2: pieces in (seq, position) order; a piece without an index is tool 0;
    per index the first piece gives id, type and name and the arguments of
    all pieces are joined in order (a missing piece counts as ""). Tools are
    ordered by index; a call without tool pieces gets null."""
    chunks = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_blk", "tool_part"))),
                                   lambda x: x["tool_part"]))
    return tools_from_chunks(chunks)


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once (an inlined one would be
    worked out again for every element of a lambda around it)."""
    return F.get(F.transform(F.array(value), body), 0)


def _tools_of_sorted(pieces: Column) -> Column:
    """One tool per run of equal `idx` in pieces sorted by (idx, seq, at)."""
    def tool(run: Column) -> Column:
        head = F.get(run, 0)
        return F.struct(head["idx"].alias("index"), head["id"].alias("id"), head["type"].alias("type"),
                        head["name"].alias("name"),
                        F.array_join(F.transform(run, lambda p: p["arguments"]), "").alias("arguments"))

    def runs(starts: Column) -> Column:
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(pieces)))
        return F.zip_with(starts, ends, lambda start, end: _let(F.slice(pieces, start + 1, end - start), tool))

    starts = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1),
                      lambda i: (i == 0) | (F.get(pieces, i)["idx"] != F.get(pieces, i - 1)["idx"]))
    return _let(starts, runs)


def tools_from_chunks(chunks: Column) -> Column:
    """The tools of one call from its tool chunks (array of (seq, tc)): the
    pieces are sorted by index and place once, then cut where the index
    changes, so the work follows the number of pieces."""
    pieces = F.array_sort(F.flatten(F.transform(chunks, lambda c: F.transform(
        c["tc"], lambda p, i: F.struct(F.coalesce(p["index"], F.lit(0)).alias("idx"), c["seq"].alias("seq"), i.alias("at"),
                                       p["id"].alias("id"), p["type"].alias("type"), p["name"].alias("name"),
                                       p["arguments"].alias("arguments"))))))
    return _let(pieces, lambda p: F.when(F.size(p) > 0, _tools_of_sorted(p))).cast(TOOL_T)


def assemble_tools(chunks: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """A2 alone: tool calls per call, ordered by index (same two levels as
    `assemble_stream`)."""
    lvl1 = chunks.groupBy("call_id", F.floor(F.col("seq") / block).alias("_blk")).agg(
        _tool_block().alias("tool_part"))
    out = lvl1.groupBy("call_id").agg(_merge_tool_blocks().alias("tool_calls"))
    return out.where(F.col("tool_calls").isNotNull())


def static_chat(calls: DataFrame) -> DataFrame:
    """First choice of a static chat result; a function call replaces
    the content as JSON."""
    return calls.select(
        "call_id",
        F.coalesce(F.to_json(F.col("function_call")), F.col("content")).alias("response"),
        F.col("tool_calls"),
        F.col("usage"), F.col("finish_reason"), F.col("logprobs"),
    )


def static_completion(calls: DataFrame) -> DataFrame:
    """A10: text and metrics when the text is non-empty, else neither;
    tool calls are always an empty list."""
    ok = F.col("content").isNotNull() & (F.col("content") != "")
    return calls.select(
        "call_id",
        F.when(ok, F.col("content")).alias("response"),
        F.array().cast("array<struct<index:int,id:string,type:string,name:string,arguments:string>>")
        .alias("tool_calls"),
        F.when(ok, F.col("usage")).alias("usage"),
        F.when(ok, F.col("finish_reason")).alias("finish_reason"),
        F.when(ok, F.col("logprobs")).alias("logprobs"),
    )


def raw_stream_response(final_text: Column, final_usage: Column, final_finish: Column) -> Column:
    """The first chunk, with content, tool calls and finish reason
    replaced by the final values only where the first chunk already has a
    truthy one; usage added; marked as a stream."""
    f = F.col("first_chunk")
    truthy = lambda c: c.isNotNull() & (c != "")
    content = F.when(truthy(final_text) & truthy(f["content"]), final_text).otherwise(f["content"])
    tools = F.when(F.col("s_tools").isNotNull() & f["tool_calls"].isNotNull(), F.col("s_tools")) \
        .otherwise(f["tool_calls"])
    finish = F.when(truthy(final_finish) & truthy(f["finish_reason"]), final_finish) \
        .otherwise(f["finish_reason"])
    usage = F.coalesce(final_usage, f["usage"])
    return F.to_json(F.struct(f["role"].alias("role"), content.alias("content"),
                              f["function_call"].alias("function_call"), tools.alias("tool_calls"),
                              finish.alias("finish_reason"), usage.alias("usage"),
                              F.lit(True).alias("is_stream")), KEEP_NULLS)


def streamed_results(chunks: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """A1-A4, A7, A8 per streamed call, columns prefixed `s_`."""
    return stream_columns(assemble_stream(chunks, block))


def stream_columns(assembled: DataFrame) -> DataFrame:
    """The rows of `assemble_stream` with columns prefixed `s_`."""
    return assembled.select(
        "call_id",
        F.col("chat_text").alias("s_chat_text"),
        F.col("completion_text").alias("s_completion_text"),
        F.col("usage").alias("s_chat_usage"),
        F.col("finish_reason").alias("s_chat_finish"),
        F.col("last_metrics").alias("s_last"),
        F.col("first_chunk"),
        F.col("tool_calls").alias("s_tools"),
        F.col("n_chunks").alias("s_n_chunks"),
    )


def result_columns(j: DataFrame) -> list[Column]:
    """A11 projection over calls joined to `streamed_results` (columns
    `s_*`, `first_chunk`): response, tool_calls, usage, finish_reason,
    logprobs, raw_response, streamed or static, chat or completion."""
    is_chat = F.col("kind") == "chat"
    stream = F.col("is_stream")
    s_text = F.when(is_chat, F.coalesce(F.col("s_chat_text"), F.lit(""))) \
        .otherwise(F.coalesce(F.col("s_completion_text"), F.lit("")))
    s_usage = F.when(is_chat, F.col("s_chat_usage")).otherwise(F.col("s_last.usage"))
    s_finish = F.when(is_chat, F.col("s_chat_finish")).otherwise(F.col("s_last.finish_reason"))
    ok = F.col("content").isNotNull() & (F.col("content") != "")
    empty_tools = F.array().cast("array<struct<index:int,id:string,type:string,name:string,arguments:string>>")
    static_raw = F.to_json(F.struct("content", "function_call", "tool_calls", "finish_reason", "usage", "logprobs"),
                           KEEP_NULLS)
    return [
        F.when(stream, s_text)
        .when(is_chat, F.coalesce(F.to_json(F.col("function_call")), F.col("content")))
        .when(ok, F.col("content")).alias("r_response"),
        F.when(stream & is_chat, F.col("s_tools")).when(stream, F.lit(None))
        .when(is_chat, F.col("tool_calls")).otherwise(empty_tools).alias("r_tool_calls"),
        F.when(stream, s_usage).when(is_chat | ok, F.col("usage")).alias("r_usage"),
        F.when(stream, s_finish).when(is_chat | ok, F.col("finish_reason")).alias("r_finish"),
        F.when(stream, F.when(~is_chat, F.col("s_last.logprobs")))
        .when(is_chat | ok, F.col("logprobs")).alias("r_logprobs"),
        F.when(stream & is_chat, raw_stream_response(s_text, s_usage, s_finish))
        .when(~stream, static_raw).alias("raw_response"),
    ]


def resolve_results(calls: DataFrame, chunks: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """One result per call that did not fail, streamed or static.

    Output: call_id, response, tool_calls, usage, finish_reason, logprobs,
    raw_response (JSON text). The streamed side is grouped by `call_id`,
    so the join reuses that partitioning.
    """
    c = calls.where(F.col("error").isNull())
    return _results(c.join(streamed_results(chunks, block), "call_id", "left"))


def resolve_streamed(calls: DataFrame, assembled: DataFrame) -> DataFrame:
    """A11 for streamed calls whose chunks were assembled before (rows of
    `assemble_stream`, with `complete`): the same columns, with `complete`."""
    c = calls.where(F.col("is_stream") & F.col("error").isNull())
    return _results(c.join(stream_columns(assembled), "call_id")).join(assembled.select("call_id", "complete"), "call_id")


def _results(j: DataFrame) -> DataFrame:
    return j.select("call_id", *result_columns(j)).withColumnsRenamed({
        "r_response": "response", "r_tool_calls": "tool_calls", "r_usage": "usage",
        "r_finish": "finish_reason", "r_logprobs": "logprobs"})
