"""Derived inputs: call, chunk, thread and feedback logs built from the
driver's tables (recipes in FIXTURES.md).

No driver table holds LLM calls, so each log here is a deterministic
projection of one; the same recipe is written in SQL for the oracle
(`callscope.plans.oracle`). Every recipe covers its whole source table and
whole texts. Attributes that vary from row to row (missing keys, bad chain
ids, failures...) are assigned from ids, so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import functools

from callscope import schemas
from callscope.functions.ids import stable_uuid
from callscope.sources.tables import read_table

# Fixed values of the recipes.
BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
LONG_THREADS = 1_000_000_000  # first id of the long threads
PIECE_CHARS = 16  # characters per streamed text piece
CHAT_TEMPLATE = [("system", "You help {name}"), ("chat_history", "{h1} {h2}"), ("user", "{q}")]
COMPLETION_TEMPLATE = "Answer {name}: {q}"
ORDER_TEMPLATE = "Dear {name}, order {order.id} is {status}. \\{keep\\} {name}"
RUN_STATUS = ["completed", "failed", "cancelled", "incomplete", "expired", "completed"]
FAILURE_STATUS = {"error": 429, "click": 499, "view": 404, "purchase": 500, "signup": 200}


def _memo(fn):
    """Reuse a fixture's DataFrame per (session, scale): its plan is then
    analysed once however many queries start from it."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (id(spark), spark.sparkContext.applicationId, sf_dir)
        if key not in cache:
            cache[key] = fn(spark, sf_dir)
        return cache[key]
    return wrapper


def _empty_msgs() -> Column:
    return F.array().cast(schemas.MESSAGES_T)


def _msg(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def _mod(c: str, n: int) -> Column:
    return F.col(c) % n


def turn_windows(conversations: DataFrame, width: int = 4) -> DataFrame:
    """Each turn with the `width - 1` turns before it, as columns.

    A turn is copied to the `width` later turns it precedes and grouped back
    by (conv_id, turn): one shuffle on a key that is unique per row, so a
    very long conversation spreads over many tasks (a window by conv_id
    would put it in one).
    """
    shifted = conversations.select(
        "conv_id", "role", "text",
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("turn") + k).alias("t"))
                            for k in range(width)])).alias("s"))
    # collect_list keeps the aggregation hash-based (string max() would sort)
    g = shifted.groupBy("conv_id", F.col("s.t").alias("turn")).agg(
        F.collect_list(F.struct(F.col("s.k").alias("k"), "role", "text")).alias("w"))
    cols = []
    for k in range(width):
        hit = F.get(F.filter("w", lambda x: x["k"] == k), 0)
        cols += [hit["role"].alias(f"role{k}"), hit["text"].alias(f"text{k}"),
                 F.when(hit.isNotNull(), F.lit(1)).alias(f"has{k}")]
    return g.select("conv_id", "turn", *cols)


@_memo
def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls: an assistant turn right after a user turn is one LLM call.

    Prompt = the user turn, history = all turns before it (h2 the last of
    them, h1 the others), response = the assistant turn; kinds, templates,
    keys and failures vary by id.
    """
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    w = turn_windows(conv, 3).where((F.col("role0") == "assistant") & (F.col("role1") == "user"))
    before = conv.select("conv_id", F.col("turn").alias("t"), "role", "text")
    early = (w.select("conv_id", "turn").join(before, "conv_id").where(F.col("t") < F.col("turn") - 2)
             .groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("t", "role", "text"))).alias("early")))
    w = w.join(early, ["conv_id", "turn"], "left")

    conv_id, turn = F.col("conv_id"), F.col("turn")
    user_text, reply = F.col("text1"), F.col("text0")
    h1 = F.coalesce(F.transform("early", lambda x: _msg(x["role"], x["text"])), _empty_msgs())
    h2 = F.when(F.col("has2") == 1, F.array(_msg(F.col("role2"), F.col("text2")))).otherwise(_empty_msgs())
    kind = F.when(_mod("conv_id", 4) == 3, "completion").otherwise("chat")
    is_chat = kind == "chat"
    is_template = ((conv_id + turn) % 4).isin(0, 1)
    name = F.concat(F.lit("user-"), conv_id.cast("string"))
    contact = F.concat(F.lit("user"), conv_id.cast("string"), F.lit("@example.com"))
    params = F.when(_mod("conv_id", 9) == 7, F.create_map(F.lit("name"), name, F.lit("contact"), contact)) \
        .otherwise(F.create_map(F.lit("name"), name, F.lit("q"), user_text, F.lit("contact"), contact))
    history = F.when(_mod("conv_id", 9) == 4, F.create_map(F.lit("h1"), h1)) \
        .otherwise(F.create_map(F.lit("h1"), h1, F.lit("h2"), h2))
    chat_template = F.array(*[_msg(F.lit(r), F.lit(c)) for r, c in CHAT_TEMPLATE])
    start_ms = (F.lit(BASE_EPOCH) + conv_id * 3600 + turn * 60) * 1000
    call_id = F.concat(F.lit("call-"), conv_id.cast("string"), F.lit("-"), turn.cast("string"))
    usage = F.struct((F.length(user_text) / 4).cast("bigint").alias("prompt_tokens"),
                     (F.length(reply) / 4).cast("bigint").alias("completion_tokens"),
                     ((F.length(user_text) / 4).cast("bigint") + (F.length(reply) / 4).cast("bigint"))
                     .alias("total_tokens"))
    chain = stable_uuid(F.concat(F.lit("chain-"), (conv_id % 40).cast("string")))

    return w.select(
        call_id.alias("call_id"),
        conv_id.alias("conv_id"),
        turn.alias("turn"),
        kind.alias("kind"),
        ((conv_id + turn) % 2 == 0).alias("is_stream"),
        is_template.alias("is_template"),
        F.timestamp_millis(start_ms).alias("started_at"),
        F.timestamp_millis(start_ms + F.length(reply) * 13 % 5000 + 20).alias("ended_at"),
        F.when(_mod("conv_id", 11) == 0, F.lit(None).cast("string"))
        .when(_mod("conv_id", 11) == 5, F.lit(""))
        .otherwise(F.concat(F.lit("key-"), (conv_id % 3).cast("string"))).alias("api_key"),
        F.when(_mod("conv_id", 5) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("tmpl-"), (conv_id % 7).cast("string"))).alias("prompt_template_name"),
        F.when(turn % 3 == 0, F.concat(F.lit("fb-"), (conv_id * 8 + turn).cast("string")))
        .alias("feedback_key"),
        F.when(_mod("conv_id", 6) == 5, F.lit(None).cast("string"))
        .otherwise(conv_id.cast("string")).alias("chat_id"),
        F.when(_mod("conv_id", 13) == 0, F.lit("not-a-uuid"))
        .when(_mod("conv_id", 3) == 0, F.lit(None).cast("string"))
        .otherwise(chain).alias("chain_id"),
        F.when(_mod("conv_id", 3) == 0, stable_uuid(F.concat(F.lit("parent-"), conv_id.cast("string"))))
        .alias("parent_event_id"),
        F.element_at(F.array(F.lit("gpt-4o-mini"), F.lit("gpt-4o"), F.lit("gpt-3.5-turbo")),
                     (conv_id % 3 + 1).cast("int")).alias("model"),
        (F.lit(256) + (conv_id % 4) * 128).cast("int").alias("max_tokens"),
        F.when(conv_id % 2 == 0, F.concat(F.lit('{"temperature":0.'), (turn % 10).cast("string"), F.lit(',"stop":["END"]}')))
        .alias("parameters"),
        F.when(is_chat & (_mod("conv_id", 8) == 6),
               F.lit('[{"type":"function","function":{"name":"search"}}]')).alias("tools"),
        F.when(~is_chat, F.create_map(F.lit("conv"), conv_id.cast("string"),
                                      F.lit("turn"), turn.cast("string"))).alias("context"),
        F.when(is_chat & is_template, chat_template)
        .when(is_chat, F.concat(h1, h2, F.array(_msg(F.lit("user"), user_text)))).alias("messages"),
        params.alias("params"),
        F.when(is_chat & is_template, history).alias("history_params"),
        F.when(is_chat & (_mod("conv_id", 10) == 1),
               F.array(_msg(F.lit("system"), F.lit("Custom view of {name}")))).alias("template_chat"),
        F.when(~is_chat & is_template, F.lit(COMPLETION_TEMPLATE))
        .when(~is_chat & (turn % 3 != 0), user_text).alias("prompt"),
        F.when(~is_chat & ~is_template & (turn % 3 == 0),
               F.array(F.substring(user_text, 1, 10), F.substring(user_text, 11, 1 << 30))).alias("prompt_parts"),
        F.when((conv_id * 7 + turn) % 19 == 0,
               F.struct(F.lit(500).alias("status"), F.lit("upstream failure").alias("message"))).alias("error"),
        F.when(~is_chat & (_mod("conv_id", 10) == 7), F.lit("")).otherwise(reply).alias("content"),
        F.when(is_chat & (_mod("conv_id", 8) == 5),
               F.struct(F.lit("lookup").alias("name"),
                        F.concat(F.lit('{"turn":'), turn.cast("string"), F.lit("}")).alias("arguments")))
        .alias("function_call"),
        F.when(is_chat & (_mod("conv_id", 8) == 6),
               F.array(F.struct(F.lit(0).alias("index"), F.concat(F.lit("call_"), call_id).alias("id"),
                                F.lit("function").alias("type"), F.lit("search").alias("name"),
                                F.concat(F.lit('{"q":"'), conv_id.cast("string"), F.lit('"}'))
                                .alias("arguments")))).alias("tool_calls"),
        F.when(F.length(reply) > 1500, F.lit("length")).otherwise(F.lit("stop")).alias("finish_reason"),
        usage.alias("usage"),
        F.when(~is_chat & (_mod("conv_id", 3) == 0), F.lit('{"tokens":["x"]}')).alias("logprobs"),
    )


def chunks(calls_df: DataFrame) -> DataFrame:
    """Chunk log of the streamed calls that did not fail.

    Chat: 16-character content pieces, then a function-call or two
    tool-call pieces for some calls, a finish chunk and a usage chunk (whose
    content must be ignored). Completion: 16-character text pieces, metrics
    on the last one; some streams end with an empty chunk.
    """
    c = calls_df.where(F.col("is_stream") & F.col("error").isNull())
    n = F.greatest(F.ceil(F.length("content") / PIECE_CHARS), F.lit(1)).cast("bigint")
    is_chat = F.col("kind") == "chat"
    fc_call = is_chat & (F.col("conv_id") % 8 == 5)
    tool_call = is_chat & (F.col("conv_id") % 8 == 6)
    trailing = ~is_chat & (F.col("conv_id") % 10 == 9)
    last = F.when(is_chat, n + 3).when(trailing, n).otherwise(n - 1)
    x = c.select("*", n.alias("n"), fc_call.alias("fc_call"), tool_call.alias("tool_call"),
                 F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("seq"))
    seq, n = F.col("seq"), F.col("n")
    is_chat = F.col("kind") == "chat"
    piece = F.substring(F.col("content"), (seq * PIECE_CHARS + 1).cast("int"), PIECE_CHARS)
    tool_id = F.concat(F.lit("call_"), F.col("call_id"))
    first_piece = F.struct(F.lit(0).alias("index"), tool_id.alias("id"), F.lit("function").alias("type"),
                           F.lit("search").alias("name"), F.lit('{"q":').alias("arguments"))
    second_piece = F.struct(F.lit(0).alias("index"), F.lit(None).cast("string").alias("id"),
                            F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("name"),
                            F.concat(F.lit('"'), F.col("conv_id").cast("string"), F.lit('"}')).alias("arguments"))
    keep = (~is_chat) | (seq < n) | (seq >= n + 2) | ((seq == n) & (F.col("fc_call") | F.col("tool_call"))) \
        | ((seq == n + 1) & F.col("tool_call"))
    last_text = ~is_chat & (seq == n - 1)
    return x.where(keep).select(
        "call_id", "seq",
        F.timestamp_millis(F.unix_millis("started_at") + seq * 10).alias("ts"),
        F.when(is_chat & (seq == 0), F.lit("assistant")).alias("role"),
        F.when(is_chat & (seq < n), piece).when(is_chat & (seq == n + 2), F.lit(""))
        .when(is_chat & (seq == n + 3), F.lit("ignored usage content")).alias("content"),
        F.when(~is_chat & (seq < n), piece).when(~is_chat, F.lit("")).alias("text"),
        F.when(is_chat & (seq == n) & F.col("fc_call"), F.col("function_call"))
        .when(is_chat & (seq == n + 1) & F.col("tool_call"),
              F.struct(F.lit("ignored").alias("name"), F.lit("{}").alias("arguments"))).alias("function_call"),
        F.when(is_chat & (seq == n) & F.col("tool_call"), F.array(first_piece))
        .when(is_chat & (seq == n + 1) & F.col("tool_call"), F.array(second_piece)).alias("tool_calls"),
        F.when(is_chat & (seq == n + 2), F.col("finish_reason"))
        .when(last_text, F.col("finish_reason")).alias("finish_reason"),
        F.when(is_chat & (seq == n + 3), F.col("usage")).when(last_text, F.col("usage")).alias("usage"),
        F.when(last_text, F.col("logprobs")).alias("logprobs"),
    )


@_memo
def tool_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool-call pieces: three events make one call, one tool per event.

    Event `e` is tool `e % 3` of call `e div 3`; its `props` text is the
    arguments, cut after 4 characters into two pieces (chunks 0 and 1).
    """
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "props")
    pieces = ev.select(
        F.concat(F.lit("tc-"), (F.col("event_id") / 3).cast("bigint").cast("string")).alias("call_id"),
        F.explode(F.array(
            F.struct(F.lit(0).cast("bigint").alias("seq"),
                     F.struct((F.col("event_id") % 3).cast("int").alias("index"),
                              F.concat(F.lit("call_"), F.col("event_id").cast("string")).alias("id"),
                              F.lit("function").alias("type"), F.col("event_type").alias("name"),
                              F.substring("props", 1, 4).alias("arguments")).alias("piece")),
            F.struct(F.lit(1).cast("bigint").alias("seq"),
                     F.struct((F.col("event_id") % 3).cast("int").alias("index"),
                              F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("type"),
                              F.lit(None).cast("string").alias("name"),
                              F.substring("props", 5, 1 << 30).alias("arguments")).alias("piece")),
        )).alias("p"))
    return pieces.groupBy("call_id", F.col("p.seq").alias("seq")).agg(
        F.array_sort(F.collect_list("p.piece")).alias("tool_calls"),
        F.lit(None).cast(schemas.USAGE).alias("usage"))


@_memo
def templated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text template per order, with parameters from the order and its
    customer. Every third template also asks for `{priority}`, the others
    carry the priority as text; every tenth name is the text `{status}`
    (substitution must not expand it again); every seventh order lacks
    `status`."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey, "left")
    key = F.col("o_orderkey")
    name = F.when(key % 10 == 0, F.lit("{status}")).otherwise(F.col("c_name"))
    oid = key.cast("string")
    prio = F.col("o_orderpriority")
    template = F.when(key % 3 == 0, F.concat(F.lit(ORDER_TEMPLATE), F.lit(" ({priority})"))) \
        .otherwise(F.concat(F.lit(ORDER_TEMPLATE), F.lit(" ["), prio, F.lit("]")))
    params = F.when(key % 7 == 0, F.create_map(F.lit("name"), name, F.lit("order.id"), oid,
                                               F.lit("priority"), prio)) \
        .otherwise(F.create_map(F.lit("name"), name, F.lit("order.id"), oid,
                                F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), prio))
    return j.select(
        key.alias("row_id"),
        template.alias("template"),
        params.alias("params"),
        F.create_map(F.lit("k_{order.id}"), F.lit("Dear {name}"), F.lit("state"), F.lit("{status}"))
        .alias("map_template"),
    )


@_memo
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three assistant runs per conversation (thread =
    conversation); later ids end earlier; some carry an empty API key."""
    conv = read_table(spark, sf_dir, "conversations", "conv_id").distinct()
    c, k = F.col("conv_id"), F.col("k")
    conv = conv.select("conv_id", F.explode(F.sequence(F.lit(0).cast("bigint"), c % 3)).alias("k"))
    status = F.element_at(F.array(*[F.lit(s) for s in RUN_STATUS]), ((c + 5 * k) % 6 + 1).cast("int"))
    return conv.select(
        F.concat(F.lit("run-"), c.cast("string"), F.lit("-"), k.cast("string")).alias("run_id"),
        c.cast("string").alias("thread_id"),
        status.alias("status"),
        F.concat(F.lit("asst-"), ((c + k) % 25).cast("string")).alias("assistant_id"),
        F.when((c + k) % 4 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("run-tmpl-"), (c % 3).cast("string"))).alias("prompt_template_name"),
        F.when(c % 7 == 3, F.lit(None).cast("string")).when((c + k) % 9 == 5, F.lit(""))
        .otherwise(F.concat(F.lit("key-"), (c % 3).cast("string"))).alias("api_key"),
        F.when(c % 5 == 2, F.lit("gpt-4o")).alias("model"),
        F.when(status.isin("failed", "cancelled", "incomplete"),
               F.struct(F.lit(500).alias("status"), F.concat(F.lit("run "), status).alias("message")))
        .alias("last_error"),
        F.when(status != "expired", F.timestamp_millis((F.lit(BASE_EPOCH) + c * 3600 - k * 60) * 1000))
        .alias("completed_at"),
    )


@_memo
def assistants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One assistant per nation; instructions name its region."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return j.select(
        F.concat(F.lit("asst-"), F.col("n_nationkey").cast("string")).alias("assistant_id"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("name"),
        F.concat(F.lit("You serve "), F.col("r_name")).alias("instructions"),
        F.lit("gpt-4o-mini").alias("model"),
    )


@_memo
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread messages: every conversation turn, `pos` = turn, some of them
    images (unsupported); and five long threads without runs, one message per
    customer of a nation, `pos` = customer key."""
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    c, t = F.col("conv_id"), F.col("turn")
    ctype = F.when((c + t) % 7 == 0, F.lit("image")).otherwise(F.lit("text"))
    turns = conv.select(
        c.cast("string").alias("thread_id"),
        F.concat(c.cast("string"), F.lit("-"), t.cast("string")).alias("msg_id"),
        t.cast("bigint").alias("pos"),
        F.col("role"),
        F.array(F.struct(ctype.alias("type"), F.col("text").alias("value"))).alias("content"),
    )
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    thread = (F.lit(LONG_THREADS) + F.col("c_nationkey") % 5).cast("string")
    long = cust.select(
        thread.alias("thread_id"),
        F.concat(thread, F.lit("-"), F.col("c_custkey").cast("string")).alias("msg_id"),
        F.col("c_custkey").cast("bigint").alias("pos"),
        F.lit("user").alias("role"),
        F.array(F.struct(F.lit("text").alias("type"), F.col("c_name").alias("value"))).alias("content"),
    )
    return turns.unionByName(long)


def cursors(messages_df: DataFrame) -> DataFrame:
    """Stored cursors: at position 1 for every third thread, else unset."""
    m = messages_df.where((F.col("thread_id").cast("bigint") % 3 == 0) & (F.col("pos") == 1))
    return m.select("thread_id", F.col("msg_id").alias("last_msg_id"), F.col("pos").alias("last_pos"))


def deletes(messages_df: DataFrame) -> DataFrame:
    """Deleted messages: position 1 of every sixth thread, and position 0 of
    every twelfth (so its cursor rewinds to nothing)."""
    tid = F.col("thread_id").cast("bigint")
    m = messages_df.where(((tid % 6 == 0) & (F.col("pos") == 1)) | ((tid % 12 == 0) & (F.col("pos") == 0)))
    return m.select("thread_id", "msg_id", "pos")


@_memo
def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback from labels: key = `fb-<doc_id>`, rating = quality,
    deleted = toxic; a better response when quality is 0."""
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    d = F.col("doc_id")
    return lab.select(
        F.when(d % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("fb-"), d.cast("string")))
        .alias("feedback_key"),
        F.col("quality").cast("double").alias("rating"),
        F.when(F.col("quality") == 0, F.concat(F.lit("better answer for doc "), d.cast("string")))
        .alias("better_response"),
        (F.col("toxic") == 1).alias("is_deleted"),
        F.when(d % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("key-"), (d % 3).cast("string")))
        .alias("api_key"),
        F.timestamp_seconds(F.lit(BASE_EPOCH) + d).alias("ts"),
    )


@_memo
def chain_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain result updates from events: 40 chains, result = props."""
    return chain_updates_from(read_table(spark, sf_dir, "events", "event_id", "ts", "props"))


def chain_updates_from(ev: DataFrame) -> DataFrame:
    """The chain-update recipe on any events frame (a table or a stream)."""
    e = F.col("event_id")
    return ev.select(
        e.alias("update_id"),
        F.when(e % 17 == 0, F.lit(None).cast("string"))
        .otherwise(stable_uuid(F.concat(F.lit("chain-"), (e % 40).cast("string")))).alias("id"),
        F.col("props").alias("result"),
        F.when(e % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("key-"), (e % 3).cast("string")))
        .alias("api_key"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


@_memo
def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed event posts: HTTP status by event type."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    status = F.lit(None).cast("int")
    for etype, code in FAILURE_STATUS.items():
        status = F.when(F.col("event_type") == etype, F.lit(code)).otherwise(status)
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), status.alias("status"))
