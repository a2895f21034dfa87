"""Properties of stream assembly: cutting any text into chunks and
assembling gives the text back, whatever the chunk sizes, the arrival
order, the salting block or the number of partitions."""

import random

from pyspark.sql import functions as F

from callscope.operators.assemble import assemble_stream, assemble_tools, ordered_text

SCHEMA = ("call_id string, seq bigint, role string, content string, text string, "
          "function_call struct<name:string,arguments:string>, "
          "tool_calls array<struct<index:int,id:string,type:string,name:string,arguments:string>>, "
          "finish_reason string, usage struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>, "
          "logprobs string")


def _chunks(texts, rng):
    rows = []
    for cid, text in texts.items():
        pos, seq = 0, 0
        while pos < len(text):
            k = rng.randint(1, 7)
            rows.append((cid, seq, None, text[pos:pos + k], None, None, None, None, None, None))
            pos += k
            seq += 1
        rows.append((cid, seq, None, "", None, None, None, "stop", None, None))
        rows.append((cid, seq + 1, None, "dropped", None, None, None, None, (1, 2, 3), None))
    rng.shuffle(rows)
    return rows


def test_split_and_assemble_roundtrip(spark):
    rng = random.Random(7)
    alphabet = "abc éß\n{}\\\"xyz0123"
    texts = {f"c{i}": "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))) for i in range(40)}
    df = spark.createDataFrame(_chunks(texts, rng), SCHEMA)
    for block, parts in [(4096, 1), (3, 8), (1, 5)]:
        got = assemble_stream(df.repartition(parts), block=block).select("call_id", "chat_text", "finish_reason",
                                                                        "usage.total_tokens").collect()
        assert {r.call_id: r.chat_text for r in got} == texts
        assert all(r.finish_reason == "stop" and r.total_tokens == 3 for r in got)


def test_ordered_text_with_hot_key(spark):
    # one key holds a third of all rows; salting by block keeps the result
    rows = [("hot", i, f"{i},") for i in range(3000)] + [(f"k{i % 50}", i, f"{i},") for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, o bigint, t string").repartition(7)
    got = {r.k: r.out for r in ordered_text(df, ["k"], "o", "t", "out", block=64).collect()}
    want = {}
    for k, o, t in sorted(rows, key=lambda r: r[1]):
        want[k] = want.get(k, "") + t
    assert got == want


def test_tool_pieces_by_index(spark):
    # the example in the reference's comment: two tools, arguments in three chunks
    piece = "struct<index:int,id:string,type:string,name:string,arguments:string>"
    rows = [
        ("c", 0, [(None, "call_1", "function", "get_weather", None)]),
        ("c", 1, [(None, None, None, None, '{ "location": "New')]),
        ("c", 2, [(None, None, None, None, ' York" }')]),
        ("d", 0, [(1, "b", "function", "get_time", '{"tz": "ES'), (0, "a", "function", "w", "{}")]),
        ("d", 1, [(1, None, None, None, 'T"}')]),
    ]
    df = spark.createDataFrame(rows, f"call_id string, seq bigint, tool_calls array<{piece}>") \
        .withColumn("usage", F.lit(None).cast("struct<prompt_tokens:bigint>"))
    got = {r.call_id: [tuple(t) for t in r.tool_calls] for r in assemble_tools(df).collect()}
    assert got["c"] == [(0, "call_1", "function", "get_weather", '{ "location": "New York" }')]
    assert got["d"] == [(0, "a", "function", "w", "{}"), (1, "b", "function", "get_time", '{"tz": "EST"}')]
