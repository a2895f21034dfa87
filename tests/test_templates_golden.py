"""Template rules on small tables."""


from callscope.functions import templates as tp

MSG = "array<struct<role:string,content:string>>"


def test_vars_and_format(spark):
    df = spark.createDataFrame([("{a} {b} {c}", {"a": "A", "b": "B", "c": "C"})],
                               "t string, p map<string,string>")
    r = df.select(tp.template_vars("t").alias("v"), tp.format_template("t", "p").alias("f"),
                  tp.missing_vars("t", "p").alias("m")).first()
    assert r.v == ["a", "b", "c"] and r.f == "A B C" and r.m == []


def test_missing_variable(spark):
    df = spark.createDataFrame([("{a} {b} {c}", {"a": "A", "c": "C"})], "t string, p map<string,string>")
    assert df.select(tp.missing_vars("t", "p")).first()[0] == ["b"]


def test_single_pass_and_null_value(spark):
    df = spark.createDataFrame([("{a}{a}-{b} {n}", {"a": "{b}", "b": "B", "n": None})],
                               "t string, p map<string,string>")
    r = df.select(tp.format_template("t", "p"), tp.missing_vars("t", "p")).first()
    assert r[0] == "{b}{b}-B null" and r[1] == []


def test_nested_vars(spark):
    # leaf by leaf, in order, nulls skipped
    df = spark.createDataFrame([([("to {who}", "re {topic}"), ("by {who}", "on {day}"), (None, None)],)], f"m {MSG}")
    assert df.select(tp.message_vars("m")).first()[0] == ["who", "topic", "who", "day"]


def test_chat_template_format(spark):
    msgs = [("system", "Answer in {tongue}, {n} lines"), ("user", "Which {tool} cuts {stuff}?")]
    params = {"tongue": "Dutch", "n": "2", "tool": "saw", "stuff": "oak"}
    df = spark.createDataFrame([(msgs, params)], f"m {MSG}, p map<string,string>")
    out = [tuple(x) for x in df.select(tp.format_messages("m", "p")).first()[0]]
    assert out == [("system", "Answer in Dutch, 2 lines"), ("user", "Which saw cuts oak?")]


def test_chat_history_splice(spark):
    msgs = [("system", "Sort parcels."), ("chat_history", "{early} {late}"), ("user", "{ask}")]
    hist = {"early": [("user", "Box one?"), ("assistant", "Shelf A.")],
            "late": [("user", "Box two?"), ("assistant", "Shelf B."), ("user", "Sure?")]}
    df = spark.createDataFrame([(msgs, {"ask": "Box three?"}, hist)], f"m {MSG}, p map<string,string>, h map<string,{MSG}>")
    r = df.select(tp.splice_history("m", "p", "h").alias("o"), tp.history_errors("m", "h").alias("e")).first()
    assert [tuple(x) for x in r.o] == [("system", "Sort parcels."), *hist["early"], *hist["late"], ("user", "Box three?")]
    assert r.e == []


def test_history_errors(spark):
    df = spark.createDataFrame(
        [([("chat_history", "no vars")], {}), ([("chat_history", "{h}")], {}),
         ([("chat_history", "{h}")], {"h": []})],
        f"m {MSG}, h map<string,{MSG}>")
    errs = [r[0] for r in df.select(tp.history_errors("m", "h")).collect()]
    assert errs == [["chat_history item without a variable"], ["no history for variable h"], []]


def test_unescape(spark):
    df = spark.createDataFrame([("\\{raw\\} then {x} and \\{x\\}", {"x": "9"}), ("only \\{y\\}", {})],
                               "t string, p map<string,string>")
    out = [r[0] for r in df.select(tp.format_template("t", "p")).collect()]
    assert out == ["{raw} then 9 and {x}", "only {y}"]


def test_map_format(spark):
    df = spark.createDataFrame([({"k_{x}": "v {x}", "plain": "{y}"}, {"x": "1", "y": "2"})],
                               "m map<string,string>, p map<string,string>")
    assert df.select(tp.format_map("m", "p")).first()[0] == {"k_1": "v 1", "plain": "2"}


def test_nested_object_vars_and_format(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        [(("{w} meters", ("deep {d}", "high \\{h\\}"), 4, None), {"w": "3", "d": "1"})],
        "o struct<width:string,sides:struct<low:string,top:string>,count:bigint,note:string>, p map<string,string>")
    dt = df.schema["o"].dataType
    row = df.select(tp.nested_vars(F.col("o"), dt).alias("v"), tp.format_nested(F.col("o"), dt, "p").alias("f")).first()
    assert row.v == ["w", "d"]
    assert row.f.asDict(recursive=True) == {"width": "3 meters", "sides": {"low": "deep 1", "top": "high {h}"},
                                            "count": 4, "note": None}


def test_string_array_template_vars(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(["x={x}", "y={y}", "x={x}"],)], "o array<string>")
    assert df.select(tp.nested_vars(F.col("o"), df.schema["o"].dataType)).first()[0] == ["x", "y", "x"]


def test_prompt_parts_text_and_tokens(spark):
    df = spark.createDataFrame([(None, ["ab", "cd"], [1, 2]), ("p", None, None), (None, None, None)],
                               "p string, parts array<string>, toks array<int>")
    r = df.select(tp.resolve_prompt_text("p", "parts").alias("a"), tp.resolve_prompt_text("p", "toks").alias("b")).collect()
    assert [(x.a, x.b) for x in r] == [("abcd", "12"), ("p", "p"), (None, None)]


def test_map_keys_that_collide_after_formatting(spark):
    df = spark.sql("SELECT map('{a}', '1', 'x', '2', '{b}', '3') AS m, map('a', 'k', 'b', 'k') AS p")
    from pyspark.sql import functions as F
    got = df.select(F.map_entries(tp.format_map("m", "p")).alias("e")).first().e
    assert [tuple(x) for x in got] == [("k", "3"), ("x", "2")]
