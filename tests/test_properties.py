"""Brute-force checks on random inputs: one-pass template formatting
against a plain Python implementation, and the redaction guards against the
unguarded rule chain."""

import random
import re

from pyspark.sql import functions as F

from callscope.functions import redact, templates as tp

NAME = re.compile(r"\{([a-zA-Z0-9_\[\].]+)\}")
ESC = re.compile(r"\\\{([a-zA-Z0-9_\[\].]+)\\\}")


def py_format(t, params):
    out = NAME.sub(lambda m: "null" if params.get(m.group(1), "null") is None else params.get(m.group(1), "null"), t)
    return ESC.sub(lambda m: "{" + m.group(1) + "}", out)


def test_format_matches_python(spark):
    rng = random.Random(11)
    names = ["a", "b", "x.y", "z[0]", "_q"]
    pieces = ["{a}", "{b}", "{x.y}", "{z[0]}", "{_q}", "\\{a\\}", "\\{b}", "{", "}", "text ", "{{a}}", "{ a}", "é"]
    rows = []
    for _ in range(400):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        params = {n: rng.choice(["V", "{a}", "\\{b\\}", "", None, "x y"]) for n in names if rng.random() < 0.8}
        rows.append((t, params))
    df = spark.createDataFrame(rows, "t string, p map<string,string>")
    got = df.select("t", "p", tp.format_template("t", "p").alias("f"), tp.missing_vars("t", "p").alias("m")).collect()
    for r in got:
        missing = [n for n in dict.fromkeys(NAME.findall(r.t)) if n not in (r.p or {})]
        assert r.m == missing, r.t
        if not missing:
            assert r.f == py_format(r.t, r.p or {}), (r.t, r.p)


def test_redaction_guards_are_exact(spark):
    rng = random.Random(5)
    atoms = ["Hi Bob", "call 555-123-4567", "10.1.1.235", "a:b", "1234:ABCD:23AF:1111:2222:3333:0000",
             "x@y.co", "http://e.com/p?q=1", "HTTPS://X.ORG.", "12 Main St", "90210", "4012888888881881",
             "321-45-6789", "word", " ", "\n", "é", ".", "Dear Ann", "://", "@", "7"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 12))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    names = tuple(n for n, _, _ in redact.RULES)
    got = df.select(redact.redact_text("t").alias("g"), redact._chain(F.col("t"), names).alias("w")).collect()
    assert all(r.g == r.w for r in got)


def test_error_log_sample_keeps_every_unlimited_failure(spark):
    from callscope.operators.feedback import error_log_sample
    rows = [("a", 404, "2024-01-01 00:00:00.1"), ("a", 404, "2024-01-01 00:00:00.2"), ("a", 404, "2024-01-01 00:00:00.2"),
            (None, 400, "2024-01-01 00:00:00.1"), (None, 400, "2024-01-01 00:00:00.3"), ("b", 400, None),
            ("c", 429, "2024-01-01 00:00:00.1"), ("c", 429, "2024-01-01 00:00:00.2"), (None, 429, "2024-01-01 00:00:00.3"),
            ("c", 429, "2024-01-01 00:00:01.0"), ("d", 500, "2024-01-01 00:00:00.1"), ("e", 399, "2024-01-01 00:00:00.1")]
    df = spark.createDataFrame(rows, "event_id string, status int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    out = sorted((str(r.event_id), r.status) for r in error_log_sample(df).collect())
    assert out == sorted([("a", 404)] * 3 + [("None", 400)] * 2 + [("b", 400)] + [("c", 429)] * 2)
