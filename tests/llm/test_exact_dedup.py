"""Exact groups against a plain grouping, under clashing digests, too."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from callscope.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, exact_groups

DOCS = "doc_id long, text string, digest string, keep_id int, salt string"


def rows_of(n=3_000):
    rnd = random.Random(1)
    texts = ["", None, "a", "a ", "A", "é", "é", "x" * 50_000, *(f"text {k}" for k in range(300))]
    out = [(i, "hot copy" if rnd.random() < 0.4 else rnd.choice(texts), "d", 1, None) for i in range(n)]
    out += [(None, "a", None, None, None), (None, "only null ids", "", 0, ""), (5, "same", "", 0, ""), (5, "same", "", 0, ""),
            (5, "twice one id", "", 0, ""), (9_999, "twice one id", "", 0, "")]
    rnd.shuffle(out)
    return out


def plain(rows):
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=repr)


def test_equal_texts(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, DOCS).repartition(13)
    assert sorted((tuple(r) for r in exact_duplicates(docs).collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("digest", [lambda t: F.lit("one"), lambda t: (F.crc32(t.cast("binary")) % 7).cast("string")])
def test_whole_texts_decide_where_digests_clash(spark, digest):
    rows = rows_of(700)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = exact_groups(docs, digest=digest).select("id", "keep_id", "group_size").collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, k, n) for i, k, n, *_ in plain(rows)), key=repr)


def test_rows_that_stay(spark):
    rows = rows_of(500)
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((tuple(r) for r in drop_exact_duplicates(docs).collect()), key=repr)
    keep = {(i, sha) for i, _, _, kept, sha in plain(rows) if kept}
    assert got == sorted((r for r in rows if (r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) in keep), key=repr)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_native_plan(spark):
    docs = spark.createDataFrame(rows_of(50), DOCS)
    plan = exact_duplicates(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "InArrow", "InPandas", "CartesianProduct"))
