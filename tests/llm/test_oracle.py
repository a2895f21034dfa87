"""Queries that SQL can express against their DuckDB twins."""

import duckdb
import pytest

from callscope.llm.queries import ORACLE, QUERIES
from tests.llm.test_variants import counted
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want) > 0
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]
    spark_types = dict(df.dtypes)
    assert all(spark_types[c] in ("bigint", "boolean", "string") for c in cols)
    assert [c for c in cols if spark_types[c] == "string"] == (["text_sha256"] if name == "op12_exact_dedup" else [])


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q not in ORACLE))
def test_query_runs_over_all_rows(spark, name):
    rows = QUERIES[name](spark, SF)
    if name == "op13_spelling_variants":
        # one row per word of all documents
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
        assert {r.word: r.n for r in rows.collect()} == counted(docs)
        return
    assert rows.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
