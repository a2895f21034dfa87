"""The pipeline, stage by stage, against the operators' own rules."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as cp
from callscope.llm.common import materialize, tokenizer_path
from callscope.llm.pii import pseudonymise
from tests.llm.test_links import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def test_columns_and_order(spark, stages):
    assert [n for n, _ in cp.STAGES] == ["language ID", "toxicity", "n-gram Jaccard join", "PII", "best-fit packing"]
    want = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    assert all(s.dtypes == want for s in stages[:-1])


def test_filters_keep_clean_documents(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert stages[0].filter(r"text rlike '\\p{L}'").count() >= 0.99 * docs.filter(r"text rlike '\\p{L}'").count()
    clean = stages[0].join(labels.filter("toxic = 0"), "doc_id")
    assert clean.join(stages[1], "doc_id", "left_anti").count() <= 0.1 * clean.count()


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {d for d, (n, home) in brute(rows, cp.SHINGLE_WORDS, 800).items() if n == 0 or home == d}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_personal_data_and_packing(spark, stages):
    again = {r.doc_id: r.text for r in pseudonymise(stages[2], cp.PII_KEY).collect()}
    assert {r.doc_id: r.text for r in stages[3].collect()} == again
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    pieces = {}
    for r in stages[4].collect():
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(again)
    for d, t in again.items():
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for piece, start, length, crc in sorted(pieces[d]):
            assert start == at and crc == zlib.crc32(ids[at: at + length].tobytes())
            at += length
        assert at == len(ids)


def test_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None, "extra"), (None, "null id has words", "en", "s", 3, "extra"), (2, "", "en", None, 0, None),
            (3, "12345", None, "s", 5, "x")] + [(4, "the same words again and again here", None, "s", 1, "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for table in (df, df.limit(0)):
        docs = table
        for k, (name, stage) in enumerate(cp.STAGES):
            docs = materialize(stage(spark, docs, SF), "test-odd")
            if k < 4:
                assert docs.columns == df.columns


def test_run_is_registered(spark):
    assert E.queries()["pipeline"] is cp.run and "pipeline" not in E.oracle_sql()
    ops = {q.split("_")[0] for q in E.queries() if q.startswith("op")}
    assert ops == {f"op{n}" for n in range(1, 14)}
