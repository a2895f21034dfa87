"""Language identification and toxicity on held-out rows and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from callscope.llm import langid as li
from callscope.llm import toxicity as tx
from callscope.llm.common import crc_mod4

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_crc_mod4(spark):
    import zlib
    df = spark.createDataFrame([(i,) for i in (0, 1, 17, -5, 10**12)] + [(None,)], "i long")
    for r in df.select("i", crc_mod4(F.col("i")).alias("m")).collect():
        assert r.m == (None if r.i is None else zlib.crc32(str(r.i).encode()) % 4)


def test_language_of_held_out_documents(spark, docs):
    model = li.train_model(docs)
    out = li.identify(docs.filter(crc_mod4(F.col("doc_id")) == 2), model)
    n, right = out.count(), out.filter("lang_pred = lang").count()
    assert right >= 0.98 * n and 0.1 < model.temperature < 10
    assert out.filter("score < 0 or score > 1").count() == 0
    # held-out languages are never read: hiding them gives the same model
    hidden = docs.withColumn("lang", F.when(crc_mod4(F.col("doc_id")) != 2, F.col("lang")))
    assert np.array_equal(li.train_model(hidden).weights, model.weights)


def test_language_of_odd_rows(spark, docs):
    model = li.train_model(docs)
    rows = [(1, None, "zz", 0.5), (2, "", None, None), (3, "123 !? 456", "x", 1.0), (None, "the and of with the", None, 0.0),
            (5, "den der die und mit " * 30_000, "en", 0.0), (5, "den der die und mit " * 30_000, "en", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    out = li.identify(df, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[5][0] == "de" and got[None][0] in model.languages
    empty = li.train_model(docs.limit(0))
    assert {r.lang_pred for r in li.identify(df, empty).collect()} == {"und"} and li.identify(df.limit(0), model).count() == 0


def test_gram_counts_by_hand():
    c = li.gram_counts("Abab")
    assert c.sum() == 4 + 3 + 2 and sorted(c[c > 0].tolist()) == [1, 1, 1, 2, 2, 2]
    assert li.gram_counts("").sum() == 0 and li.gram_counts("x").sum() == 1


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, (4000, 3))
    y = np.array([rng.choice(3, p=p) for p in li.probabilities(z)])
    assert 0.85 < li.fit_temperature(z, y) < 1.2 and 2.4 < li.fit_temperature(3 * z, y) < 3.6


def test_ftrl_is_sparse_and_right():
    rng = np.random.default_rng(2)
    rows, y = [], rng.integers(0, 2, 600)
    for t in y:
        idx = np.unique(np.concatenate([[t], 2 + rng.integers(0, 200, 8)]))
        rows.append((idx, np.ones(len(idx)) / 3))
    w, b = li.fit_ftrl(rows, y, 2, 300, l1=1.0)
    assert (np.abs(w[2:]).max(1) == 0).mean() > 0.5 and w[0, 0] > 0 > w[0, 1]
    assert np.mean([np.argmax(v @ w[i] + b) == t for (i, v), t in zip(rows, y)]) > 0.97


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scorer = tx.train_scorer(docs, labels)
    held = labels.filter(crc_mod4(F.col("doc_id")) == 2).select("doc_id", "toxic")
    out = tx.score(docs, scorer).join(held, "doc_id").select("score", "toxic").toPandas()
    assert out.score.between(0, 1).all()
    assert auc(out.score.to_numpy(), out.toxic.to_numpy()) > 0.85
    flagged = out.score >= 0.3
    assert (out.toxic[flagged] == 1).mean() > 0.75 and (out.toxic[~flagged] == 0).mean() > 0.95


def test_toxicity_of_odd_tables(spark, docs):
    labels = spark.createDataFrame([(i, None if i % 50 == 0 else int(i % 9 == 0), 1) for i in range(300)] * 2 + [(None, 1, 0)],
                                   "doc_id long, toxic int, quality int")
    rows = [(i, ("idiot " if i % 9 == 0 else "") + f"plain words {i} here " * (1 + i % 5), 0.5) for i in range(300)]
    rows += [(900, None, None), (901, "", 1.0), (None, "IDIOT!", 0.0), (902, "calm words " * 30_000, 0.0)] + [(5, "again", 0.0)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    s = tx.train_scorer(df, labels)
    assert any(t.startswith("idio") for t in s.lexicon)
    out = {r.doc_id: r.score for r in tx.score(df, s).collect()}
    assert len(tx.score(df, s).columns) == 3 and all(0 <= v <= 1 for v in out.values())
    assert min(v for d, v in out.items() if d is not None and d < 300 and d % 9 == 0) > 0.3 > out[900]
    # nothing to learn from: no row is toxic
    for d, lab in ((df.limit(0), labels), (df, labels.limit(0)), (df, labels.filter("toxic = 0"))):
        none = tx.train_scorer(d, lab)
        assert max((r.score for r in tx.score(df, none).collect()), default=0) < 0.3
    assert tx.score(df.limit(0), s).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(4)
    n, counts = 40_000, {}
    y = rng.random(n) < 0.1
    v = np.zeros((n, 5), int)
    for j, (hit, false) in enumerate([(0.8, 0.01), (0.7, 0.02), (0.6, 0.05), (0.3, 0.3)]):
        v[:, j] = rng.random(n) < np.where(y, hit, false)
    v[:, 4] = np.where(rng.random(n) < 0.95, v[:, 2], rng.random(n) < 0.1)  # an echo of the third
    for i, row in enumerate(v.tolist()):
        key = tuple(row), int(y[i]) if i < 10_000 else None
        counts[key] = counts.get(key, 0) + 1
    m = tx.fit_label_model([(k, label, c) for (k, label), c in sorted(counts.items(), key=str)])
    assert (2, 4) in m.groups and 0.07 < m.share < 0.13
    q = np.array([m.posterior(tuple(r)) for r in v.tolist()])
    assert auc(q, y.astype(int)) > 0.95
    single = {g: t for g, t in zip(m.groups, m.tables)}
    assert abs(single[(0,)][(1,)][1] - 0.8) < 0.1


def test_lexicon_covers_and_ignores_copies():
    toxic = [f"text {i} vexo{i % 7} more" for i in range(60)] + ["copied words here vexoa"] * 200
    clean = [f"text {i} of more words" for i in range(400)]
    assert tx.mine_lexicon(toxic, clean)[:1] == ["vexo*"]
    assert tx.mine_lexicon([], clean) == tx.mine_lexicon(toxic, []) == []


def test_numerals_are_no_letters(spark):
    rows = [(i, text, lang, "kept", 1.5) for i, (text, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 40)]
    schema = "doc_id long, text string, lang string, found string, _found double"
    docs = spark.createDataFrame(rows, schema)
    odd = spark.createDataFrame([(900, "½ ² ③", None, "kept", 1.5), (901, "Ⅷ 12 ٣", None, "kept", 1.5), (902, "½ ª", None, "kept", 1.5),
                                 (903, "", None, "kept", 1.5), (904, None, None, "kept", 1.5)], schema)
    out = li.identify(odd, li.train_model(docs))
    assert out.columns == [*odd.columns, "lang_pred", "score"]
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 903, 904)) and got[902].lang_pred in ("en", "de")
    assert all((r.found, r["_found"]) == ("kept", 1.5) for r in got.values())
