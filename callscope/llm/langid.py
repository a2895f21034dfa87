"""Language identification: sparse multinomial logistic regression on TF-IDF
of character n-grams, trained by follow-the-regularised-leader (FTRL-proximal,
elastic net), with temperature calibration.

Features are n-grams of one to three lower-case code points, hashed to
`FEATURES` columns. Document frequencies are counted over all training rows;
weights are fitted on a bounded, stratified sample of them (`SAMPLE_ROWS`,
`SAMPLE_PER_LANGUAGE`), chosen by a hash of doc_id.
"""

from __future__ import annotations

import io
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscope.llm.common import crc_mod4, merge_blobs, unused, worker_tool

FEATURES = 1 << 14
ORDERS = (1, 2, 3)
#: Bounds of the labelled sample that the weights are fitted on.
SAMPLE_ROWS = 4_000
SAMPLE_PER_LANGUAGE = 700
LETTER = regex.compile(r"\p{L}")  # no numerals: ½ and Ⅷ are no letters
UNDETERMINED = "und"
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text, `FEATURES` long."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.zeros(FEATURES, np.int64)
    grams = None
    for order in ORDERS:
        if len(cp) < order:
            break
        # hash of `order` code points: the shorter gram's, then one more
        mixed = cp * MULTIPLIERS[0] if grams is None else grams[:-1] * MULTIPLIERS[1] + cp[order - 1:]
        grams = (mixed ^ (mixed >> np.uint32(15))) * MULTIPLIERS[2]
        out += np.bincount((grams ^ np.uint32(order)) >> np.uint32(18), minlength=FEATURES)
    return out


@dataclass
class Model:
    """languages, idf, weights (FEATURES x languages), bias, temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str) -> tuple[str, float]:
        """(language, calibrated probability); `und` with score 0 for a text
        without letters, or if nothing was learned."""
        if not self.languages or not LETTER.search(text):
            return UNDETERMINED, 0.0
        p = probabilities(self.logits(*tfidf(gram_counts(text), self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])

    def logits(self, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        return val @ self.weights[idx] + self.bias


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse (columns, values): (1 + log tf) * idf, scaled to length one."""
    idx = np.flatnonzero(counts)
    val = (1.0 + np.log(counts[idx])) * idf[idx]
    norm = np.sqrt((val * val).sum())
    return idx, val / norm if norm else val


def probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, features: int,
             alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02,
             epochs: int = 4, seed: int = 7, target: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with L1 and L2 on the weights and none on the bias. `target` gives soft labels
    (rows x classes) in place of `y`."""
    z = np.zeros((features, classes))
    n = np.zeros((features, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)
    soft = np.eye(classes)[y] if target is None else target
    rng = np.random.default_rng(seed)

    def weights(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, val = rows[i]
            zi, ni = z[idx], n[idx]
            w, b = weights(zi, ni, l1, l2), weights(zb, nb, 0.0, 0.0)
            err = probabilities(val @ w + b) - soft[i]
            g = val[:, None] * err
            z[idx] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[idx] = ni + g * g
            zb += err - (np.sqrt(nb + err * err) - np.sqrt(nb)) / alpha * b
            nb += err * err
    return weights(z, n, l1, l2), weights(zb, nb, 0.0, 0.0)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood, by a search over
    powers of two refined twice; between 1/64 and 64. Labels count as wrong
    with probability 1 / (rows + 2), as in Platt's scaling, so rows that are
    all right do not make the scores certain."""
    wrong = 1.0 / (len(y) + 2)
    target = np.full(logits.shape, wrong / max(1, logits.shape[1] - 1))
    target[np.arange(len(y)), y] = 1.0 - wrong

    def loss(t):
        return -(target * np.log(np.maximum(probabilities(logits / t), 1e-300))).sum(1).mean()
    grid = np.exp2(np.linspace(-6, 6, 49))
    best = min(grid, key=loss)
    for width in (0.25, 0.03):
        best = min(best * np.exp2(np.linspace(-width, width, 17)), key=loss)
    return float(best)


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """How many of all training texts (column text) hold each feature, and their number."""
    def run(batches):
        worker_tool(("frequencies",), lambda: None)  # what the worker kept for another step goes
        df, n = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                df[:FEATURES] += gram_counts(t) > 0
                n += 1
        df[FEATURES] = n
        if n:
            yield pa.RecordBatch.from_pydict({"g": [TaskContext.get().partitionId() % 16], "blob": [df.tobytes()]},
                                             schema=pa.schema([("g", pa.int32()), ("blob", pa.binary())]))

    def merge(blobs):
        return sum(np.frombuffer(b, np.int64) for b in blobs).tobytes()

    blobs = merge_blobs(train.select("text").mapInArrow(run, "g int, blob binary"), merge)
    total = sum((np.frombuffer(b, np.int64) for b in blobs), np.zeros(FEATURES + 1, np.int64))
    return total[:FEATURES], int(total[FEATURES])


def bounded_sample(train: DataFrame, by: str, per_class: int, most: int, key: str = "doc_id") -> DataFrame:
    """At most `per_class` rows of each value of `by` and `most` rows in all,
    those of the smallest hash of `key`. Classes are counted first, so only
    hashes low enough to be chosen (four times as many as wanted) are
    ranked, and a class of any size is never ranked whole."""
    order = F.xxhash64(F.lit("sample"), F.col(key))
    counts = train.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))  # one row per class
    low = F.col("_h") / F.lit(2.0 ** 64) + F.lit(0.5) <= F.lit(4.0 * per_class) / F.col("_n")
    narrow = (train.select(key, by).withColumn("_h", order).join(F.broadcast(counts), by).filter(low)
              .select(key, by, "_h").distinct())
    ranked = (narrow.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy("_h", key)))
              .filter(F.col("_r") <= per_class).orderBy("_r", "_h").limit(most).select(key).distinct())
    return train.join(F.broadcast(ranked), key, "left_semi")  # `most` keys at most


def train_model(docs: DataFrame, train_rows: Column | None = None, doc_id: str = "doc_id", text: str = "text",
                lang: str = "lang") -> Model:
    """Fit on the rows with text and lang whose crc32(doc_id) mod 4 is not 2
    (or that satisfy `train_rows`)."""
    keep = crc_mod4(F.col(doc_id)) != 2 if train_rows is None else train_rows
    train = docs.filter(keep).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                                     F.col(lang).alias("lang")).filter(
        F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    df, n = document_frequencies(train)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    sample = bounded_sample(train, "lang", SAMPLE_PER_LANGUAGE, SAMPLE_ROWS)

    def fit(batches):
        texts, langs, ids = [], [], []
        for batch in batches:
            for d, t, g in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids.append(d)
                langs.append(g)
                texts.append(tfidf(gram_counts(t), idf))
        if not ids:
            return
        order = sorted(range(len(ids)), key=lambda i: (ids[i], langs[i], len(texts[i][0])))
        names = sorted(set(langs))
        x = [texts[i] for i in order]
        y = np.array([names.index(langs[i]) for i in order])
        held = np.arange(len(x)) % 5 == 4  # a fifth calibrates
        if held.sum() < 10:
            held[:] = False
        w, b = fit_ftrl([r for r, h in zip(x, held) if not h], y[~held], len(names), FEATURES)
        m = Model(names, idf, w, b)
        if held.any() and len(names) > 1:
            m.temperature = fit_temperature(np.array([m.logits(*r) for r, h in zip(x, held) if h]), y[held])
        out = io.BytesIO()
        np.savez_compressed(out, weights=w.astype(np.float32), bias=b, temperature=m.temperature,
                            names=np.array(names))
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]}, schema=pa.schema([("model", pa.binary())]))

    # one task on the bounded sample
    got = sample.select("doc_id", "text", "lang").repartition(1).mapInArrow(fit, "model binary").collect()
    if not got:
        return Model([], idf, np.zeros((FEATURES, 0)), np.zeros(0))
    f = np.load(io.BytesIO(bytes(got[0]["model"])))
    return Model([str(x) for x in f["names"]], idf, f["weights"].astype(float), f["bias"], float(f["temperature"]))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with lang_pred (a learned language, or `und` for null text or
    one without letters) and score (calibrated probability, 0 for `und`);
    columns of these names are replaced. Whole texts are read; empty tables
    stay empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts):
        import pandas as pd
        m = worker_tool(("language", key), lambda: shared.value)
        return pd.DataFrame([m.predict(t or "") for t in texts], columns=["lang_pred", "score"])

    rest = docs.drop("lang_pred", "score")
    (found,) = unused(rest, "found")
    # not deterministic for Spark: otherwise a filter on the result predicts once more
    return (rest.withColumn(found, predict.asNondeterministic()(F.col(text)))
            .withColumns({"lang_pred": F.col(found)["lang_pred"], "score": F.col(found)["score"]}).drop(found))
