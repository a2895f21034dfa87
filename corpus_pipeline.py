"""The corpus pipeline: from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage
before it kept, and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last return the columns of
`documents`.

Null text counts as empty text: it has no language, so it leaves at the
first stage. Empty tables pass through every stage. Columns beside those of
`documents` are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialize, read_table, ship_package
from callscope.llm.jaccard_join import keep_one
from callscope.llm.langid import UNDETERMINED, identify, train_model
from callscope.llm.packing import pack, token_pieces
from callscope.llm.pii import pseudonymise
from callscope.llm.queries import PII_KEY
from callscope.llm.toxicity import score, train_scorer

#: Least calibrated probability of the predicted language; least toxicity
#: score of a rejected document; shingle length and similarity of near copies.
LANGUAGE_SCORE = 0.3
TOXIC_SCORE = 0.3
SHINGLE_WORDS = 5
NEAR = 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language, or of none that was learned.
    A missing `lang` takes the prediction."""
    found = identify(docs, train_model(docs))
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents scored toxic."""
    scorer = train_scorer(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, scorer).filter(F.col("score") < TOXIC_SCORE).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return keep_one(docs, SHINGLE_WORDS, NEAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in place of personal data; n_chars follows the text."""
    out = pseudonymise(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    packed = pack(token_pieces(docs))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("best-fit packing", packing),
]

#: Trained models and tokenizers are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
