"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.alignment import alignment
from callscope.llm.common import crc_mod4, read_table, scratch_path, ship_package
from callscope.llm.embed_dedup import near_duplicates
from callscope.llm.exact_dedup import exact_duplicates
from callscope.llm.fingerprints import fingerprints
from callscope.llm.jaccard_join import jaccard_components
from callscope.llm.langid import identify, train_model
from callscope.llm.packing import pack, token_pieces
from callscope.llm.pii import pseudonymise
from callscope.llm.spm import encoding_digest
from callscope.llm.token_counts import token_counts
from callscope.llm.token_files import read_token_files, write_token_files
from callscope.llm.toxicity import score, train_scorer
from callscope.llm.variants import spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: The key of the registered queries' pseudonyms; a deployment passes its own.
PII_KEY = "callscope-query-key"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


#: Components of `links` (a, b; both ways) over `nodes` (id): what each reaches.
_REACH = """reach(id, other) AS (
  SELECT id, id FROM nodes
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a)"""

OP6_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND len(p.e) = len(q.e) AND p.vec_id <> q.vec_id
  WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
{_REACH},
home AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, h.component_id,
       e.vec_id = h.component_id AS kept
FROM embeddings e JOIN home h ON e.vec_id = h.id"""

OP10_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(list_transform(generate_series(1, greatest(len(words) - 3, least(len(words), 1))),
                                              lambda i: array_to_string(words[i:i + 3], ' '))) AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
t AS (SELECT doc_id, unnest(sh) AS x FROM s),
nodes AS (SELECT doc_id AS id FROM documents),
shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM t p JOIN t q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL),
once AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 85 * (na.n + nb.n - k)),
links AS (SELECT a, b FROM once UNION ALL SELECT b, a FROM once),
{_REACH},
home AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, h.component_id FROM n JOIN home h ON n.doc_id = h.id"""

OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@register("op1_best_fit_packing")
def op1(spark, sf_dir):
    """Every document in sequences of at most 2048 tokens."""
    packed = pack(token_pieces(documents(spark, sf_dir)))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op2_token_counts")
def op2(spark, sf_dir):
    """Bytes and tokens of every document."""
    return token_counts(documents(spark, sf_dir))


@register("op7_token_files")
def op7(spark, sf_dir):
    """Write all documents' ids as flat files, then read them back."""
    folder = scratch_path(spark, "llm", "token-files")
    return read_token_files(spark, folder, write_token_files(documents(spark, sf_dir), folder))


@register("op4_fingerprints")
def op4(spark, sf_dir):
    """Fingerprints of every document and of its edited text."""
    return fingerprints(documents(spark, sf_dir))


@register("op9_language_id")
def op9(spark, sf_dir):
    """Language of every document."""
    docs = documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), train_model(docs))
    return found.select("doc_id", F.coalesce(crc_mod4(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


@register("op3_pii_pseudonyms")
def op3(spark, sf_dir):
    """Every document with its personal data pseudonymised."""
    out = pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("pii_values").alias("n_values"),
                      F.array_sort(F.array_distinct(F.transform("pii_values", lambda v: v["kind"]))).alias("kinds"))


@register("op10_ngram_jaccard_join", OP10_SQL)
def op10(spark, sf_dir):
    """Components of documents whose sets of four-word shingles are 85 % alike."""
    return jaccard_components(documents(spark, sf_dir), 4, 0.85)


@register("op6_embedding_near_dedup", OP6_SQL)
def op6(spark, sf_dir):
    """Links and components of vectors of cosine 0.98 or more within a label."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"), 0.98)


@register("op8_sentencepiece")
def op8(spark, sf_dir):
    """Every document encoded to pieces and decoded again."""
    return encoding_digest(documents(spark, sf_dir))


@register("op5_toxicity")
def op5(spark, sf_dir):
    """Toxicity score of every document."""
    docs = documents(spark, sf_dir)
    scorer = train_scorer(docs, read_table(spark, sf_dir, "labels"))
    out = score(docs.select("doc_id", "text"), scorer)
    return out.select("doc_id", F.coalesce(crc_mod4(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op11_tokenizer_alignment")
def op11(spark, sf_dir):
    """Tokens of two tokenizers aligned over every document."""
    return alignment(documents(spark, sf_dir))


@register("op12_exact_dedup", OP12_SQL)
def op12(spark, sf_dir):
    """The winner of every document's group of equal texts."""
    return exact_duplicates(documents(spark, sf_dir))


@register("op13_spelling_variants")
def op13(spark, sf_dir):
    """Near words, forms and roots of the words of all documents."""
    return spelling_variants(documents(spark, sf_dir))
