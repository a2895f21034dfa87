"""Exact deduplication in three combining steps, built-in functions only.

Equal texts are found by digest and told apart by their whole content at every
step, so a clash of digests joins nothing:

1. every task reduces its own rows to one per text (map-side aggregation by
   digest, salt and text);
2. rows of one digest and salt are merged;
3. the winners of the salts are merged per digest.

Only a digest that holds more than a share of 1 / `HOT_SHARE` of all rows is
salted, by the task that read the row: there are fewer than `HOT_SHARE` of
them, so their list and their winners are sent to all tasks, and their rows
are never shuffled to learn their winner. All other texts are shuffled once.

Rows learn their winner by digest. Where a digest has several texts, its rows
are grouped and joined by the texts themselves instead.

Null text counts as empty. A null id is smaller than any other; a group of
null ids alone has a null `keep_id`. Rows that are wholly the same tie: all
rows with the largest id of their group are marked kept. Columns beside id and
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialize

#: A digest with more than one in so many rows is salted, and its salts.
HOT_SHARE = 2_048
SALTS = 32


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _winners(keyed: DataFrame, *keys: str) -> DataFrame:
    return keyed.groupBy(*keys).agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: id, digest, keep_id (largest id of the rows with
    the same text) and group_size (their number). Any `digest` gives the same
    groups, a weak one just more work."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", digest(F.col("text")))
    members = materialize(keyed.select("id", "digest"), "exact-members")
    counts = members.groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
    hot = materialize(counts.filter(F.col("rows") > F.lit(members.count() / HOT_SHARE)).select("digest"), "exact-hot")

    # steps 1 and 2, then step 3 for what was salted
    salt = F.when(F.col("hot"), F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    flagged = keyed.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left").withColumn("salt", salt)
    merged = _winners(flagged, "digest", "salt", "text")
    # from here on only salted rows need their text
    parts = materialize(merged.withColumn("text", F.when(F.col("salt").isNotNull(), F.col("text"))), "exact-winners")
    salted = parts.filter(F.col("salt").isNotNull()).groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    plain = parts.filter(F.col("salt").isNull())

    # digests of several texts: by the texts themselves
    several = plain.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").unionByName(
        salted.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"))
    clash = materialize(several.select("digest"), "exact-clash")
    clashing = keyed.join(clash, "digest", "left_semi")
    by_text = clashing.join(_winners(clashing, "digest", "text"), ["digest", "text"])

    alone = members.join(clash, "digest", "left_anti")
    # one winner per salted digest of one text: fewer than HOT_SHARE
    of_hot = F.broadcast(salted.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
        .filter("texts = 1"))
    hot_rows = alone.join(of_hot, "digest")
    cold_rows = alone.join(F.broadcast(hot), "digest", "left_anti").join(
        plain.select("digest", "keep_id", "group_size"), "digest")
    columns = ("id", "digest", "keep_id", "group_size")
    return hot_rows.select(*columns).unionByName(cold_rows.select(*columns)).unionByName(by_text.select(*columns))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    found = exact_groups(docs)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, whole and with all their columns."""
    found = exact_groups(docs)
    stay = found.filter(F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "digest").distinct()
    own = sha256(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["id"]) & (own == stay["digest"]), "left_semi")
