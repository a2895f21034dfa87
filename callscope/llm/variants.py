"""Spelling variants: words that differ by one edit, and the form each stands for.

Two words are near if one inserted, deleted or replaced code point turns one
into the other: their common prefix and common suffix together reach the
longer length minus one. Common prefixes and suffixes of many words are found
at once: words of a tile are rows of a padded code-point matrix, and two
matrices are compared column by column.

Which tiles are compared: of two near words with longer length L, a common
prefix of k = (L - 1) // 2 code points is there or a common suffix of L - k.
So a word goes, for its own
length and for one more, to the words with the same prefix and to those with
the same suffix (hashed: a clash only costs a comparison).
A group of many words is cut into blocks, and every pair of blocks is one unit
of work; small groups share a tile, in which only words of one group count. A
pair found by prefix and by suffix counts for the prefix.

A tile returns per word the number of its near words and the one of largest n
(ties: smallest in code-point order), never pairs.

Null text has no words; a null id is read as empty text in the rule that
deletes a letter; repeated rows count each; only id and text are read; an empty
table gives an empty result. A word may be of any length: blocks are cut by
code points, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialize

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_COUNT, DELETE_EVERY, RATIO = 7, 2, 31, 10
#: Weight of a block (a word weighs one, a long one more), and words of a tile
#: of small groups.
BLOCK = 1_024
TILE = 192
#: Rounds of pointer doubling: n grows tenfold with every form, so a way of
#: forms has fewer than 19 steps.
ROUNDS = 5


def _damaged(doc_id: Column, word: Column, every: int) -> Column:
    """The word without one code point where `every` divides the crc32 of `doc_id:word`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut).otherwise(word)


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                delete_every: int = DELETE_EVERY) -> DataFrame:
    """word, n: lower-cased runs of letters over all documents, counted in the
    map tasks before the shuffle. Shorter runs cannot give a word."""
    runs = docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all(
        F.col("text").cast("string"), F.lit(f"{RUN}{{{min_chars},}}"), F.lit(0))).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    words = runs.select("doc_id", low.alias("run")).select(_damaged(F.col("doc_id"), F.col("run"), delete_every).alias("word"))
    counted = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _grouped(words: DataFrame) -> DataFrame:
    """word, n, size (longer length L), side (0 prefix, 1 suffix), key: the
    four groups of every word."""
    length = F.length("word")
    at = F.inline(F.array(*(F.struct((length + more).alias("size"), F.lit(side).alias("side"))
                            for more in (0, 1) for side in (0, 1))))
    k = F.expr("(size - 1) div 2").cast("int")
    part = F.when(F.col("side") == 0, F.substring("word", F.lit(1), k)).otherwise(
        F.substring("word", length - (F.col("size") - k) + 1, F.col("size")))
    return words.select("word", "n", at).withColumn("key", F.xxhash64("size", "side", part))


def _units(words: DataFrame) -> DataFrame:
    """Grouped words with block, bi and bj: a copy for every pair of blocks
    that a word's block takes part in. The sizes of the groups with several
    blocks are a small written table, broadcast or shuffled as Spark sees fit."""
    weight = F.expr("1 + char_length(word) div 64")
    grouped = _grouped(words)
    sizes = materialize(grouped.groupBy("size", "side", "key").agg(F.sum(weight).alias("weight"))
                        .filter(F.col("weight") > BLOCK)
                        .select("size", "side", "key", F.ceil(F.col("weight") / BLOCK).cast("int").alias("blocks")), "variant-blocks")
    dealt = grouped.join(sizes, ["size", "side", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "word"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(x, F.col("block")).alias("bi"), F.greatest(x, F.col("block")).alias("bj")))
    return dealt.select("size", "side", "key", "block", "word", "n", F.inline(pairs))


def code_points(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of code points, padded with 0 at the end and at the front."""
    rows = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    at = np.arange(width) - (width - lengths)[:, None]
    back = np.where(at >= 0, np.take_along_axis(rows, np.maximum(at, 0), 1), 0)
    kind = np.uint8 if rows.max(initial=0) < 256 else np.uint32
    return rows.astype(kind), back.astype(kind)


def common(a: np.ndarray, b: np.ndarray, columns) -> np.ndarray:
    """How many of `columns` agree, one after the other, for every row of a
    against every row of b."""
    kind = np.int16 if a.shape[1] < 1 << 15 else np.int32
    same = np.ones((len(a), len(b)), bool)
    out = np.zeros(same.shape, kind)
    for c in columns:
        same &= a[:, c, None] == b[None, :, c]
        if not same.any():
            break
        out += same
    return out


def near_in_tile(size: int, by_suffix: bool, a: list[str], b: list[str], same_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of near words of longer length `size` among
    `same_group`; with `by_suffix`, only those that no prefix group holds."""
    front_a, back_a = code_points(a, size)
    front_b, back_b = code_points(b, size)
    long_a, long_b = (np.fromiter((len(w) == size for w in x), bool, len(x)) for x in (a, b))
    prefix = common(front_a, front_b, range(size))
    fit = same_group & (long_a[:, None] | long_b[None, :]) & (prefix < size)
    if by_suffix:
        fit &= prefix < (size - 1) // 2
    fit &= prefix + common(back_a, back_b, range(size - 1, -1, -1)) >= size - 1
    return np.nonzero(fit)


FOUND = "word string, n_near long, form_n long, form string"


def _compare(table: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Near words among the rows of a tile: of one group, or of two blocks."""
    size, by_suffix = table.column("size")[0].as_py(), table.column("side")[0].as_py() == 1
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    block, bi, bj = (table.column(c).to_numpy() for c in ("block", "bi", "bj"))
    if bi[0] == bj[0]:
        group = table.column("key").to_numpy()
        fit = group[:, None] == group[None, :]
        np.fill_diagonal(fit, False)
        i, j = near_in_tile(size, by_suffix, words, words, fit)
    else:
        one, two = np.flatnonzero(block == bi[0]), np.flatnonzero(block == bj[0])
        if not len(one) or not len(two):
            return
        i, j = near_in_tile(size, by_suffix, [words[x] for x in one], [words[x] for x in two], np.ones((len(one), len(two)), bool))
        i, j = np.concatenate([one[i], two[j]]), np.concatenate([two[j], one[i]])
    if not len(i):
        return
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
    order = np.lexsort((rank[j], -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[x] for x in i[first]]), pa.array(np.diff(np.r_[first, len(i)])), pa.array(n[j[first]]),
         pa.array([words[x] for x in j[first]])], schema=schema)


def _tiles(batches) -> Iterator[pa.Table]:
    """The rows of a task as tiles: whole small groups of one length and side
    until TILE words (fewer long ones) are reached, or one unit of two blocks. Rows come sorted
    by size, side, blocks and group."""
    held, key = [], None
    rows = 0
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("size", "side", "bi", "bj", "key")]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if start == stop:
                continue
            now = tuple(int(c[start]) for c in columns)
            alike = key is not None and now[:2] == key[:2] and now[2:4] == (0, 0) == key[2:4]
            if key is not None and now != key and not (alike and rows < TILE):
                yield pa.Table.from_batches(held)
                held, rows = [], 0
            held.append(batch.slice(start, stop - start))
            rows += (stop - start) * (1 + now[0] // 64)
            key = now
    if held:
        yield pa.Table.from_batches(held)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form (the near word of largest n, ties: the smallest) and
    form_n for every word that has a near word; `words` holds word, n."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])

    def run(batches):
        for table in _tiles(b for b in batches if b.num_rows):
            if table.num_rows > 1:
                yield from _compare(table, schema)

    dealt = _units(words)
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("size", "side", "bi", "bj", "key")
    found = dealt.repartition(parts, *order).sortWithinPartitions(*order).mapInArrow(run, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("down"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.down")).alias("form_n"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `words` (word, n):
    its form is its near word of largest n where that is at least `ratio`
    times its own; its root is where the way of forms ends."""
    near = words.join(near_words(words), "word", "left")
    holds = F.col("form_n") >= ratio * F.col("n")
    out = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(holds, F.col("form")).alias("form"),
                                  F.when(holds, F.col("form_n")).alias("form_n")), "variants")
    way = out.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(ROUNDS):
        step = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        way = materialize(way.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variant-roots")
    return out.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants of the words of all documents."""
    return variants(materialize(count_words(docs), "variant-words"))
