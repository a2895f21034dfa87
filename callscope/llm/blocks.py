"""Comparing the rows of groups without emitting pairs.

Rows of a group are dealt to blocks by a hash of their id, so that no block
outweighs `limit`; every pair of blocks of a group is one unit of work, so a
hot group is shared among tasks and a task holds two blocks at a time. A
unit returns a spanning forest of the links it found (at most one edge per
row), not the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialize


def group_blocks(rows: DataFrame, group: str, weight: Column, limit: int) -> DataFrame:
    """group, blocks of the groups heavier than `limit`: how many blocks they
    are dealt to. Written first, so that Spark knows the table's size when it
    chooses how to join it: broadcast where it is small, else by a shuffle."""
    sizes = rows.groupBy(group).agg(F.sum(weight).alias("blocks")).filter(F.col("blocks") > limit)
    return materialize(sizes.select(group, F.ceil(F.col("blocks") / F.lit(limit)).cast("int").alias("blocks")), "block-sizes")


def own_blocks(rows: DataFrame, sizes: DataFrame, group: str, row_id: str) -> DataFrame:
    """`rows` with block, bi and bj, all the block that a row is dealt to:
    every block is compared with itself only, and no row is copied."""
    dealt = rows.join(sizes, group, "left").withColumn("block", F.pmod(
        F.xxhash64(F.lit("block"), F.col(row_id)), F.coalesce("blocks", F.lit(1))).cast("int"))
    return dealt.select(*rows.columns, "block", F.col("block").alias("bi"), F.col("block").alias("bj"))


def deal_blocks(rows: DataFrame, group: str, row_id: str, weight: Column, limit: int) -> DataFrame:
    """`rows` with block, bi and bj (bi <= bj, block is one of them), a copy
    for each unit that a row takes part in.

    Only groups heavier than `limit` have more than one block. They are at
    most (whole weight / limit), so their sizes are broadcast and the rows,
    which may be wide, are not shuffled for this."""
    sizes = rows.groupBy(group).agg(F.sum(weight).alias("_w")).filter(F.col("_w") > limit)
    sizes = sizes.select(group, F.ceil(F.col("_w") / F.lit(limit)).cast("int").alias("_b"))
    dealt = rows.join(F.broadcast(sizes), group, "left").withColumn("_b", F.coalesce("_b", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), F.col(row_id)), F.col("_b")).cast("int"))
    units = F.transform(F.sequence(F.lit(0), F.col("_b") - 1), lambda x: F.struct(
        F.least(x, F.col("block")).alias("bi"), F.greatest(x, F.col("block")).alias("bj")))
    return dealt.withColumn("_u", F.explode(units)).select(*rows.columns, "block", "_u.bi", "_u.bj")


def units(dealt: DataFrame, group: str, row_id: str, body: Callable, schema: str, fields: pa.Schema) -> DataFrame:
    """Run `body(a, b)` on every unit, where a and b are Arrow tables of the
    rows of blocks bi and bj (b is None where they are the same block), and
    return the record batches it yields."""
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = dealt.columns
    g, bi, bj, bl = (names.index(x) for x in (group, "bi", "bj", "block"))

    def flush(held: list, unit: tuple) -> Iterator:
        if not held:
            return
        table = pa.Table.from_batches(held)
        if unit[1] == unit[2]:
            if table.num_rows > 1:
                yield from body(table, None)
            return
        own = table.column("block").to_numpy() == unit[1]
        a, b = table.filter(pa.array(own)), table.filter(pa.array(~own))
        if a.num_rows and b.num_rows:
            yield from body(a, b)

    def run(batches):
        held, unit = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.rec.fromarrays([batch.column(i).to_numpy(zero_copy_only=False) for i in (g, bi, bj)])
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                this = tuple(key[x].tolist())
                if this != unit:
                    yield from flush(held, unit)
                    held, unit = [], this
                held.append(batch.slice(x, y - x))
        yield from flush(held, unit)

    return (dealt.repartition(parts, group, "bi", "bj").sortWithinPartitions(group, "bi", "bj", "block", row_id)
            .mapInArrow(run, schema))


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, smallest id of its tree) that connect what the links
    a[i] - b[i] (positions in `ids`) connect: by label propagation."""
    if not len(a):
        return ids[:0], ids[:0]
    label = ids.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        # pointer jumping: the label of the row that bears the label's id
        order = np.argsort(ids, kind="stable")
        new = np.minimum(new, new[order[np.searchsorted(ids[order], new)]])
        if (new == label).all():
            break
        label = new
    moved = label != ids
    return ids[moved], label[moved]


def stars(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, hub of its tree) that connect what the links a[i] - b[i]
    connect; the hub is the row of most links (then the smallest id)."""
    x, y = forest(ids, a, b)
    order = np.argsort(ids, kind="stable")
    label = np.arange(len(ids))
    label[order[np.searchsorted(ids[order], x)]] = order[np.searchsorted(ids[order], y)]
    degree = np.bincount(np.r_[a, b], minlength=len(ids))
    rows = np.lexsort((ids, -degree, label))
    first = np.r_[True, label[rows][1:] != label[rows][:-1]][: len(rows)]
    hub = rows[first][np.cumsum(first) - 1]
    moved = hub != rows
    return ids[rows[moved]], ids[hub[moved]]
