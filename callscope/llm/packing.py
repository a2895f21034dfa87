"""Best-fit packing of documents into sequences by the sum-of-squares rule.

A sequence is a bin of `capacity` tokens. With N(g) open bins that have g
tokens left, a piece goes where the sum of N(g)^2 over all gaps becomes
smallest (a full bin is no longer open; a new bin is one more choice).

At scale: pieces are dealt to groups of about `group_pieces` pieces, each
packed by one task, longest piece first. Whatever bins can still take another
are packed again, as whole blocks, in rounds of at most half as many groups,
until one group is left or large groups have next to nothing to merge. The
rule is a heuristic: neither it nor the rounds promise the fewest sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialize
from callscope.llm.tokens import worker_encoder

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 16_384
#: Groups of so many blocks show what there is to merge.
TELLING_BLOCKS = 4_096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot long"


def sum_of_squares_pack(lengths, capacity: int = CAPACITY) -> np.ndarray:
    """Bin number of every length (0 < length <= capacity), in the order
    given. Ties between equal sums go to the smallest gap left over, and to
    an open bin before a new one."""
    open_bins = np.zeros(capacity + 1, np.int64)  # N(g); N(0) and N(capacity) stay 0
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths):
        s = int(s)
        # gap before, from s up; the sum changes by 2 (N(g - s) - N(g)) + 2, less 1
        # where the bin gets full
        delta = 2 * (open_bins[: capacity - s + 1] - open_bins[s:]) + 2
        delta[0] = 1 - 2 * open_bins[s]
        delta[open_bins[s:] == 0] = np.iinfo(np.int64).max
        new = 2 * open_bins[capacity - s] + 1 if s < capacity else 0
        left = int(delta.argmin())
        if delta[left] <= new:
            b = stacks[left + s].pop()
            open_bins[left + s] -= 1
        else:
            b, left = made, capacity - s
            made += 1
        out[i] = b
        if left:
            stacks[left].append(b)
            open_bins[left] += 1
    return out


def token_pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY,
                 end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids, then `end_id`, whole if they
    fit `capacity`, else cut into pieces of `capacity` ids of which the
    first one takes the remainder. Null text counts as empty (one piece that
    holds the end id). `with_ids` adds the ids as array<int>."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("slot", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = worker_encoder(tokenizer, "I")
        slot = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = {name: [] for name, _ in fields}
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = enc.encode(t or "") + end
                n = len(packed) // 4
                first = (n - 1) % capacity + 1
                for piece, stop in enumerate(range(first, n + 1, capacity)):
                    start = 0 if piece == 0 else stop - capacity
                    ids = packed[4 * start: 4 * stop]
                    rows["doc_id"].append(d)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(stop - start)
                    rows["ids_crc32"].append(zlib.crc32(ids))
                    rows["slot"].append(slot)
                    slot += 1
                    if with_ids:
                        rows["ids"].append(np.frombuffer(ids, "<u4").astype(np.int32))
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    cols = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cols.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def _pack_group(capacity: int):
    """Pack the blocks of one group: each row is a block with `fill` tokens."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["fill", "block"], ascending=[False, True], kind="stable")
        bins = sum_of_squares_pack(pdf["fill"].to_numpy(), capacity)
        order = np.argsort(bins, kind="stable")
        bins, fills = bins[order], pdf["fill"].to_numpy()[order]
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        before = np.cumsum(fills) - fills
        offset = before - np.repeat(before[first], np.diff(np.r_[first, len(bins)]))
        blocks = pdf["block"].to_numpy()[order]
        # a bin is named after its first block: block numbers are unique
        home = np.repeat(blocks[first], np.diff(np.r_[first, len(bins)]))
        total = np.repeat(np.add.reduceat(fills, first), np.diff(np.r_[first, len(bins)]))
        return pd.DataFrame({"block": blocks, "home": home, "at": offset, "total": total})
    return run


def _pack_round(blocks: DataFrame, n_groups: int, capacity: int) -> DataFrame:
    """block -> home (the bin it goes to), at (its offset there), total."""
    grouped = blocks.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(n_groups)))
    return (grouped.groupBy("g").applyInPandas(
        lambda pdf: _pack_group(capacity)(pdf), "block long, home long, at long, total long"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         rounds: int | None = None) -> DataFrame:
    """Add sequence_id and offset to `pieces` (columns length, 0 < length <=
    capacity, and slot, unique per row), dealing the rows to sequences of at
    most `capacity` tokens with gapless offsets from 0. Full pieces are
    sequences of their own and are not shuffled for packing. Rows that are
    equal but for `slot` are packed one by one. No rows give no rows.

    Sequences with room for the smallest one are packed again as whole
    blocks, in ever fewer groups, until all are in one group, or (where groups
    are large) a round merges less than a hundredth of them; at most `rounds`
    times, if given.
    """
    pieces = materialize(pieces, "pieces")
    full = F.col("length") >= capacity
    n = pieces.filter(~full).count()
    blocks = pieces.filter(~full).select(F.col("slot").alias("block"), F.col("length").alias("fill"))
    groups = max(1, n // group_pieces)
    placed = materialize(_pack_round(blocks, groups, capacity), "placed")
    done = False
    while n and not done and rounds != 0:
        # a bin without room for the smallest one is part of no merge
        smallest = placed.agg(F.min("total")).first()[0]
        spare = placed.filter(F.col("total") <= capacity - smallest).select(
            F.col("home").alias("block"), F.col("total").alias("fill")).distinct()
        left = spare.count()
        if left < 2:
            break
        groups = max(1, min(left // group_pieces, groups // 2))
        again = materialize(_pack_round(spare, groups, capacity).select(
            F.col("block").alias("home"), F.col("home").alias("new_home"), F.col("at").alias("shift"),
            F.col("total").alias("new_total")), "placed-again")
        merged = left - again.select("new_home").distinct().count()
        done = groups == 1 or merged * 100 < left and left // groups >= TELLING_BLOCKS
        rounds = None if rounds is None else rounds - 1
        if not merged:
            continue
        placed = materialize(placed.join(again, "home", "left").select(
            "block", F.coalesce("new_home", "home").alias("home"),
            (F.col("at") + F.coalesce("shift", F.lit(0))).alias("at"),
            F.coalesce("new_total", "total").alias("total")), "placed")
    own = pieces.filter(full).withColumns({"sequence_id": F.col("slot"), "offset": F.lit(0).cast("long")})
    rest = (pieces.filter(~full).join(placed.select(F.col("block").alias("slot"), F.col("home").alias("sequence_id"),
                                                    F.col("at").alias("offset")), "slot"))
    return own.select(*pieces.columns, "sequence_id", "offset").unionByName(rest).drop("slot")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, lengths: the packed sequences themselves,
    from pieces made `with_ids` (a sequence holds at most `capacity` ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.transform("p", lambda x: x["length"]).alias("lengths"))
