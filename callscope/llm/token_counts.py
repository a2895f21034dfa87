"""Token counts of whole texts by a map-side two-tier lookup.

Tier one is a broadcast table of the lengths (numbers of ids) of frequent
units; tier two is a bounded cache of every Python worker, filled by the
tokenizer itself. No unit is shuffled: the table comes from heavy-hitter
summaries of bounded size, one per task over its whole split, which are
merged in two levels.
"""

from __future__ import annotations

import os
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import tokenizer_path, worker_tool
from callscope.llm.tokens import UnitEncoder, UnitLengths

#: Entries of the broadcast table, of a task's running summary, and of what a
#: task sends on. All three bound memory, none bounds the input.
TABLE_ENTRIES = 32_768
SUMMARY_ENTRIES = 200_000
SENT_ENTRIES = 16_384


def _prune(counts: Counter, keep: int) -> Counter:
    """Misra-Gries step: drop to `keep` counters, less the largest dropped count."""
    if len(counts) <= keep:
        return counts
    top = counts.most_common(keep + 1)
    cut = top[-1][1]
    return Counter({u: c - cut for u, c in top[:-1] if c > cut})


def _pack(counts: Counter) -> bytes:
    return "\x00".join(f"{c}\x01{u}" for u, c in counts.items()).encode("utf-8", "surrogatepass")


def _unpack(blob: bytes) -> Counter:
    if not blob:
        return Counter()
    return Counter({u: int(c) for c, u in (x.split("\x01", 1) for x in blob.decode("utf-8", "surrogatepass").split("\x00"))})


def _resolve(name: str) -> str:
    return name if os.sep in name else tokenizer_path(name)


def frequent_units(docs: DataFrame, tokenizer: str, text: str = "text") -> dict[str, int]:
    """Lengths of the heavy-hitter units of all texts (at most
    `TABLE_ENTRIES`). A unit's summary count may be too low by the
    Misra-Gries error, so the table may miss a unit; counts of tokens never
    depend on which units it holds."""
    groups = 16

    def summarise(batches):
        enc, counts = UnitEncoder(_resolve(tokenizer)), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    # units that hold the pack's own separators stay out of the table
                    counts.update(enc.units(t)[1])
                    if len(counts) > 2 * SUMMARY_ENTRIES:
                        counts = _prune(counts, SUMMARY_ENTRIES)
        counts = Counter({u: c for u, c in counts.items() if "\x00" not in u and "\x01" not in u})
        yield pa.RecordBatch.from_pydict({"g": [TaskContext.get().partitionId() % groups],
                                          "blob": [_pack(_prune(counts, SENT_ENTRIES))]},
                                         schema=pa.schema([("g", pa.int32()), ("blob", pa.binary())]))

    def merge(level_key: str):
        def run(batches):
            counts: Counter = Counter()
            seen = False
            for batch in batches:
                for blob in batch.column(1).to_pylist():
                    seen = True
                    counts.update(_unpack(blob))
                    counts = _prune(counts, 4 * SENT_ENTRIES) if len(counts) > 8 * SENT_ENTRIES else counts
            if seen:
                yield pa.RecordBatch.from_pydict({"g": [0], "blob": [_pack(_prune(counts, TABLE_ENTRIES))]},
                                                 schema=pa.schema([("g", pa.int32()), ("blob", pa.binary())]))
        return run

    parts = docs.select(text).mapInArrow(summarise, "g int, blob binary")
    level1 = parts.repartition(groups, "g").mapInArrow(merge("g"), "g int, blob binary")
    blobs = [r["blob"] for r in level1.collect()]  # at most `groups` summaries of bounded size
    total: Counter = Counter()
    for b in blobs:
        total.update(_unpack(bytes(b)))
    lengths = UnitLengths(_resolve(tokenizer))
    led = " " if lengths.enc.kind == "space_led" else ""
    return {u: len(lengths.enc.ids(led + u)) for u, _ in total.most_common(TABLE_ENTRIES)}


def worker_lengths(tokenizer: str, table: dict[str, int]) -> UnitLengths:
    """This Python worker's lengths, both tiers."""
    return worker_tool(("lengths", tokenizer), lambda: UnitLengths(_resolve(tokenizer), table))


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), one
    row for each input row.

    Null text counts as empty (0 bytes, 0 tokens, not over the limit); a
    null or repeated doc_id stays as it is, row by row; other columns are
    not read; an empty table gives no rows. `tokenizer` is a public file
    name, or a path: `.json` for the tokenizers library, `.model` for
    sentencepiece.
    """
    spark = docs.sparkSession
    cols = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])
    if tokenizer.endswith(".model"):
        table = None
    else:
        table = spark.sparkContext.broadcast(frequent_units(cols, tokenizer))

    def run(batches):
        if table is None:
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=_resolve(tokenizer))

            def count(t):
                return len(sp.encode(t))
        else:
            count = worker_lengths(tokenizer, table.value).count
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()),
                pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], schema=schema)

    return cols.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
