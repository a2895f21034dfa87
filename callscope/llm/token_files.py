"""Token ids as flat binary files.

A data set is a folder of shards in ascending document order. Shard k has

* `shard-k.bin`: the ids of its documents one after another, as unsigned
  integers of 16 bits (vocabularies up to 65,536) or 32 bits, little-endian;
* `shard-k.off`: 64-bit offsets, one more than documents, counted in ids
  from the shard's begin;
* `shard-k.doc`: the 64-bit document ids.

`base` of a shard, the ids of all shards before it, is the prefix sum of the
shards' totals; the global position of a document is base + offset. Files
are written by the tasks through a file system that all executors share,
under a name of the attempt, and then renamed, so a repeated task replaces
its own file only. Local shards are read back memory-mapped.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import local_path
from callscope.llm.tokens import worker_encoder

END_ID = 2


def _fs(uri: str):
    from pyarrow import fs
    plain = local_path(uri)
    return (fs.LocalFileSystem(), plain) if plain else fs.FileSystem.from_uri(uri)


class _ShardWriter:
    """Streams one shard to its three files."""

    def __init__(self, folder: str, shard: int, end_id: int):
        self.fs, self.root = _fs(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.shard, self.mark = shard, uuid.uuid4().hex[:12]
        self.end = end_id
        self.docs = self.nulls = self.total = 0
        self.out = {x: self.fs.open_output_stream(self._name(x, self.mark)) for x in ("bin", "off", "doc")}
        self.out["off"].write(np.zeros(1, "<i8").tobytes())

    def _name(self, kind: str, mark: str = "") -> str:
        return f"{self.root}/shard-{self.shard:06d}.{kind}" + (f".{mark}" if mark else "")

    def add(self, doc_ids: list, packed: list[bytes], width: int) -> None:
        lengths = np.array([len(p) // width for p in packed], np.int64)
        self.out["bin"].write(b"".join(packed))
        self.out["off"].write((self.total + np.cumsum(lengths)).astype("<i8").tobytes())
        self.out["doc"].write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        self.docs += len(doc_ids)
        self.nulls += sum(d is None for d in doc_ids)
        self.total += int(lengths.sum())

    def close(self) -> dict:
        for kind, f in self.out.items():
            f.close()
            self.fs.move(self._name(kind, self.mark), self._name(kind))
        return {"shard": self.shard, "n_docs": self.docs, "n_null": self.nulls, "n_ids": self.total}


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID,
                      shards: int | None = None, doc_id: str = "doc_id", text: str = "text") -> list[dict]:
    """Encode every text, add `end_id`, and write the shards in ascending
    doc_id order under `folder` (shared by all executors); return the
    manifest, which is also written as `manifest.json`.

    Null text counts as empty (the end id alone). Null doc_ids come first;
    rows with the same doc_id are all written, ordered by a hash of their
    texts. An empty table gives no shard. Other columns are not read.

    One shuffle sorts the texts by range into `shards` tasks (by default
    `spark.sql.shuffle.partitions`); each writes its shard as a stream.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    from tokenizers import Tokenizer

    from callscope.llm.common import tokenizer_path
    vocab = Tokenizer.from_file(tokenizer if "/" in tokenizer else tokenizer_path(tokenizer)).get_vocab_size()
    width = 2 if max(vocab, end_id + 1) <= 1 << 16 else 4
    item = "H" if width == 2 else "I"
    schema = pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        enc, writer = worker_encoder(tokenizer, item), None
        end = array(item, [end_id]).tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or _ShardWriter(folder, TaskContext.get().partitionId(), end_id)
            ids = batch.column(0).to_pylist()
            writer.add(ids, [enc.encode(t or "") + end for t in batch.column(1).to_pylist()], width)
        if writer:
            yield pa.RecordBatch.from_pylist([writer.close()], schema=schema)

    tie = F.xxhash64(F.col("text"))
    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .repartitionByRange(shards, F.asc_nulls_first("doc_id"), tie)
            .sortWithinPartitions(F.asc_nulls_first("doc_id"), tie)
            .mapInArrow(run, "shard int, n_docs long, n_null long, n_ids long"))
    manifest = [r.asDict() for r in rows.collect()]  # one row per shard
    manifest.sort(key=lambda r: r["shard"])
    base = 0
    for r in manifest:
        r.update(base=base, width=width)
        base += r["n_ids"]
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def map_shard(folder: str, entry: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, doc ids) of a shard: memory-mapped on a local or
    mounted file system, else read."""
    fs, root = _fs(folder)
    name = f"{root}/shard-{entry['shard']:06d}"
    kinds = (("bin", f"<u{entry['width']}", entry["n_ids"]), ("off", "<i8", entry["n_docs"] + 1),
             ("doc", "<i8", entry["n_docs"]))
    out = []
    for kind, dtype, n in kinds:
        if local_path(folder):
            out.append(np.memmap(f"{name}.{kind}", dtype, "r", shape=(n,)) if n else np.empty(0, dtype))
        else:
            with fs.open_input_file(f"{name}.{kind}") as f:
                out.append(np.frombuffer(f.read(), dtype))
    return tuple(out)


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), from the files."""
    if manifest is None:
        fs, root = _fs(folder)
        with fs.open_input_file(f"{root}/manifest.json") as f:
            manifest = json.loads(f.read())
    names = ("shard", "n_docs", "n_null", "n_ids", "base", "width")
    todo = spark.createDataFrame([tuple(r[k] for k in names) for r in manifest],
                                 "shard int, n_docs long, n_null long, n_ids long, base long, width int")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])
    step = 20_000

    def run(batches):
        for batch in batches:
            for entry in batch.to_pylist():
                ids, off, doc = map_shard(folder, entry)
                for a in range(0, entry["n_docs"], step):
                    b = min(a + step, entry["n_docs"])
                    cut = np.array(off[a: b + 1])
                    part = np.array(ids[cut[0]: cut[-1]], "<u4")
                    crc = [zlib.crc32(part[x - cut[0]: y - cut[0]]) for x, y in zip(cut[:-1], cut[1:])]
                    null = np.arange(a, b) < entry["n_null"]  # nulls come first
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.array(doc[a:b]), pa.int64(), mask=null),
                        pa.array(entry["base"] + cut[:-1], pa.int64()), pa.array(np.diff(cut), pa.int64()),
                        pa.array(crc, pa.int64())], schema=schema)

    n = max(1, len(manifest))
    return todo.repartition(n, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
