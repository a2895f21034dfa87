"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; a chunk ends where its top bits are
zero. Chunking is normalised: up to `NORMAL` bytes a cut needs `STRICT` zero
bits, beyond it only `LOOSE`, never under `MIN` nor over `MAX` bytes. A cut
depends on the last 16 bytes alone, so an insertion moves the chunks around
it and no others. A fingerprint is the set of chunk digests with the chunks'
lengths; containment of a in b is the share of a's bytes, by distinct chunk,
whose chunks b has too.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.llm.common import range_cuts

MIN, NORMAL, MAX = 16, 48, 192
STRICT, LOOSE = 7, 3
SEED = 20240501
GEAR = np.random.default_rng(SEED).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hash(data: bytes) -> np.ndarray:
    """The 16-bit gear hash after every byte: sum of GEAR[byte] << age, by
    doubling the window four times."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for age in (1, 2, 4, 8):
        g = h.copy()
        g[age:] += h[:-age] << np.uint16(age)
        h = g
    return h


def chunk_ends(data: bytes, start: int = 0) -> list[int]:
    """Ends of the chunks of `data` after `start`, where `start` is 0 or an
    end of a chunk of a text with the same beginning."""
    n = len(data)
    low = max(0, start - 16)  # the hash looks back no further
    h = gear_hash(data[low:])
    at = np.flatnonzero(h < (1 << (16 - LOOSE)))
    strict = (h[at] < (1 << (16 - STRICT))).tolist()
    ends, begin = [], start
    for end, hard in zip((at + (low + 1)).tolist(), strict):
        size = end - begin
        while size > MAX:
            begin += MAX
            ends.append(begin)
            size = end - begin
        if size >= MIN and (hard or size > NORMAL):
            ends.append(end)
            begin = end
    while n - begin > MAX:
        begin += MAX
        ends.append(begin)
    if begin < n:
        ends.append(n)
    return ends


def _chunks(data: bytes, ends: list[int], start: int = 0) -> set[int]:
    """48 bits of the digest, then 8 bits of length less one, per distinct chunk."""
    digest, out = xxhash.xxh3_64_intdigest, set()
    for end in ends:
        out.add((digest(data[start:end]) >> 16 << 8) | (end - start - 1))
        start = end
    return out


def fingerprint_set(text: str) -> set[int]:
    data = text.encode("utf-8")
    return _chunks(data, chunk_ends(data))


def to_text(chunks: set[int]) -> str:
    """A fingerprint as text: base64 of its sorted seven-byte entries."""
    return base64.b64encode(b"".join(v.to_bytes(7, "big") for v in sorted(chunks))).decode()


def from_text(fingerprint: str) -> set[int]:
    raw = base64.b64decode(fingerprint)
    return {int.from_bytes(raw[i: i + 7], "big") for i in range(0, len(raw), 7)}


def weight(chunks) -> int:
    return sum((v & 255) + 1 for v in chunks)


def containment(a: set[int], b: set[int]) -> float:
    """Share of a's bytes (distinct chunks) that b has; an empty fingerprint
    is contained in an empty one only."""
    if not a:
        return 1.0 if not b else 0.0
    return weight(a & b) / weight(a)


class _Doc:
    __slots__ = ("doc_id", "text", "data", "ends", "chunks")

    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text
        self.data = text.encode("utf-8")
        self.ends = chunk_ends(self.data)
        self.chunks = _chunks(self.data, self.ends)

    def edited(self, after: str) -> tuple[bytes, set[int]]:
        """The edited text's bytes and fingerprint; chunks of the kept part
        are the same up to its last cut."""
        n = len(self.text)
        kept = self.text[: n - n // 3].encode("utf-8")
        data = kept + after[: n // 3].encode("utf-8")
        same, stop = [], len(kept)
        for e in self.ends:
            if e > stop or e == len(self.data):
                break
            same.append(e)
        start = same[-1] if same else 0
        return data, _chunks(data, same + chunk_ends(data, start))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(doc: _Doc, after: _Doc) -> tuple:
    data, chunks = doc.edited(after.text)
    return (doc.doc_id, len(doc.text), hashlib.sha256(data).hexdigest(), to_text(doc.chunks), to_text(chunks),
            containment(doc.chunks, chunks), containment(doc.chunks, after.chunks))


def _stream(batches):
    """Rows come by bucket in order of documents, each bucket's guest (the
    document after its last one) at its end."""
    pending, bucket = None, None
    for batch in batches:
        rows = []
        for b, guest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if b != bucket:
                pending, bucket = None, b
            elif pending is None:
                continue  # a repeated guest
            doc = _Doc(doc_id, text)
            if pending is not None:
                rows.append(_compare(pending, doc))
            pending = None if guest else doc
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 buckets: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_chars, the fingerprint of its text
    and of its edited text (last third replaced by the begin of the next
    document in descending doc_id; after the last comes the first), sha256
    of the edited text, and the containment of its fingerprint in those of
    the edited text and of the next document.

    Null text counts as empty; an empty text has an empty fingerprint. Null
    doc_ids come last; rows of equal doc_id follow each other by a hash of
    their texts. A table of one row is its own next document. Other columns
    are not read; an empty table gives no rows.

    The texts are shuffled once, to buckets of neighbouring ids; the first
    document of a bucket is copied to the bucket before it.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = buckets or 8 * parts
    cols = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = np.array(range_cuts(cols, "doc_id", n), np.int64)

    @F.pandas_udf(T.IntegerType())
    def bucket_of(ids, missing, ties):
        # descending: bucket 0 has the largest ids; null ids follow, dealt by hash
        at = len(cuts) - np.searchsorted(cuts, ids.to_numpy(np.int64), "right")
        by_hash = len(cuts) + 1 + (ties.to_numpy(np.int64) // (1 << 32) + (1 << 31)) * n // (1 << 32)
        return type(ids)(np.where(missing.to_numpy(bool), by_hash, at).astype(np.int32))

    some_null = cols.filter(F.col("doc_id").isNull()).limit(1).count() > 0
    tie = F.xxhash64("text") if some_null else F.lit(0).cast("long")
    keyed = cols.withColumn("tie", tie).withColumn("b", bucket_of(F.coalesce("doc_id", F.lit(0).cast("long")), F.isnull("doc_id"), "tie"))
    heads = sorted(keyed.groupBy("b").agg(F.max("doc_id").alias("id"),
                                          F.min(F.when(F.col("doc_id").isNull(), F.col("tie"))).alias("tie")).collect())
    if not heads:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    # bucket -> the bucket before it (before the first: the last); at most n rows
    before = [(h["b"], heads[i - 1]["b"], h["id"], h["tie"]) for i, h in enumerate(heads)]
    head = F.broadcast(spark.createDataFrame(before, "b int, host int, head_id long, head_tie long"))
    is_head = F.when(F.col("doc_id").isNull(), F.col("tie") == F.col("head_tie")).otherwise(
        F.col("doc_id") == F.col("head_id"))
    own = F.struct(F.col("b"), F.lit(0).alias("guest"))
    copies = F.when(is_head, F.array(own, F.struct(F.col("host").alias("b"), F.lit(1).alias("guest")))).otherwise(
        F.array(own))
    rows = (keyed.join(head, "b").select("doc_id", "text", F.explode(copies).alias("c"))
            .select(F.col("c.b").alias("bucket"), F.col("c.guest").alias("guest"), "doc_id", "text")
            .repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("text")))
    return rows.mapInArrow(_stream, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
