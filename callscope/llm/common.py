"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.session import scratch_path
from callscope.sources.tables import read_table

__all__ = ["crc_mod4", "local_path", "materialize", "read_table", "scratch_path", "ship_package", "tokenizer_path", "unused",
           "worker_tool"]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; resolved again on each executor."""
    import public_tokenizers
    return public_tokenizers.path(name)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Have Python workers import this package: nothing to do where it is on
    their path already (PYTHONPATH, working folder), else it is sent along
    as a zip file (`addPyFile`)."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, app = os.path.dirname(package), spark.sparkContext.applicationId
    places = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if app in _SHIPPED or root in map(os.path.abspath, places):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="callscope-zip-"), "callscope.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def crc_mod4(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; 2 marks the held-out rows. Null stays null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back: later
    stages start from files that every executor can read, whoever is lost."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like `names` that `df` has no column of (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def local_path(uri: str) -> str | None:
    """The plain path of a `file:` uri or bare path, else None."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith(os.sep) else None


def arrow_map(fn: Callable[[Iterator], Iterator], setup: Callable[[], object] | None = None):
    """`mapInArrow` body: `fn(state, batch)` on every batch, where `state`
    is made once per task."""
    def run(batches):
        state = setup() if setup else None
        for batch in batches:
            if batch.num_rows:
                yield from fn(state, batch)
    return run


_TOOL: dict = {}


def worker_tool(key: tuple, make: Callable[[], object]):
    """This Python worker's tool (tokenizer, scorer ...) with its caches. It
    lives as long as the worker asks for the same one; a worker holds one
    tool at a time, so caches of different steps do not add up."""
    if _TOOL.get("key") != key:
        _TOOL.clear()
        _TOOL.update(key=key, tool=make())
    return _TOOL["tool"]


def range_cuts(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 ascending values that cut the integer column `key` into
    ranges of about equal size (approximate: only balance depends on them)."""
    if n < 2:
        return []
    cuts = df.stat.approxQuantile(key, [i / n for i in range(1, n)], 1 / (4 * n))
    return sorted({int(c) for c in cuts})


def merge_blobs(parts: DataFrame, merge: Callable[[list], bytes], groups: int = 16) -> list[bytes]:
    """Merge one-per-task summaries (columns g, blob; g < groups) in tasks by
    g, and return the at most `groups` merged ones for a last merge."""
    import pyarrow as pa
    schema = pa.schema([("blob", pa.binary())])

    def run(batches):
        blobs, kept = [], None
        for batch in batches:
            for blob in batch.column(1).to_pylist():
                blobs.append(blob)
                if len(blobs) >= 32:
                    kept = merge([kept, *blobs] if kept is not None else blobs)
                    blobs = []
        if blobs:
            kept = merge([kept, *blobs] if kept is not None else blobs)
        if kept is not None:
            yield pa.RecordBatch.from_pydict({"blob": [kept]}, schema=schema)

    merged = parts.repartition(groups, "g").mapInArrow(run, "blob binary")
    return [bytes(r["blob"]) for r in merged.collect()]
