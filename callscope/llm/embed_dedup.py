"""Near-duplicate vectors by counting collisions of one-dimensional
projections.

Vectors are compared within a label. Two unit vectors of cosine c or more
are at most r = sqrt(2 - 2c) apart, so their projections on a random
direction differ by about r / sqrt(dim) in the mean square. For every query
a window of `Z` such deviations around its own projection is read on each of
`PROJECTIONS` directions; a pair that meets in at least `needed` windows is
verified in double precision. `needed` is the largest count that a pair at
distance r reaches with probability `RECALL` (binomial, normal projections).

Rows are sorted by one more projection, and only runs within its wide window
are read. Equal vectors are one vector with a weight from the start. A label
is dealt to pairs of blocks, so a hot label is shared among tasks, and each
unit of work returns link counts and a spanning forest, never the pairs.
Work within a label grows with the square of its distinct vectors: in 64
dimensions no window of a projection is narrow enough to prune whole blocks
without losing links.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.blocks import deal_blocks, forest, units
from callscope.llm.common import materialize
from callscope.llm.components import connected_components

PROJECTIONS = 16
Z = 2.5
SORT_Z = 4.5
RECALL = 0.9999
SEED = 42
BLOCK_ROWS = 2_048
CHUNK = 256


def needed_collisions(m: int = PROJECTIONS, z: float = Z, recall: float = RECALL) -> int:
    """The recall-calibrated count."""
    p = erf(z / sqrt(2))
    tail, count = 0.0, m + 1
    while count > 0 and tail < recall:
        count -= 1
        tail += comb(m, count) * p ** count * (1 - p) ** (m - count)
    return count


def directions(dim: int, m: int, seed: int = SEED) -> np.ndarray:
    """m random unit directions (dim x m), orthogonal in sets of dim."""
    rng = np.random.default_rng([seed, dim])
    sets = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-m // dim))]
    return np.concatenate(sets, 1)[:, :m]


def colliding_pairs(x: np.ndarray, y: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in x, in y) of the pairs of unit vectors of at least
    `cosine`, found by collision counts; y None: pairs i < j within x."""
    dim = x.shape[1]
    deviation = sqrt(max(0.0, 2 - 2 * cosine) / dim) + 1e-12
    d = directions(dim, PROJECTIONS + 1)
    need = needed_collisions()
    half = PROJECTIONS // 2
    other = x if y is None else y
    px, py = (x @ d).astype(np.float32), (other @ d).astype(np.float32)
    ox, oy = np.argsort(px[:, 0], kind="stable"), np.argsort(py[:, 0], kind="stable")
    px, py = px[ox], py[oy]
    wide, window = np.float32(SORT_Z * deviation), np.float32(Z * deviation)
    left, right = [], []
    for a in range(0, len(ox), CHUNK):
        q = px[a: a + CHUNK]
        lo = np.searchsorted(py[:, 0], q[0, 0] - wide, "left")
        hi = np.searchsorted(py[:, 0], q[-1, 0] + wide, "right")
        if hi <= lo:
            continue
        p = py[lo:hi]
        hits = np.zeros((len(q), hi - lo), np.uint8)
        for j in range(1, half + 1):
            hits += np.abs(q[:, j, None] - p[None, :, j]) <= window
        # a pair that cannot reach the count any more is left out
        i, k = np.nonzero(hits >= max(1, need - (PROJECTIONS - half)))
        total = hits[i, k].astype(np.int64)
        for j in range(half + 1, PROJECTIONS + 1):
            total += np.abs(q[i, j] - p[k, j]) <= window
        ok = total >= need
        left.append(ox[a + i[ok]])
        right.append(oy[lo + k[ok]])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, k = np.concatenate(left), np.concatenate(right)
    if y is None:
        i, k = i[i < k], k[i < k]
    near = np.concatenate([np.einsum("ij,ij->i", x[i[s: s + 65_536]], other[k[s: s + 65_536]])
                           for s in range(0, len(i), 65_536)] or [np.empty(0)]) >= cosine
    return i[near], k[near]


def _vectors(rows: DataFrame) -> DataFrame:
    """vec_id, vid (hash of label, dimension and vector; null if it links
    with nothing), dim, unit (unit vector, double), at a task's first sight of a vid."""
    schema = pa.schema([("vec_id", pa.int64()), ("grp", pa.int64()), ("vid", pa.int64()), ("unit", pa.binary())])

    def run(batches):
        seen = set()
        for batch in batches:
            out = []
            for vec, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                v = None
                if vec and label is not None and None not in vec:
                    v = np.array(vec, np.float64) + 0.0  # no negative zeros
                    top = np.abs(v).max()
                    v = v if np.isfinite(top) and top > 0 else None
                if v is None:
                    out.append((None, None, None))
                    continue
                grp = xxhash.xxh3_64_intdigest(f"{label}|{len(v)}".encode()) - (1 << 63)
                vid = xxhash.xxh3_64_intdigest(v.tobytes(), seed=grp & 0xFFFFFFFF) - (1 << 63)
                unit = None
                if vid not in seen:
                    seen.add(vid)
                    scaled = v / top
                    unit = (scaled / np.sqrt(scaled @ scaled)).tobytes()
                out.append((grp, vid, unit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))], schema=schema)

    return rows.mapInArrow(lambda it: run(b for b in it if b.num_rows), "vec_id long, grp long, vid long, unit binary")


LINKS = "a long, b long, links long"
LINK_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _unit_links(cosine: float):
    def body(a: pa.Table, b: pa.Table | None):
        def matrix(t):
            return np.frombuffer(b"".join(t.column("unit").to_pylist())).reshape(t.num_rows, -1)
        x, y = matrix(a), None if b is None else matrix(b)
        i, k = colliding_pairs(x, y, cosine)
        if not len(i):
            return
        t = a if b is None else pa.concat_tables([a, b])
        ids, copies = t.column("vid").to_numpy(), t.column("copies").to_numpy().astype(np.float64)
        k = k if b is None else k + a.num_rows
        links = (np.bincount(i, copies[k], len(ids)) + np.bincount(k, copies[i], len(ids))).astype(np.int64)
        root = ids.copy()
        moved, to = forest(ids, i, k)
        order = np.argsort(ids, kind="stable")
        root[order[np.searchsorted(ids[order], moved)]] = to
        has = links > 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[has]), pa.array(root[has]), pa.array(links[has])],
                                         schema=LINK_SCHEMA)
    return body


def near_duplicates(rows: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """vec_id, n_links (other vectors of its label with at least `cosine`),
    component_id (smallest vec_id that links lead to), kept (vec_id =
    component_id), one row per input row.

    Vectors that are null, empty, zero, or hold null or non-finite numbers,
    and rows without label, link with nothing (0 links, own component).
    Vectors of different lengths are not compared. Repeated vectors count as
    links of each other. A null vec_id is no component_id unless a component
    has no other, and is never kept. Other columns are not read; an empty
    table gives no rows.
    """
    cols = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                       F.col(label).cast("string").alias("label"))
    vectors = materialize(_vectors(cols), "vectors")
    valid = vectors.filter("vid is not null")
    sets = valid.groupBy("vid").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    one = valid.filter("unit is not null").dropDuplicates(["vid"]).select("grp", "vid", "unit")
    dealt = deal_blocks(one.join(sets.select("vid", "copies"), "vid"), "grp", "vid", F.lit(1), BLOCK_ROWS)
    found = materialize(units(dealt, "grp", "vid", _unit_links(cosine), LINKS, LINK_SCHEMA), "vector-links")
    roots = connected_components(found).withColumnsRenamed({"id": "vid", "component": "root"})
    links = found.groupBy(F.col("a").alias("vid")).agg(F.sum("links").alias("links"))
    per_set = (sets.join(links, "vid", "left").join(roots, "vid", "left")
               .select("vid", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                       F.coalesce("root", "vid").alias("root")))
    smallest = per_set.groupBy("root").agg(F.min("first").alias("component_id"))
    home = per_set.join(smallest, "root").select("vid", "n_links", "component_id")
    return (vectors.select("vec_id", "vid").join(home, "vid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("vid").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
