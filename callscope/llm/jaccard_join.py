"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles, hashed to 64 bits. A token
toggles one bit of a sketch, so the sketch is linear and the Hamming distance
of two sketches is at most the size of the sets' symmetric difference.

Sets whose sizes lie in one band are compared through a sketch of m parts of
2^16 bits (kept sparse: a part is known by the XOR of one random word per set
bit). With at most k differences, at least m - k parts agree; m > k, so
linked sets share the word of a part (pigeonhole). All-zero parts are keys
only for sets with at most k other parts, which loses nothing: agreeing parts
that are all zero leave at most k others on either side. Bands overlap, so
that sizes within the threshold always share one.

Equal sets are one set from the start. Groups of sets with a common key are
merged where they have the same members, then compared block by block: first
by size and a 1024-bit parity sketch of the whole set, then, in groups that
hang together by that, exactly. Blocks return spanning forests; components
follow from them. Nothing is capped or sampled, and no pairs are emitted.

A large group is not sent from every block to every other with its shingles.
It is taken apart by sketches of a bit per shingle first. What is left is dealt
to blocks, which are compared with themselves first, then one set of each linked
part with those of the other blocks. What hangs together by then needs no more
links. Sets that may, by size and sketch, be linked with one of another part
are looked for by sketch alone, and only those are compared block by block.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callscope.llm.blocks import deal_blocks, forest, group_blocks, own_blocks, stars, units
from callscope.llm.common import materialize, unused, worker_tool
from callscope.llm.components import connected_components

BAND = 1.6
SKETCH_WORDS = 16  # of 64 bits
BLOCK_ROWS = 2_048
BLOCK_SHINGLES = 400_000
SLICE_ROWS = 512
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingler:
    """Sorted distinct 64-bit shingles of whole texts. A-Z are lower-cased;
    words are runs of anything but space and U+0009 to U+000D; a text with
    fewer words than a shingle has is one shingle; no words, no shingle."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8").lower().split() if text else []
        if not words:
            return np.empty(0, U)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
        size = min(self.n, len(words))
        out = h[: len(h) - size + 1].copy()
        for i in range(1, size):
            out = mix(out) + h[i: len(h) - size + 1 + i]
        return np.unique(mix(out + U(size)))


@lru_cache(maxsize=None)
def band(i: int, permille: int) -> tuple[int, int, int, int]:
    """(lowest size, first size of the next band, differences k, parts m) of
    band i; sets of up to (next - 1) / threshold take part in it."""
    low, following = int(np.ceil(BAND ** i)), int(np.ceil(BAND ** (i + 1)))
    k = (1000 - permille) * (following - 1) // permille
    return low, following, k, k + 2 + k // 16


def bands_of(n: int, permille: int) -> list[int]:
    """The bands that a set of n shingles takes part in: its own, and those
    below down to the one of the smallest set it can be linked with."""
    i = int(np.log(n) / np.log(BAND) + 1e-9)
    while band(i, permille)[0] > n:
        i -= 1
    while band(i, permille)[1] <= n:
        i += 1
    out, below = [i], i - 1
    while below >= 0 and n * permille <= (band(below, permille)[1] - 1) * 1000:
        if band(below, permille)[0] < band(below, permille)[1]:
            out.append(below)
        below -= 1
    return out


def band_keys(shingles: np.ndarray, permille: int) -> np.ndarray:
    """The keys of a set: one word per band and part."""
    out = []
    for i in bands_of(len(shingles), permille):
        _, _, k, m = band(i, permille)
        if k == 0:
            continue  # no difference allowed: only equal sets
        h = mix(shingles + U(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64)))
        part = ((h >> U(32)) * U(m)) >> U(32)
        bit = mix((h & U(0xFFFF)) + (part << U(16)))
        order = np.argsort(part, kind="stable")
        part, bit = part[order], bit[order]
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        words = np.zeros(m, U)
        words[part[first].astype(np.int64)] = np.bitwise_xor.reduceat(bit, first)
        keys = mix(words + mix((U(i) << U(40)) + np.arange(m, dtype=U)))
        out.append(keys if (words != 0).sum() <= k else keys[words != 0])
    return np.concatenate(out) if out else np.empty(0, U)


def parity_sketch(shingles: np.ndarray, bits: int = 64 * SKETCH_WORDS) -> bytes:
    """The set's parity in `bits` (a power of two) bits. The XOR of its
    halves is the sketch of half as many bits."""
    at = mix(shingles ^ U(0xA5A5A5A5A5A5A5A5)) & U(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_sketch(shingles: np.ndarray) -> bytes:
    """A parity sketch of at least one bit per shingle: one of fixed size
    fills up in sets of many more shingles and tells nothing about them."""
    return parity_sketch(shingles, max(64 * SKETCH_WORDS, 1 << (len(shingles) - 1).bit_length()))


def _first_seen(n: int, emit, schema: pa.Schema):
    """`mapInArrow` body over (doc_id, text): `emit(doc_ids, sets, ids, new)`
    for every slice of a batch, where `new` marks a task's first sight of a set."""
    def run(batches):
        worker_tool(("shingles",), lambda: None)  # what the worker kept for another step goes
        shingler, seen = Shingler(n), set()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                ids = [set_id(s) for s in sets]
                new = []
                for sid in ids:
                    new.append(sid is not None and sid not in seen)
                    seen.add(sid)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c
                                                  for c, f in zip(emit(part.column(0), sets, ids, new), schema)], schema=schema)
    return run


def _features(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, sid (hash of the set; null if empty), and, at a
    task's first sight of a set, its sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.int64()), ("sketch", pa.binary())])

    def emit(doc_ids, sets, ids, new):
        return doc_ids, [len(s) for s in sets], ids, [parity_sketch(s) if x else None for s, x in zip(sets, new)]

    return docs.mapInArrow(_first_seen(n, emit, schema), "doc_id long, n_shingles long, sid long, sketch binary")


def _keyed(docs: DataFrame, n: int, permille: int) -> DataFrame:
    """key, sid: the keys of every set, once a task. They go straight to the
    shuffle: as a table they would be as large as the texts."""
    schema = pa.schema([("key", pa.int64()), ("sid", pa.int64())])

    def emit(doc_ids, sets, ids, new):
        keys = [band_keys(s, permille).view(np.int64) for s, x in zip(sets, new) if x]
        owner = np.repeat(np.array([i for i, x in zip(ids, new) if x], np.int64), [len(k) for k in keys])
        return (np.concatenate(keys) if keys else np.empty(0, np.int64)), owner

    return docs.mapInArrow(_first_seen(n, emit, schema), "key long, sid long")


EDGES = "a long, b long"
EDGE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(ids: np.ndarray, a: list, b: list, tree=forest):
    x, y = tree(ids, np.concatenate(a) if a else np.empty(0, int), np.concatenate(b) if b else np.empty(0, int))
    if len(x):
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], schema=EDGE_SCHEMA)


def _stack(a: pa.Table, b: pa.Table | None) -> tuple[pa.Table, int]:
    """Both blocks as one table, and where the second begins."""
    return (a, 0) if b is None else (pa.concat_tables([a, b]), a.num_rows)


def _sketch_pairs(t: pa.Table, second: int, permille: int):
    """For every row of the first block: its place, and those of the rows
    behind it (of the other block) whose sizes and sketches allow a link.
    Sketches of different lengths are compared at the shorter one."""
    n = t.column("n").to_numpy().astype(np.int64)
    whole = [np.frombuffer(x, U) for x in t.column("sketch").to_pylist()]
    words = np.array([len(x) for x in whole], np.int64)
    at, folded = {}, {}  # by length: the rows of at least that length (place in the matrix), and their sketches folded to it
    for w in np.unique(words).tolist():
        rows = np.flatnonzero(words >= w)
        at[w] = np.cumsum(words >= w) - 1
        folded[w] = np.stack([np.bitwise_xor.reduce(whole[r].reshape(-1, w), axis=0) for r in rows])
    for i in range(second or len(n) - 1):
        j = np.arange(second or i + 1, len(n))
        lo, hi = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        j = j[lo * 1000 >= hi * permille]
        shorter = np.minimum(words[i], words[j])
        far = np.empty(len(j), np.int64)
        for w in np.unique(shorter).tolist():
            of = shorter == w
            far[of] = np.bitwise_count(folded[w][at[w][j[of]]] ^ folded[w][at[w][i]]).sum(1, dtype=np.int64)
        yield i, j[far * (1000 + permille) <= (1000 - permille) * (n[i] + n[j])]


def _by_sketch(permille: int):
    """Candidates: pairs whose sizes and sketches allow a link."""
    def body(a, b):
        t, second = _stack(a, b)
        left, right = [], []
        for i, j in _sketch_pairs(t, second, permille):
            left.append(np.full(len(j), i))
            right.append(j)
        yield from _edges(t.column("sid").to_numpy(), left, right)
    return body


APART = pa.schema([("sid", pa.int64())])


def _apart(permille: int):
    """Sets that sizes and sketches allow a link with a set of another part."""
    def body(a, b):
        t, second = _stack(a, b)
        part = t.column("part").to_numpy()
        open_ = np.zeros(len(part), bool)
        for i, j in _sketch_pairs(t, second, permille):
            j = j[part[j] != part[i]]
            open_[j] = True
            open_[i] |= len(j) > 0
        if open_.any():
            yield pa.RecordBatch.from_arrays([pa.array(t.column("sid").to_numpy()[open_])], schema=APART)
    return body


def _exactly(permille: int, tree=forest):
    """Links: 1000 * intersection >= permille * union, counted on the sets."""
    def body(a, b):
        t, second = _stack(a, b)
        ids = t.column("sid").to_numpy()
        sets = [np.frombuffer(x, U) for x in t.column("shingles").to_pylist()]
        n = np.array([len(x) for x in sets], np.int64)
        tokens = np.concatenate(sets)
        rows = np.repeat(np.arange(len(ids)), n)
        order = np.argsort(tokens, kind="stable")
        tokens, rows = tokens[order], rows[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        count = np.diff(np.r_[first, len(tokens)])
        column = np.repeat(np.cumsum(count > 1) - 1, count)
        shared = np.repeat(count > 1, count)  # a shingle of one set is in no intersection
        rows, column = rows[shared], column[shared]
        common = np.zeros((len(ids) if b is None else second, len(ids)), np.float32)
        starts = np.searchsorted(column, np.arange(0, column[-1] + 2 if len(column) else 0, 4096))
        for x, y in zip(starts, [*starts[1:], len(column)]):
            if y > x:
                m = np.zeros((len(ids), 4096), np.float32)
                m[rows[x:y], column[x:y] % 4096] = 1
                common += m[: len(common)] @ m.T
        left, right = [], []
        for i in range(len(common)):
            j = np.arange(second or i + 1, len(ids))
            both = common[i, j].astype(np.int64)
            j = j[1000 * both >= permille * (n[i] + n[j] - both)]
            left.append(np.full(len(j), i))
            right.append(j)
        yield from _edges(ids, left, right, tree)
    return body


def _sketch_weight():
    """A sketch's share of a block, in sketches of the fixed size."""
    return F.expr(f"length(sketch) div {8 * SKETCH_WORDS}")


def _links(sets: DataFrame, permille: int) -> DataFrame:
    """Edges (a, b) that connect what the links among the sets (sid,
    component, n, sketch, shingles) of each component connect."""
    weight, shown = F.col("n") + 1_000, ("component", "sid", "n", "shingles")

    def compare(rows):
        return units(deal_blocks(rows.select(*shown), "component", "sid", weight, BLOCK_SHINGLES), "component", "sid",
                     _exactly(permille), EDGES, EDGE_SCHEMA)

    sizes = group_blocks(sets, "component", weight, BLOCK_SHINGLES)
    if not sizes.isEmpty():
        # large groups, taken apart by sketches that are as long as their sets are large
        large = sets.join(sizes.select("component"), "component", "left_semi")
        near = connected_components(units(deal_blocks(large.select("component", "sid", "n", "sketch"), "component", "sid",
                                                      _sketch_weight(), BLOCK_ROWS), "component", "sid", _by_sketch(permille),
                                          EDGES, EDGE_SCHEMA)).withColumnsRenamed({"id": "sid", "component": "finer"})
        sets = (sets.join(sizes.select("component", F.lit(True).alias("large")), "component", "left").join(near, "sid", "left")
                .filter("large is null or finer is not null").withColumn("component", F.coalesce("finer", "component"))
                .select(*shown, "sketch"))
        sizes = group_blocks(sets, "component", weight, BLOCK_SHINGLES)
    own = units(own_blocks(sets.select(*shown), sizes, "component", "sid"), "component", "sid",
                _exactly(permille, stars), EDGES, EDGE_SCHEMA)
    if sizes.isEmpty():
        return own  # every group is one block

    # groups of several blocks: the hubs of their parts, and the sets without a link
    own = materialize(own, "jaccard-own")
    large = sets.join(sizes.select("component"), "component", "left_semi")
    hubs = large.join(own.select(F.col("a").alias("sid")), "sid", "left_anti")
    joined = connected_components(own.unionByName(compare(hubs)))

    # sets that a link may join to another part of their group
    parts = (large.select("component", "sid", "n", "sketch").join(joined.select(F.col("id").alias("sid"), F.col("component").alias("part")),
                                                               "sid", "left").withColumn("part", F.coalesce("part", "sid")))
    several = parts.groupBy("component").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo != hi")
    parts = materialize(parts.join(several.select("component"), "component", "left_semi"), "jaccard-parts")
    apart = units(deal_blocks(parts, "component", "sid", _sketch_weight(), BLOCK_ROWS), "component", "sid", _apart(permille),
                  "sid long", APART)
    rest = materialize(large.join(apart.distinct(), "sid", "left_semi").select(*shown), "jaccard-apart")
    return joined.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(compare(rest))


def set_id(shingles: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


FILTER_BITS = 1 << 24


def _marked(cols: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `cols` whose doc_id may be in `ids` (first): a filter of
    `FILTER_BITS` bits in words of 64, so what is broadcast is at most
    FILTER_BITS / 64 rows, however many ids there are. Rows that pass by
    chance are dropped by the join that follows."""
    def bit(c: str):
        return F.pmod(F.xxhash64(F.col(c)), F.lit(FILTER_BITS))

    words = (ids.select((bit("first") / 64).cast("int").alias("_w"), (bit("first") % 64).cast("int").alias("_s"))
             .groupBy("_w").agg(F.bit_or(F.expr("shiftleft(1L, _s)")).alias("_bits")))
    rows = cols.withColumns({"_w": (bit("doc_id") / 64).cast("int"), "_s": (bit("doc_id") % 64).cast("int")})
    return rows.join(F.broadcast(words), "_w").filter(F.expr("shiftrightunsigned(_bits, _s) & 1L = 1L")).select(*cols.columns)


def set_components(cols: DataFrame, n: int, permille: int) -> tuple[DataFrame, DataFrame]:
    """For rows (doc_id, text): their (doc_id, n_shingles, sid), and (sid,
    root, component_id) of every set, where linked sets have one root."""
    rows = materialize(_features(cols, n), "jaccard-features")
    first = rows.groupBy("sid").agg(F.min("doc_id").alias("first")).filter("sid is not null")

    # sets by key; groups with the same members become one
    own = Window.partitionBy("key")
    keyed = _keyed(cols, n, permille)
    met = (keyed.withColumns({"lo": F.min("sid").over(own), "hi": F.max("sid").over(own),
                              "x": F.bit_xor(F.xxhash64("sid")).over(own)})
           .filter("lo != hi").select(F.xxhash64("lo", "hi", "x").alias("grp"), "sid"))
    met = materialize(met.distinct(), "jaccard-groups")
    sketches = rows.filter("sketch is not null").select("sid", F.col("n_shingles").alias("n"), "sketch")
    sketches = sketches.join(met.select("sid").distinct(), "sid", "left_semi").dropDuplicates(["sid"])
    near = units(deal_blocks(met.join(sketches, "sid").select("grp", "sid", "n", "sketch"), "grp", "sid", F.lit(1),
                             BLOCK_ROWS), "grp", "sid", _by_sketch(permille), EDGES, EDGE_SCHEMA)
    groups = materialize(connected_components(near), "jaccard-candidates")

    # exact comparison within the groups; the first document of each set stands for it
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("shingles", pa.binary())])

    def sets(batches):
        shingler = Shingler(n)
        for batch in batches:
            s = [shingler(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([set_id(x) for x in s], pa.int64()),
                                              pa.array([len(x) for x in s], pa.int64()),
                                              pa.array([wide_sketch(x) if len(x) else None for x in s], pa.binary()),
                                              pa.array([x.tobytes() for x in s], pa.binary())], schema=schema)

    reps = groups.join(first, groups["id"] == first["sid"]).select("first")
    members = groups.withColumnRenamed("id", "sid")
    exact = (_marked(cols, reps).select("text").mapInArrow(sets, "sid long, n long, sketch binary, shingles binary")
             .join(members, "sid").dropDuplicates(["sid"]))
    exact = materialize(exact, "jaccard-sets")
    found = connected_components(_links(exact, permille)).withColumnsRenamed({"id": "sid", "component": "root"})
    per_set = first.join(found, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = per_set.groupBy("root").agg(F.min("first").alias("component_id"))
    home = per_set.join(smallest, "root").select("sid", "root", "component_id")
    return rows.select("doc_id", "n_shingles", "sid"), home


def jaccard_components(docs: DataFrame, n: int = 4, threshold: float = 0.85, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """doc_id, n_shingles (size of its set of word n-grams), component_id
    (smallest doc_id that links lead to, its own included), one row per input
    row. Sets link when intersection / union >= `threshold` (in thousandths).

    Null text and text without words have the empty set, which links with
    nothing. Rows of equal texts are linked. A null doc_id never is a
    component_id unless all rows of a component have none; for empty sets
    component_id is the own doc_id. Other columns are not read; an empty
    table gives no rows.
    """
    permille = round(threshold * 1000)
    cols = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, home = set_components(cols, n, permille)
    return rows.join(home, "sid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those whose set is linked
    with that of a row before: of each component the row of the smallest
    doc_id stays (nulls last, then the smallest hash of its text). Rows
    whose set is empty all stay."""
    _, home = set_components(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), n,
                             round(threshold * 1000))

    @F.pandas_udf("long")
    def sid(texts):
        shingler = Shingler(n)
        # not through map(): with a null among them it would make floats of the ids
        return type(texts)([set_id(shingler(t)) for t in texts], dtype="Int64")

    own, root, single, place = unused(docs, "sid", "root", "single", "place")
    ranked = docs.withColumn(own, sid(F.col(text))).join(
        home.select(F.col("sid").alias(own), F.col("root").alias(root)), own, "left")
    # every empty set is a group of its own
    alone = F.when(F.col(own).isNull(), F.monotonically_increasing_id())
    best = Window.partitionBy(root, single).orderBy(F.asc_nulls_last(doc_id), F.xxhash64(text))
    return (ranked.withColumn(single, alone).withColumn(place, F.row_number().over(best)).filter(F.col(place) == 1)
            .select(*docs.columns))
