"""Similarity joins and components against all pairs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callscope.llm import jaccard_join as jj
from callscope.llm.blocks import forest, stars
from callscope.llm.components import connected_components
from callscope.llm.embed_dedup import colliding_pairs, near_duplicates, needed_collisions

SF = "/root/testdata/sf0.001"


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def linked(a, b, permille):
    both = len(a & b)
    return bool(a) and bool(b) and 1000 * both >= permille * (len(a) + len(b) - both)


def brute(rows, n, permille):
    sets = [(d, shingles(t, n)) for d, t in rows]
    u = Union([d for d, _ in sets])
    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if linked(a, b, permille):
                u.join(d, e)
    return {d: (len(s), u.find(d)) for d, s in sets}


def corpus(seed, docs=140):
    """Copies, near copies of many degrees, a shared passage, short and odd texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    rows, base = [], [rng.choice(words) for _ in range(120)]
    for i in range(docs):
        kind = i % 7
        if kind == 0:
            base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 12, 30, 120, 400]))]
            text = base
        elif kind in (1, 2, 3):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 12))):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind == 4:
            text = list(base)
        elif kind == 5:
            text = passage + [rng.choice(words) for _ in range(rng.randint(0, 30))]
        else:
            text = [rng.choice(words) for _ in range(rng.randint(0, 6))]
        rows.append((i * 3, "  ".join(w.upper() if rng.random() < 0.1 else w for w in text)))
    return rows + [(1000, None), (1001, " \t\n"), (1002, ""), (1003, "é É"), (1004, "É é")]


@pytest.mark.parametrize("seed, n, threshold", [(1, 4, 0.85), (2, 5, 0.8), (3, 2, 0.6), (4, 1, 0.95)])
def test_jaccard_components(spark, seed, n, threshold):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df, n, threshold).collect()}
    assert got == brute(rows, n, round(threshold * 1000))


def test_jaccard_small_blocks_give_the_same(spark, monkeypatch):
    """A large group dealt to many blocks."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(80)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(t)))
    monkeypatch.setattr(jj, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 5_000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()}
    assert got == brute(rows, 4, 850)


def test_jaccard_parts_of_a_large_group(spark, monkeypatch):
    """A chain whose ends are far apart: most links run between blocks, and
    hubs alone do not join its parts."""
    rng = random.Random(4)
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 3: i * 3 + 60])) for i in range(100)]
    rows += [(500 + i, " ".join([*words[:40], *(f"y{rng.randrange(9)}" for _ in range(8))])) for i in range(60)]
    rng.shuffle(rows)
    monkeypatch.setattr(jj, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 9_000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for n, threshold in ((1, 0.85), (2, 0.8)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df, n, threshold).collect()}
        assert got == brute(rows, n, round(threshold * 1000))


def test_jaccard_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 4, 850)


def test_jaccard_null_and_repeated_ids(spark):
    text = " ".join(f"v{i}" for i in range(50))
    rows = [(None, text), (7, text), (7, "other words of another text here"), (None, "alone in this one text of words"),
            (None, None), (9, text + " tail")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, sid string, keys int")
    got = jj.jaccard_components(df).collect()
    assert len(got) == 6 and {r.component_id for r in got if r.n_shingles == 47} == {7}
    assert [r.component_id for r in got if r.doc_id == 9] == [7]
    kept = jj.keep_one(df, 4, 0.85)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, [
        r for r in df.select("doc_id", "text").collect() if r.text is None or "v0" not in r.text or (r.doc_id == 7)]))
    assert jj.jaccard_components(df.limit(0)).count() == 0 and jj.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("permille", [850, 800, 600, 500, 300])
def test_sizes_within_the_threshold_share_a_band(permille):
    for n in range(1, 700):
        own = jj.bands_of(n, permille)[0]
        for m in range(n, min(700, n * 1000 // permille + 1)):
            assert own in jj.bands_of(m, permille), (n, m)


def test_low_thresholds_link_across_bands(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words[:42])), (2, " ".join(words[:69])), (3, " ".join(words[100:140])), (4, " ".join(words[100:180]))]
    for threshold, homes in ((0.6, [1, 1, 3, 4]), (0.5, [1, 1, 3, 3])):
        found = jj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, threshold)
        assert [r.component_id for r in found.orderBy("doc_id").collect()] == homes
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(rows, 1, round(threshold * 1000))


def test_sketches_bound_the_difference():
    """Hamming distance of parity sketches, and the pigeonhole of the keys."""
    rng = np.random.default_rng(5)
    for size in (6, 9, 17, 60, 300, 1500):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            k = 15 * len(a) // 100
            b = np.unique(np.concatenate([a[rng.integers(0, k + 1):], rng.integers(0, 1 << 63, rng.integers(0, k + 1), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            delta = len(a) + len(b) - 2 * both
            s, t = (np.unpackbits(np.frombuffer(jj.parity_sketch(x), np.uint8)) for x in (a, b))
            assert (s != t).sum() <= delta
            if 1000 * both >= 850 * (len(a) + len(b) - both) and delta:
                assert set(jj.band_keys(a, 850).tolist()) & set(jj.band_keys(b, 850).tolist())


def test_wide_sketches_fold():
    rng = np.random.default_rng(6)
    for size in (1, 1024, 1025, 5000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        s = np.frombuffer(jj.wide_sketch(a), np.uint8)
        assert 8 * len(s) >= max(1024, len(a))
        while len(s) > 128:
            s = s[: len(s) // 2] ^ s[len(s) // 2:]
        assert s.tobytes() == jj.parity_sketch(a)


def test_jaccard_long_texts_with_a_common_passage(spark, monkeypatch):
    """Sets far larger than the fixed sketch: strangers that share a passage,
    near copies of some of them, sizes on both sides of a sketch length."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(120)]
    rows = []
    for i in range(24):
        text = passage + [f"z{rng.randrange(10**6)}" for _ in range(rng.choice([1900, 2020, 3900]))]
        rows.append((i, " ".join(text)))
        if i % 3 == 0:
            for _ in range(rng.randint(1, 60)):
                text[rng.randrange(len(text))] = "edit"
            rows.append((100 + i, " ".join(text + ["more"] * rng.choice([0, 1]) + [f"t{j}" for j in range(rng.randint(0, 90))])))
    monkeypatch.setattr(jj, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 12_000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(df).collect()}
    assert got == brute(rows, 4, 850)


@settings(max_examples=60, deadline=None)
@given(st.integers(5, 40), st.lists(st.tuples(st.integers(0, 39), st.integers(0, 39)), max_size=60))
def test_forest(n, links):
    links = [(a % n, b % n) for a, b in links if a % n != b % n]
    ids = np.random.default_rng(n).permutation(np.arange(100, 100 + n))
    u = Union(ids.tolist())
    for a, b in links:
        u.join(int(ids[a]), int(ids[b]))
    x, y = forest(ids, np.array([a for a, _ in links], int), np.array([b for _, b in links], int))
    assert dict(zip(x.tolist(), y.tolist())) == {i: u.find(i) for i in ids.tolist() if u.find(i) != i}
    x, y = stars(ids, np.array([a for a, _ in links], int), np.array([b for _, b in links], int))
    degree = {i: sum((int(ids[a]) == i) + (int(ids[b]) == i) for a, b in links) for i in u.up}
    hubs = {root: min((i for i in u.up if u.find(i) == root), key=lambda i: (-degree[i], i)) for root in set(map(u.find, u.up))}
    assert dict(zip(x.tolist(), y.tolist())) == {i: hubs[u.find(i)] for i in u.up if hubs[u.find(i)] != i}


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 80)]  # a chain, a hub
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(110)] + [(3, 3), (None, 4)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = {r.id: r.component for r in connected_components(df).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    u = Union({x for e in real for x in e})
    for a, b in real:
        u.join(a, b)
    assert got == {i: u.find(i) for i in u.up}
    assert connected_components(df.limit(0)).count() == 0


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(n, dim, seed):
    """Pairs at distances around the threshold."""
    rng = np.random.default_rng(seed)
    x = unit(rng.standard_normal((n, dim)))
    noise = unit(rng.standard_normal((n, dim)))
    return np.concatenate([x, unit(x + noise * rng.uniform(0.0, 0.25, (n, 1)))])


@pytest.mark.parametrize("dim", [8, 64, 300])
def test_recall_of_collision_counts(dim):
    assert 8 <= needed_collisions() <= 16
    v = near_vectors(700, dim, dim)
    s = v @ v.T
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(s >= 0.98, 1)))}
    i, j = colliding_pairs(v, None, 0.98)
    got = set(zip(i.tolist(), j.tolist()))
    assert got <= want and len(got) >= 0.99 * len(want) > 100
    a, b = colliding_pairs(v[:700], v[700:], 0.98)
    assert {(x, y + 700) for x, y in zip(a.tolist(), b.tolist())} <= want


def test_near_duplicates(spark, monkeypatch):
    import callscope.llm.embed_dedup as ed
    monkeypatch.setattr(ed, "BLOCK_ROWS", 40)
    v = near_vectors(60, 16, 3)
    rows = [(i, [float(c) for c in x], i % 60 % 3) for i, x in enumerate(v)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(30)]  # copies
    rows += [(2000, rows[5][1], None), (2001, None, 1), (2002, [], 1), (2003, [0.0] * 16, 1), (2004, [None] + [1.0] * 15, 1),
             (2005, [float("nan")] * 16, 1), (2006, [float("inf")] * 16, 1), (2007, [1.0] * 7, 1), (2008, [1.0] * 7, 1),
             (2009, [1e300] * 7, 1), (2010, [-0.0, 1.0, 0.0], 1), (2011, [0.0, 1.0, -0.0], 1), (None, [2.0] * 7, 1)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, vid string, links int")
    got = {r.vec_id: tuple(r)[1:] for r in near_duplicates(df.repartition(4)).collect()}
    ok = [(i, np.array(x) / np.abs(x).max(), y) for i, x, y in rows if y is not None and x and None not in x
          and np.isfinite(x).all() and any(x)]
    u, links = Union([r[0] for r in rows if r[0] is not None]), {r[0]: 0 for r in rows}
    for k, (i, x, y) in enumerate(ok):
        for j, z, w in ok[:k]:
            if y == w and len(x) == len(z) and x @ z / np.sqrt((x @ x) * (z @ z)) >= 0.98:
                links[i] += 1
                links[j] += 1
                if i is not None and j is not None:
                    u.join(i, j)
    assert len(got) == len(rows)
    for i in links:
        home = 2007 if i is None else u.find(i)
        assert got[i] == (links[i], home, i == home), i
    assert near_duplicates(df.limit(0)).count() == 0


def test_keep_one_keeps_columns_named_like_its_own(spark):
    schema = "doc_id long, text string, sid string, root long, single int, place string, _sid double"
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text, "s", 9, 1, "here", 0.5), (1, text, "t", 8, 2, "there", 0.25), (2, "other words all along this line", "u", 7, 3, "x", 1.0),
            (4, "", "v", 6, 4, "y", 2.0)]
    out = jj.keep_one(spark.createDataFrame(rows, schema), 5, 0.8)
    assert sorted(map(tuple, out.collect())) == sorted(rows[1:])
