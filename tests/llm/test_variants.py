"""Near words, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from callscope.llm import variants as v

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows, every=31, least=7, times=2):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % every == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            out[low] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= times}


def brute(n, ratio=10):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n.get(form.get(w)))
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_words_are_counted_whole(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, "nullids NULLIDS nullids"), (7, None), (7, ""), (8, "×÷×÷×÷×÷ ÀÉÎÕÜßý ÀÉÎÕÜßý àéîõüßý " * 3), (9, "w" * 5_000 + " " + "w" * 5_000),
             (10, "straßenbahn STRAßENBAHN " * 40), (11, "a1b2c3d4e5f6g7 abcdefg_abcdefg")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    assert {r.word: r.n for r in v.count_words(docs).collect()} == counted(rows)
    assert {r.word: r.n for r in v.count_words(docs, 3, 1, 2).collect()} == counted(rows, 2, 3, 1)


def test_documents_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:120]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(v.spelling_variants(docs)) == brute(counted(rows))


@pytest.mark.parametrize("block,tile", [(1_024, 192), (7, 5)])
def test_dense_words_equal_brute_force(spark, monkeypatch, block, tile):
    """Few letters, many near words, ties, forms of forms, blocks and tiles cut small."""
    monkeypatch.setattr(v, "BLOCK", block)
    monkeypatch.setattr(v, "TILE", tile)
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abé中") for _ in range(rnd.randint(1, 8))): rnd.choice([1, 1, 2, 10, 20, 100, 1_000, 10_000])
             for _ in range(700)}
    words |= {"z" * 900: 5, "z" * 899: 60, "z" * 450 + "y" + "z" * 449: 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = brute(words)
    assert found(v.variants(df)) == want
    assert any(want[w[0]][0] for w in want.values() if w[0])   # a form that has a form


def test_tile_counts_a_pair_once():
    """By prefix and by suffix together, every near pair once."""
    every = ["aaaa", "aaab", "baaa", "aaa", "aaaaa", "bbbb", "abbb", "bba", "abab", "aabb", "ababa", "babab", "baba"]
    for size in (4, 5):
        words = [w for w in every if len(w) in (size - 1, size)]
        k = (size - 1) // 2
        found = Counter()
        for by_suffix in (False, True):
            part = [w[len(w) - (size - k):] if by_suffix else w[:k] for w in words]
            group = np.array([[x == y for y in part] for x in part]) & ~np.eye(len(words), dtype=bool)
            found.update((words[i], words[j]) for i, j in zip(*v.near_in_tile(size, by_suffix, words, words, group)))
        want = {(x, y) for x in words for y in words if one_edit(x, y) and max(len(x), len(y)) == size}
        assert found == Counter(want)


def test_empty(spark):
    assert v.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert v.spelling_variants(spark.createDataFrame([(1, None), (2, "short")], "doc_id long, text string")).count() == 0
