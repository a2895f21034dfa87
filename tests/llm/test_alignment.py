"""Aligned tokens against the libraries and a plain two-set alignment."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from callscope.llm import alignment as al
from callscope.llm.common import tokenizer_path
from callscope.llm.tokens import byte_alphabet

SF = "/root/testdata/sf0.001"
TEXTS = ["", " ", "x ", "a▁b", "  two  spaces \n\n x ", "日本 🎉 é", "<|endoftext|> <s> x</s>", "w" * 500, "tab\tand\nline ", None,
         "naïve café's 1234 5678", "don't’t", "a  ", "\x00 nul", "end\n ", " é ́"]


@pytest.fixture(scope="module")
def tools():
    tok = Tokenizer.from_file(tokenizer_path(al.A_FILE))
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(al.B_FILE))


def plain(tools, text):
    """n_a, n_b, groups, linked pairs, by sets of ends; None without tokens."""
    if not text:
        return None
    tok, sp = tools
    enc = tok.encode(" " + text, add_special_tokens=False)
    value = {c: b for b, c in enumerate(byte_alphabet())}
    a = [(i, bytes(value[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
    b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
         for i in sp.encode(text)]
    if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == (" " + text).encode():
        return None
    ends_a, ends_b = (np.cumsum([len(t) for _, t in x]).tolist() for x in (a, b))
    groups, links, i, j = [], Counter(), 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(str(t) for t, _ in a[i:x]) + "|" + ",".join(str(t) for t, _ in b[j:y]))
        links[a[x - 1][0], b[y - 1][0]] += 1
        i, j = x, y
    return len(a), len(b), ";".join(groups), links


def as_pairs(found):
    return found and (*found[:3], Counter({(p // al.SHIFT, p % al.SHIFT): n for p, n in found[3].items()}))


@given(st.lists(st.integers(1, 4), min_size=1, max_size=300), st.lists(st.integers(1, 4), min_size=1, max_size=300), st.randoms())
@settings(max_examples=200, deadline=None)
def test_diagonal_runs_find_all_common_ends(a, b, rnd):
    a += a[:40] * rnd.choice([0, 1, 4])   # long one-to-one stretches, too
    b = rnd.choice([b, a[:]])
    more = sum(a) - sum(b)
    (b if more > 0 else a).extend([1] * abs(more))
    x, y = np.cumsum(a), np.cumsum(b)
    odd = al.align_ends(x, y)
    common = np.intersect1d(x, y)
    assert (x[al.last_tokens(len(x), [g[:2] for g in odd])] == common).all()
    assert (y[al.last_tokens(len(y), [g[2:] for g in odd])] == common).all()


def test_texts_equal_a_plain_alignment(spark, tools):
    tool = al.Aligner(tokenizer_path(al.A_FILE), tokenizer_path(al.B_FILE))
    assert tool.by_word and tool.quick is not None
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [r for k in range(0, len(texts), 7) for r in tool.align(texts[k:k + 7])]
    for text, found in zip(texts, got):
        assert as_pairs(found) == plain(tools, text), text and text[:80]


def test_any_text(tools):
    tool = al.Aligner(tokenizer_path(al.A_FILE), tokenizer_path(al.B_FILE))

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.one_of(st.sampled_from(" \n\t'sStT<|>endoftx12é日̀▁"), st.characters(codec="utf-8")), max_size=40))
    def check(t):
        assert as_pairs(tool.align([t])[0]) == plain(tools, t)
    check()


def test_pairs_are_bounded_by_the_vocabularies():
    tool = al.Aligner(tokenizer_path(al.A_FILE), tokenizer_path(al.B_FILE))
    bound = al.pair_bound(tool.bytes_a, tool.bytes_b)
    assert bound < 400_000
    a, b = [b"x", b"ax", b"y"], [b"x", b"bx", b"bax"]
    assert al.pair_bound(a, b) == 5   # x-x, ax-x, x-bx, x-bax, ax-bax


def test_corpus_figures(spark, tools):
    rnd = random.Random(4)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:60] + TEXTS
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "null id", None, None), (3, "same id", 2, "y"), (3, "same id", 2, "y"),
                                                          (900, "long word " * 20_000, 0, "")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, pairs string").repartition(3)
    alone = [(i, plain(tools, t)) for i, t, *_ in rows]
    counts = Counter()
    for _, found in alone:
        counts.update(found[3] if found else {})
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    want = []
    for i, found in alone:
        if found is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        n = links.total()
        want.append((i, n_a, n_b, n, n, sum(k for p, k in links.items() if counts[p] == top[p[1]]),
                     sum(k * counts[p] for p, k in links.items()), hashlib.sha256(groups.encode()).hexdigest()))
    got = [tuple(r) for r in al.alignment(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert al.alignment(docs.limit(0)).count() == 0
