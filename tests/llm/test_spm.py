"""Encoding and decoding against the sentencepiece library."""

from array import array

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from callscope.llm.common import tokenizer_path
from callscope.llm.spm import PieceModel, decode, encode, encoding_digest

SF = "/root/testdata/sf0.001"
NAME = "piece_bpe_32k.model"
TEXTS = ["", " ", "  a  b ", " x", "a▁b", "日本語 text 🎉 ok", "\n\n  tab\t\t x   y", "naïve café 12345 3.14", "<s> </s> <unk> <0x41>",
         "ab" * 3000, "\x00 nul", "a " * 40, "ᚠᛇᚻ ́"]


@pytest.fixture(scope="module")
def pair():
    return PieceModel(tokenizer_path(NAME)), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(NAME))


def test_ids_and_texts_equal_the_library(spark, pair):
    mine, lib = pair
    for t in TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]:
        ids = lib.encode(t)
        assert list(array("i", mine.encode(t))) == ids, t[:60]
        assert mine.decode(ids) == lib.decode(ids)


def test_any_text(pair):
    mine, lib = pair

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.one_of(st.sampled_from(" \n▁aeiounthrs0123é"), st.characters(codec="utf-8")), max_size=30))
    def check(t):
        assert list(array("i", mine.encode(t))) == lib.encode(t)
    check()


def test_unigram_walk_is_the_best_path(pair):
    """The same automaton as a unigram model: brute force over all splits."""
    mine, _ = pair

    def best(s):
        scores = [0.0] + [float("-inf")] * len(s)
        for end in range(1, len(s) + 1):
            for start in range(end):
                i = mine.ids.get(s[start:end])
                if i is not None:
                    scores[end] = max(scores[end], scores[start] + mine.score[i])
        return scores[-1]
    for s in ("▁theatre", "▁information", "▁unhappily", "▁aaaa"):
        ids = mine._walk_unigram(s)
        assert "".join(mine.piece[i] for i in ids) == s
        assert abs(sum(mine.score[i] for i in ids) - best(s)) < 1e-6


def test_tables(spark, pair):
    rows = [(1, "ab cd", 3), (None, None, None), (2, "", 0), (2, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    enc = encode(df)
    assert sorted(map(tuple, decode(enc).collect()), key=str) == sorted([(r[0], r[1] or "") for r in rows], key=str)
    d = encoding_digest(df).collect()
    assert all(r.round_trip for r in d) and sorted(r.n_tokens for r in d)[:3] == [0, 0, 0]
    assert encoding_digest(df.limit(0)).count() == 0
