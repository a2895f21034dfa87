"""Units, counts, files and packing against the tokenizer libraries."""

import zlib
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callscope.llm.common import scratch_path, tokenizer_path
from callscope.llm.packing import pack, sequences, sum_of_squares_pack, token_pieces
from callscope.llm.token_counts import token_counts
from callscope.llm.token_files import map_shard, read_token_files, write_token_files
from callscope.llm.tokens import Generations, UnitEncoder

SF = "/root/testdata/sf0.001"
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TEXTS = ["", " ", "  a  b ", "a\n b\t\tc  \n", "it's we'll I'D 'S", "naïve café ÀÉ straße", "日本語 text 🎉 ok", "12 3456 7.8",
         "x<|endoftext|>y <|endoftext|> <|startoftext|>z", "a\x1cb\x1dc d", "İstanbul ΣΑΣ é é ﬁ", "   lead", "trail   ",
         "a b c\u0085d", "\r\n\r\n", "w" * 3000, "̀a ̀", "<|endoftext|", "don't’t"]
DOCS = "doc_id long, text string, length int, ids string, block long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, long and repeated texts, repeated and
    null ids, extra columns with clashing names."""
    rows = [(i, t, 1, "x", None) for i, t in enumerate(TEXTS)]
    rows += [(None, "null id", None, None, 5), (None, None, None, None, None), (3, "same id", 2, "y", 1), (3, "same id", 2, "y", 1),
             (500, None, 0, "", 0), (501, "long " * 9000, 0, "", 0)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.mark.parametrize("name", FILES)
def test_units_equal_the_library(spark, name):
    lib, enc = Tokenizer.from_file(tokenizer_path(name)), UnitEncoder(tokenizer_path(name))
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts:
        assert list(array("I", enc.encode(t))) == lib.encode(t, add_special_tokens=False).ids, t[:80]


@pytest.mark.parametrize("name", FILES)
def test_units_equal_the_library_on_any_text(name):
    lib, enc = Tokenizer.from_file(tokenizer_path(name)), UnitEncoder(tokenizer_path(name))

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.one_of(st.sampled_from(" \n\t'sStT<|>endoftx12é日̀ \x1c"), st.characters(codec="utf-8")), max_size=40))
    def check(t):
        assert list(array("I", enc.encode(t))) == lib.encode(t, add_special_tokens=False).ids
    check()


def test_generations_stay_bounded():
    g = Generations(lambda k: k * 2, limit=10)
    assert [g[i] for i in range(100)] == [i * 2 for i in range(100)]
    assert len(g) <= 10 and len(g.old) <= 10


def test_token_counts(spark, odd):
    lib = Tokenizer.from_file(tokenizer_path(FILES[0]))
    got = sorted(map(tuple, token_counts(odd, limit=50).collect()), key=str)
    want = []
    for r in odd.collect():
        t = r.text or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        want.append((r.doc_id, len(t.encode()), n, n > 50))
    assert got == sorted(want, key=str)
    assert token_counts(odd.limit(0)).count() == 0


def test_token_counts_of_a_sentencepiece_file(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    df = spark.createDataFrame([(1, "two words\n"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(df, "piece_bpe_32k.model").collect()}
    assert got == {1: len(sp.encode("two words\n")), 2: 0}


def test_token_files_round_trip(spark, odd):
    lib = Tokenizer.from_file(tokenizer_path(FILES[1]))
    folder = scratch_path(spark, "tests", "files")
    manifest = write_token_files(odd, folder, shards=4)
    got = sorted(read_token_files(spark, folder).collect(), key=lambda r: r.start)
    rows = odd.collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    want = {}
    for r in rows:
        ids = np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    have, at = {}, 0
    for r in got:
        assert r.start == at  # gapless
        at += r.n_tokens
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    ids, off, doc = map_shard(folder, manifest[0])
    assert isinstance(ids, np.memmap) and ids.dtype == np.uint16 and off.dtype == np.int64 and off[-1] == len(ids)
    empty = scratch_path(spark, "tests", "files")
    assert write_token_files(odd.limit(0), empty) == [] and read_token_files(spark, empty).count() == 0


def naive_sum_of_squares(lengths, capacity):
    bins, where = [], []
    for s in lengths:
        def total(fills):
            gaps = [capacity - f for f in fills if f < capacity]
            return sum(gaps.count(g) ** 2 for g in set(gaps))
        options = []
        for i, f in enumerate(bins):
            if f + s <= capacity:
                after = bins[:i] + [f + s] + bins[i + 1:]
                options.append((total(after), capacity - f - s, 0, f))
        new = (total(bins + [s]), capacity - s, 1, 0)
        best = min(options + [new], key=lambda o: (o[0], o[2], o[1]))
        if best[2]:
            bins.append(s)
            where.append((0, capacity))
        else:
            bins[bins.index(best[3])] += s
            where.append((best[3], best[1]))
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_sum_of_squares_rule(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 21, 60)
    got = sum_of_squares_pack(lengths, 20)
    fills = np.bincount(got, lengths)
    assert fills.max() <= 20 and sorted(fills.astype(int).tolist()) == naive_sum_of_squares(lengths.tolist(), 20)


def _check_packing(packed, capacity):
    seqs = {}
    for r in packed:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


@pytest.mark.parametrize("group_pieces", [4, 16_384])
def test_packing_of_odd_rows(spark, odd, group_pieces):
    lib = Tokenizer.from_file(tokenizer_path(FILES[0]))
    packed = pack(token_pieces(odd, capacity=64, with_ids=True), 64, group_pieces).collect()
    want = sorted((lib.encode(r.text or "", add_special_tokens=False).ids + [0] for r in odd.collect()))
    by = {}
    for r in sorted(packed, key=lambda r: (str(r.doc_id), r.piece, r.start)):
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        by.setdefault((r.doc_id, r.piece), []).append(r)
    # unique ids: the pieces put together are the document
    lengths = sorted(len(w) for w in want)
    assert sum(r.length for r in packed) == sum(lengths)
    for r in odd.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        if r.doc_id not in (None, 3):
            mine = [x for x in packed if x.doc_id == r.doc_id]
            mine.sort(key=lambda x: x.piece)
            assert sum((x.ids for x in mine), []) == ids
            assert len(mine) == -(-len(ids) // 64) and all(x.length == 64 for x in mine[1:])
            assert [x.start for x in mine] == list(np.cumsum([0] + [x.length for x in mine[:-1]]))
    n = _check_packing(packed, 64)
    total = sum(lengths)
    assert n <= -(-total // 64) + (2 if group_pieces > 1000 else 8)


def test_packing_an_empty_table(spark, odd):
    assert pack(token_pieces(odd.limit(0))).count() == 0


def test_packing_is_tight_and_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = pack(token_pieces(docs, with_ids=True))
    rows = packed.collect()
    n = _check_packing(rows, 2048)
    assert n <= 1.02 * sum(r.length for r in rows) / 2048 + 1
    seqs = {r.sequence_id: r for r in sequences(packed).collect()}
    assert len(seqs) == n
    for r in rows:
        assert seqs[r.sequence_id].ids[r.offset: r.offset + r.length] == r.ids


@pytest.mark.parametrize("low, high, group_pieces", [(700, 1200, 8), (300, 1900, 16), (20, 2047, 8), (900, 1148, 2)])
def test_sequences_of_groups_that_fit_together_are_merged(spark, low, high, group_pieces):
    rng = np.random.default_rng(5)
    rows = [(i, 0, 0, int(n), 0, i) for i, n in enumerate(rng.integers(low, high + 1, 800))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, slot long")
    packed = pack(pieces, 2048, group_pieces).collect()
    assert len(packed) == 800
    n = _check_packing(packed, 2048)
    totals = {}
    for r in packed:
        totals[r.sequence_id] = totals.get(r.sequence_id, 0) + r.length
    totals, pairs = sorted(totals.values()), 0
    while len(totals) > 1:
        if totals[0] + totals[-1] <= 2048:
            pairs += 1
            del totals[0]
        del totals[-1]
    assert pairs == 0
