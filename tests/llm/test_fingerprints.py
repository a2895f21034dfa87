"""Fingerprints against texts put together by hand."""

import hashlib

import pytest

from callscope.llm import fingerprints as fp

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Rows (doc_id, text) of distinct ids, from scratch."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + after[:k]
        a, b, c = map(fp.fingerprint_set, (t, edited, after))
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), fp.to_text(a), fp.to_text(b),
                  fp.containment(a, b), fp.containment(a, c))
    return out


@pytest.mark.parametrize("buckets", [1, 7, None])
def test_fingerprints_equal_brute_force(spark, buckets):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in fp.fingerprints(docs, buckets=buckets).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    rows = [(5, "é" * 400 + "z" * 100, "a", 1), (9, "", None, 2), (7, None, "b", None), (-3, "x" * 70_000, "c", 3), (2**60, "tiny", "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tie string, b int")
    got = {r[0]: tuple(r)[1:] for r in fp.fingerprints(docs).collect()}
    assert got == brute([(r[0], r[1]) for r in rows])
    assert got[9][4] == 1.0  # empty in empty
    one = fp.fingerprints(docs.filter("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fp.fingerprints(docs.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, f"null {i} " * 50) for i in range(40)] + [(1, "same " * 40)] * 3 + [(0, "other " * 60), (2, "more " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = fp.fingerprints(docs).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r.doc_id == 1]
    assert len({r.fingerprint for r in same}) == 1 and sorted(r.near_next for r in same)[1:] == [1.0, 1.0]


def test_chunks():
    import random
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ij\n") for _ in range(20_000)).encode()
    ends = fp.chunk_ends(text)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(text) and all(fp.MIN <= s <= fp.MAX for s in sizes[:-1])
    # an insertion moves the chunks around it only
    other = text[:9_000] + b"inserted" + text[9_000:]
    a, b = (fp._chunks(t, fp.chunk_ends(t)) for t in (text, other))
    assert fp.containment(a, b) > 0.97
    # chunking from a cut goes on as from the start
    assert fp.chunk_ends(text, ends[20]) == ends[21:]
    assert fp.from_text(fp.to_text(a)) == a
    h, brute_h = fp.gear_hash(text[:100]), 0
    for i, byte in enumerate(text[:100]):
        brute_h = ((brute_h << 1) + int(fp.GEAR[byte])) & 0xFFFF
        assert h[i] == brute_h
