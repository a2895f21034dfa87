"""Aligning the tokens of two tokenizers over the same text.

Both token sequences spell the same bytes, so each is a strictly ascending
array of byte ends. Byte places where both have an end cut the sequences into
groups. `align_ends` walks the two arrays along a diagonal: as long as the
ends at the current index shift are equal, tokens are one to one, and
exponential probing (windows that double while all their ends are equal; the
first difference in the last one) finds how far that goes. Where they part,
the group is closed by stepping whichever side is behind, which sets the new
shift.

Where neither tokenizer has a token that reaches over the space before a word,
both have an end there, so a word's groups are the same wherever it stands.
A worker then encodes and aligns each new word once, all new words of a slice
of documents as one sequence, and puts documents together from aligned words.
Other tokenizers get whole texts as their only word.

A link joins the two tokens that end together at the end of a group. How often
an id pair is linked in the whole corpus is counted by Spark; there are no more
pairs than (token, token that is a suffix of it) in the two vocabularies
(`pair_bound`), whatever the corpus, so the counts go to all tasks.

Texts that are null, empty, or that either tokenizer does not spell byte for
byte have no tokens: all figures 0 and an empty `groups_sha256`. Repeated rows
are aligned and counted each. Columns of the input other than its id and text
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialize, tokenizer_path, worker_tool
from callscope.llm.tokens import CUT, PLAIN, SPACE_LED, WIDE_SPACE, Generations, UnitEncoder, byte_alphabet

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
#: A pair of ids as one number: a * SHIFT + b.
SHIFT = 1 << 32
#: Longest word whose pieces are kept in a worker's cache, and its entries.
CACHED_CHARS = 64
CACHE_ENTRIES = 200_000
#: Number of tokens of a word that a tokenizer does not spell: outweighs any text.
UNSPELT = -(1 << 100)
#: Ends compared at once at the beginning of a stretch; text aligned at once.
FIRST_WINDOW = 4
SLICE_BYTES = 1 << 18


def align_ends(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The irregular groups (first and last token of side a, first and last of
    side b) of two strictly ascending int64 arrays of ends whose last ends are
    equal. Between them all tokens are one to one."""
    raw_a, raw_b, size = a.tobytes(), b.tobytes(), a.itemsize
    ends_a, ends_b = a.tolist(), b.tolist()
    stop = len(raw_a)
    out = []
    x = y = 0   # byte places of the current tokens: y - x is the shift
    while True:
        # one-to-one stretch: windows double while all their ends agree
        width = FIRST_WINDOW * size
        while x < stop:
            p, q = raw_a[x:x + width], raw_b[y:y + width]
            if p != q:
                # the lowest differing bit is in the first differing end
                least = min(len(p), len(q))
                differ = int.from_bytes(p[:least], "little") ^ int.from_bytes(q[:least], "little")
                same = ((differ & -differ).bit_length() - 1) // (8 * size) if differ else least // size
                x += same * size
                y += same * size
                break
            x += width
            y += width
            width *= 2
        if x >= stop:
            return out
        # irregular group: step the side that is behind until both meet
        i, j = first_a, first_b = x // size, y // size
        end_a, end_b = ends_a[i], ends_b[j]
        while end_a != end_b:
            if end_a < end_b:
                i += 1
                end_a = ends_a[i]
            else:
                j += 1
                end_b = ends_b[j]
        out.append((first_a, i, first_b, j))
        x, y = (i + 1) * size, (j + 1) * size


def last_tokens(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Index of the last token of every group of n tokens, where only the
    groups in `spans` (first, last) have several."""
    ends = np.ones(n, bool)
    for first, last in spans:
        ends[first:last] = False
    return np.flatnonzero(ends)


def bytes_of_a(path: str) -> list[bytes]:
    """Bytes of every id of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    value = {c: b for b, c in enumerate(byte_alphabet())}
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
    return out


def bytes_of_b(sp) -> list[bytes]:
    """Bytes of every id of a SentencePiece model."""
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs can be linked: tokens that end together spell the
    same bytes, so one of the two is a suffix of the other."""
    def suffixes(of: list[bytes], among: list[bytes], proper: int) -> int:
        known: dict[bytes, int] = {}
        for t in among:
            known[t] = known.get(t, 0) + 1
        return sum(known.get(t[k:], 0) for t in of for k in range(proper, len(t)))
    return suffixes(a, b, 0) + suffixes(b, a, 1)


class Words(Generations):
    """Aligned words by their text; long ones are not kept."""

    def __missing__(self, word):
        return super().__missing__(word) if len(word) <= CACHED_CHARS else self.make(word)


def ranked(path: str, tokens: list[bytes]):
    """A faster encoder of a byte-level file whose merges are in the order of
    their ids (None for others): the same merges with the same ranks."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = [model["vocab"].get("".join(p), -1) for p in pairs]
    if made != sorted(set(made)) or -1 in made or len(set(tokens)) < len(tokens):
        return None
    single = {i for i, t in enumerate(tokens) if len(t) == 1}
    ranks = {tokens[i]: i for i in (*single, *made)}
    return tiktoken.Encoding("ranked", pat_str=SPACE_LED, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers and a cache of aligned words."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        units = UnitEncoder(path_a)
        self.a = units.tok
        self.a.encode_special_tokens = True   # their strings are plain text here
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = bytes_of_a(path_a), bytes_of_b(self.b)
        self.len_a, self.len_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.by_word = units.kind == "space_led" and not any("▁" in p.lstrip("▁") for p in pieces)
        self.quick = ranked(path_a, self.bytes_a) if self.by_word else None
        #: ids of a space that ends a text
        self.space = self.b.encode("x ", num_threads=1)[len(self.b.encode("x", num_threads=1)):]
        self.fresh: dict = {}
        self.words = Words(lambda w: self.fresh.get(w) or self.align_words([w])[w], limit=CACHE_ENTRIES)

    def split(self, text: str) -> list[str]:
        """The words of a text with a space before it, each without its space."""
        if not self.by_word:
            return [text]
        if text[0] == " " or WIDE_SPACE.search(text):
            return [w[1:] for w in CUT.split(" " + text)]
        return text.split(" ")

    def ids_a(self, words: list[str]) -> list[list[int]]:
        if self.quick is None:
            return [e.ids for e in self.a.encode_batch([" " + w for w in words], add_special_tokens=False)]
        quick, plain = self.quick.encode_ordinary, PLAIN.fullmatch
        return [quick(" " + w) if plain(w) else self.a.encode(" " + w, add_special_tokens=False).ids for w in words]

    def ids_b(self, words: list[str]) -> list[list[int]]:
        ids = self.b.encode(words, num_threads=1)
        return [x if w else self.space for w, x in zip(words, ids)] if "" in words else ids

    def align_words(self, words: list[str]) -> dict[str, tuple[str, bytes, int]]:
        """By word: its groups as `a1,a2|b1;a3|b2,b3`, its linked pairs as
        packed int64, and n_a * SHIFT + n_b (negative: a tokenizer does not
        spell the word). The words are aligned as one sequence."""
        ids_a, ids_b, spelt = self.ids_a(words), self.ids_b(words), [b" " + w.encode() for w in words]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b))
        ends = np.cumsum(list(map(len, spelt)))
        stops_a, stops_b = np.cumsum(list(map(len, ids_a))), np.cumsum(list(map(len, ids_b)))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        text = b"".join(spelt)
        if not (len(a) and len(b) and ends_a[-1] == ends_b[-1] == len(text)
                and (ends_a[stops_a - 1] == ends).all() and (ends_b[stops_b - 1] == ends).all()
                and b"".join(map(self.bytes_a.__getitem__, a.tolist())) == text
                and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == text):
            if len(words) == 1:
                return {words[0]: ("", b"", UNSPELT)}
            half = len(words) // 2   # narrow down the words that are not spelt
            return self.align_words(words[:half]) | self.align_words(words[half:])
        odd = align_ends(ends_a, ends_b)
        last_a, last_b = last_tokens(len(a), [g[:2] for g in odd]), last_tokens(len(b), [g[2:] for g in odd])
        pairs = a[last_a] * SHIFT + b[last_b]
        texts = [f"{x}|{y}" for x, y in zip(a[last_a].tolist(), b[last_b].tolist())]
        for g, (i, x, j, y) in zip(np.searchsorted(last_a, [g[1] for g in odd]).tolist(), odd):
            texts[g] = f"{','.join(map(str, a[i:x + 1].tolist()))}|{','.join(map(str, b[j:y + 1].tolist()))}"
        stops = np.searchsorted(last_a, stops_a - 1, "right").tolist()
        packed, size = pairs.tobytes(), pairs.itemsize
        return {word: (";".join(texts[start:stop]), packed[start * size:stop * size], len(x) * SHIFT + len(y))
                for word, x, y, start, stop in zip(words, ids_a, ids_b, [0, *stops], stops)}

    def align(self, texts: list[str | None]) -> list[tuple[int, int, str, dict] | None]:
        """Numbers of tokens of both sides, the groups and the linked pairs
        with how often, of every text; None for one without tokens."""
        split = [self.split(t) if t else None for t in texts]
        new = set().union(*filter(None, split)).difference(self.words).difference(self.words.old)
        self.fresh = self.align_words(list(new)) if new else {}
        out = []
        for words in split:
            found = None
            if words:
                groups, pairs, sizes = zip(*map(self.words.__getitem__, words))
                total = sum(sizes)
                if total > 0:
                    found = total // SHIFT, total % SHIFT, ";".join(groups), Counter(np.frombuffer(b"".join(pairs), np.int64).tolist())
            out.append(found)
        return out


def _aligner(file_a: str, file_b: str) -> Aligner:
    def place(name: str) -> str:
        return name if os.sep in name else tokenizer_path(name)
    return worker_tool(("aligner", file_a, file_b), lambda: Aligner(place(file_a), place(file_b)))


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows whose texts are about SLICE_BYTES long together, so that
    a task never holds many long texts as tokens."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy()
    marks = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
    return list(zip([0, *marks.tolist()], [*marks.tolist(), len(sizes)]))


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<bigint>, times array<int>")


def aligned(docs: DataFrame, file_a: str = A_FILE, file_b: str = B_FILE) -> DataFrame:
    """One row per document: numbers of tokens and groups, the digest of its
    groups, and its linked id pairs with how often it holds each."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            tool = _aligner(file_a, file_b)
            texts = batch.column(1)
            for start, stop in slices(texts):
                out: list[list] = [[] for _ in schema]
                for doc_id, found in zip(batch.column(0)[start:stop].to_pylist(), tool.align(texts[start:stop].to_pylist())):
                    if found is None:
                        row = (doc_id, 0, 0, 0, "", [], [])
                    else:
                        n_a, n_b, groups, pairs = found
                        row = (doc_id, n_a, n_b, pairs.total(), hashlib.sha256(groups.encode()).hexdigest(),
                               np.fromiter(pairs.keys(), np.int64), np.fromiter(pairs.values(), np.int32))
                    for column, value in zip(out, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, count, best (its count is the highest of its B id): how often the
    corpus holds each id pair linked. Counts are combined in every task before
    they are shuffled."""
    counts = (rows.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs")
              .agg(F.sum("times").alias("count")).select(F.col("pairs").alias("pair"), "count"))
    counts = materialize(counts.withColumn("b", F.col("pair") % SHIFT), "pair-counts")
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def alignment(docs: DataFrame, file_a: str = A_FILE, file_b: str = B_FILE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The aligned rows are written once (numbers, not text); the pair counts,
    bounded by the vocabularies, are sent to all tasks, so no document is
    shuffled."""
    rows = materialize(aligned(docs, file_a, file_b), "aligned")
    table = pair_counts(rows).toArrow().sort_by("pair")
    pairs, counts, best = (table.column(i).to_numpy() for i in range(3))
    sent = rows.sparkSession.sparkContext.broadcast((pairs, counts.astype(np.int64), best.astype(np.int64)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def run(batches):
        known, count, top = sent.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(known, lists.flatten().to_numpy())
            lengths = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), lengths)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(3)]
            for total, values in zip(sums, (times, times * top[at], times * count[at])):
                np.add.at(total, row, values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_a"), batch.column("n_b"), batch.column("n_groups"),
                 *map(pa.array, sums), batch.column("groups_sha256")], schema=schema)

    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                "count_sum long, groups_sha256 string")
