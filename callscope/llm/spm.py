"""SentencePiece encoding and decoding in one pass over an Aho-Corasick
automaton of the pieces.

The automaton reports, at every position, all pieces that end there (it
follows the output links), and each relaxes the best path to that position:

* unigram models: the path of the largest sum of piece scores;
* BPE models: a piece extends the path that ends where it begins if merging
  leaves that path's last piece and it apart. At every position exactly one
  piece does, the last one of the merged prefix, so the path is what
  merging the best-scored pair first would give.

Texts are cut where no piece can lie across (before a space after something
else), and at characters that no piece holds, which become byte pieces or
the unknown piece; ids of such units are kept in a bounded cache.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import tokenizer_path, worker_tool
from callscope.llm.tokens import Generations

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


class PieceModel:
    """A `.model` file with the identity normaliser."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normaliser are read")
        kinds = [p.type for p in proto.pieces]
        if USER_DEFINED in kinds:
            raise ValueError("models with user-defined pieces are not read")
        self.bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        self.dummy = norm.add_dummy_prefix
        self.unk = kinds.index(UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.fallback = len(self.bytes) == 256 and proto.trainer_spec.byte_fallback
        self.piece = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.chars = {c for p in self.ids for c in p}
        self.worst = min(self.score[i] for i in self.ids.values()) - 10.0
        # raw bytes of every piece, for decoding
        self.raw = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else
                    b"" if p.type == CONTROL else
                    " ⁇ ".encode() if p.type == UNKNOWN else
                    p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        self.apart = Generations(self._apart)
        stable = [(p, i) for p, i in self.ids.items() if not self.bpe or self.merge(p) == [i]]
        self.automaton = ahocorasick.Automaton()
        for p, i in stable:
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.unknown = re.compile("[^" + re.escape("".join(sorted({c for p, _ in stable if len(p) == 1 for c in p}))) + "]")
        self.units = Generations(self._unit)
        self.led = Generations(lambda u: self._unit(SPACE + u))

    def merge(self, text: str) -> list[int]:
        """Ids by merging the best-scored neighbouring pair, leftmost first,
        as long as any pair is a piece: the definition, used on short texts."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(self.score[i], -k) for k in range(len(parts) - 1)
                     if (i := self.ids.get(parts[k] + parts[k + 1])) is not None]
            if not pairs:
                break
            k = -max(pairs)[1]
            parts[k: k + 2] = [parts[k] + parts[k + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def _apart(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.piece[pair[0]] + self.piece[pair[1]]) == [pair[0], pair[1]]

    def _walk_bpe(self, s: str) -> list[int]:
        last: list = [None] * (len(s) + 1)
        last[0] = (-1, 0)
        apart = self.apart
        for end, (i, n) in self.automaton.iter(s):
            if last[end + 1] is None:
                before = last[end + 1 - n]
                if before is not None and (before[0] < 0 or apart[before[0], i]):
                    last[end + 1] = (i, end + 1 - n)
        return self._back(last, s)

    def _walk_unigram(self, s: str) -> list[int]:
        last: list = [None] * (len(s) + 1)
        best = [0.0] + [float("-inf")] * len(s)
        last[0] = (-1, 0)
        for end, (i, n) in self.automaton.iter(s):
            start = end + 1 - n
            if best[start] + self.score[i] > best[end + 1]:
                best[end + 1], last[end + 1] = best[start] + self.score[i], (i, start)
        return self._back(last, s)

    def _back(self, last: list, s: str) -> list[int]:
        out, at = [], len(s)
        while at:
            i, at = last[at]
            out.append(i)
        return out[::-1]

    def _stray(self, c: str) -> list[int]:
        return [self.bytes[b] for b in c.encode()] if self.fallback else [self.unk]

    def _unit(self, s: str) -> bytes:
        walk, out, at = self._walk_bpe if self.bpe else self._walk_unigram, [], 0
        for m in self.unknown.finditer(s):
            if m.start() > at:
                out += walk(s[at: m.start()])
            stray = self._stray(m.group())
            # neighbouring unknown characters are one unknown piece
            if not (stray == [self.unk] and out and out[-1] == self.unk and m.start() == at):
                out += stray
            at = m.end()
        if at < len(s):
            out += walk(s[at:])
        return array("i", out).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as packed 32-bit integers."""
        if not text:
            return b""
        if self.cuts and self.dummy and "  " not in text and text[0] != " " and SPACE not in text:
            return b"".join(map(self.led.__getitem__, text.split(" ")))
        s = (SPACE if self.dummy else "") + text.replace(" ", SPACE)
        if not self.cuts:
            return self._unit(s)
        return b"".join(map(self.units.__getitem__, re.split(f"(?<=[^{SPACE}])(?={SPACE})", s)))

    def decode(self, ids) -> str:
        """The text of ids; broken byte sequences give U+FFFD."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy and text[:1] == " " else text


def worker_model(name: str) -> PieceModel:
    """This Python worker's model."""
    return worker_tool(("pieces", name), lambda: PieceModel(name if os.sep in name else tokenizer_path(name)))


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), one row per input row, without begin and end
    ids. Null text counts as empty (no ids); other columns are not read."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        m = worker_model(model)
        for batch in batches:
            ids = [array("i", m.encode(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids give null."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        m = worker_model(model)
        for batch in batches:
            texts = [None if i is None else m.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encoding_digest(docs: DataFrame, model: str = "piece_bpe_32k.model", doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (unsigned, of the ids as little-endian
    32-bit integers), n_decoded (code points of the decoded text),
    round_trip (whether it equals the text; U+2581 in a text decodes as a
    space), one row per input row. Null text counts as empty; an empty
    table gives no rows; other columns are not read."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("n_decoded", pa.int64()), ("round_trip", pa.bool_())])

    def run(batches):
        m = worker_model(model)
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                packed = m.encode(t or "")
                ids = array("i", packed)
                back = m.decode(ids)
                rows.append((len(ids), zlib.crc32(packed), len(back), back == (t or "")))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, n_decoded long, round_trip boolean")
