"""Token ids of whole texts by the tokenizers library, through caches of units.

A *unit* is a stretch of text whose ids depend on nothing outside it, so
ids of a text are the ids of its units put together:

* space-led files (byte-level, the split pattern lets a word take one space
  before it): a text is cut before every space that follows a character
  other than white space. No match of the pattern crosses such a cut.
* space-dropping files (a normaliser and a pattern that never matches white
  space): a text is cut at white space.
* any other file: the whole text is one unit.

Common words come from a worker's cache, the rest from the library's own
BPE model. Special strings hold no white space; a unit that could hold one,
or any character outside the well-known Latin range, is given to the whole
library pipeline, so results equal the library's for every text.
"""

from __future__ import annotations

import json
import os
import re
from array import array

#: Characters on which the library and Python agree for sure about letters,
#: numbers, lower case and composition: ASCII but for controls, Latin-1 and
#: Latin Extended-A, without U+0130 (lower case of two characters).
PLAIN = re.compile("[\n\t\x20-\x7e¡-įı-ſ]*")
SPACE_LED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_DROPPED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WIDE_SPACE = re.compile(r"\s ")
CUT = re.compile(r"(?<=\S)(?= )")
SEPARATORS = re.compile("[\x1c-\x1f]")
CACHE_ENTRIES = 300_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level files:
    printable Latin-1 bytes stand for themselves, the others are numbered
    from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Generations(dict):
    """A bounded cache read at C speed: a full generation becomes the old
    one, from which entries in use move over again."""

    def __init__(self, make, limit: int = CACHE_ENTRIES, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.make, self.limit, self.fixed = make, limit + len(fixed or {}), dict(fixed or {})
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
        self[key] = value
        return value


class UnitEncoder:
    """Ids of whole texts, as the library gives them without added begin or
    end tokens; special strings inside a text are the library's special ids."""

    def __init__(self, path: str, item: str = "I"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.item = item
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        plain_added = all(not t["single_word"] and not t["lstrip"] and not t["rstrip"] and not t["normalized"]
                          and not re.search(r"\s", t["content"]) for t in spec.get("added_tokens", []))
        self.kind = "whole"
        if plain_added and norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") \
                and not pre.get("add_prefix_space"):
            self.kind, self.pattern, self.lower = "space_led", regex.compile(SPACE_LED), False
        elif plain_added and self._drops_space(norm, pre):
            self.kind, self.pattern, self.lower = "space_dropped", regex.compile(SPACE_DROPPED), True
        self.table = {c: "".join(byte_alphabet()[b] for b in chr(c).encode()) for c in range(0x180)}
        self.first = Generations(self._pack_first)
        self.cache = Generations(self._pack_led if self.kind == "space_led" else self._pack_first)

    @staticmethod
    def _drops_space(norm, pre) -> bool:
        steps = pre.get("pretokenizers") or [{}]
        return ([n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
                and len(steps) == 2 and steps[0].get("pattern", {}).get("Regex") == SPACE_DROPPED
                and steps[0].get("invert") and steps[1].get("type") == "ByteLevel"
                and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"))

    def ids(self, unit: str) -> list[int]:
        """Ids of one unit."""
        if self.kind == "whole" or not PLAIN.fullmatch(unit) or any(s in unit for s in self.special):
            return self.tok.encode(unit, add_special_tokens=False).ids
        bpe, table = self.tok.model.tokenize, self.table
        return [t.id for p in self.pattern.findall(unit.lower() if self.lower else unit)
                for t in bpe(p.translate(table))]

    def _pack_first(self, unit: str) -> bytes:
        return array(self.item, self.ids(unit)).tobytes()

    def _pack_led(self, unit: str) -> bytes:
        return array(self.item, self.ids(" " + unit)).tobytes()

    def units(self, text: str) -> tuple[str | None, list[str]]:
        """First unit, then the others (space-led ones without their space)."""
        if self.kind == "space_led":
            if WIDE_SPACE.search(text):
                first, *rest = CUT.split(text)
                return first, [u[1:] for u in rest]
            first, *rest = text.split(" ")
            return first, rest
        if self.kind == "space_dropped":
            # Python's own white space also holds four separators
            return None, re.split("[ \t\r\n]+", text) if SEPARATORS.search(text) else text.split()
        return text, []

    def encode(self, text: str) -> bytes:
        """All ids of a text, packed little-endian as `item` integers."""
        first, rest = self.units(text)
        packed = b"".join(map(self.cache.__getitem__, rest))
        return packed if first is None or not first else self.first[first] + packed


class UnitLengths:
    """Number of ids of whole texts: a fixed table of frequent units, then a
    bounded cache of this worker, then the library."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        self.enc = UnitEncoder(path)
        led = " " if self.enc.kind == "space_led" else ""
        self.first = Generations(lambda u: len(self.enc.ids(u)))
        self.cache = Generations(lambda u: len(self.enc.ids(led + u)), fixed=frequent)

    def count(self, text: str) -> int:
        first, rest = self.enc.units(text)
        return sum(map(self.cache.__getitem__, rest)) + (self.first[first] if first else 0)


def worker_encoder(path_name: str, item: str) -> UnitEncoder:
    """This Python worker's encoder of a tokenizer file (public name or path)."""
    from callscope.llm.common import tokenizer_path, worker_tool
    return worker_tool(("encoder", path_name, item), lambda: UnitEncoder(
        path_name if os.sep in path_name else tokenizer_path(path_name), item))
