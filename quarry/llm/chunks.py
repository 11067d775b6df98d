"""Whole-text byte-level BPE through a cache of word chunks.

A byte-level BPE pre-tokenizer always starts a new pre-token at a blank that
is followed by a non-blank character, and what stands left of that place does
not depend on what follows.  A text may therefore be cut there, and the parts
encoded one by one give the same ids as the whole text.  Parts repeat, so
their encodings are looked up in two tiers: a read-only table of frequent
parts shipped to every worker, then a bounded cache of the worker itself.
The one exception is an added special string inside a text: such (rare) texts
are encoded whole by the library, because the library cuts them differently.
"""

from __future__ import annotations

import re
import string
import sys
from array import array
from codecs import charmap_decode
from functools import lru_cache

_ODD_BLANKS = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
_LINE_END = re.compile(r"(?<=\S)\n(?=\S)")

# The byte-level alphabet: printable bytes stand for themselves, the others
# follow from U+0100 on (the public rule of byte-level BPE).
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}

_BYTE_TABLE = "".join(chr(b) if b in _PLAIN else _BYTE_CHARS[b] for b in range(256))

_MARKS = string.punctuation.replace("'", "")  # of a run of these after letters; an apostrophe may begin a contraction

CACHE_ENTRIES = 800_000  # per worker and table (some 200 MB in all), unless the caller sets less; the whole worker tier is dropped when it is full
CACHED_CHARS = 64  # longer parts are encoded each time


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_chars(part: str) -> str:
    """A part's UTF-8 bytes in the byte-level alphabet; for parts of letters and
    other printable characters, since ASCII is passed on as it is."""
    return part if part.isascii() else charmap_decode(part.encode(), "strict", _BYTE_TABLE)[0]


def split_chunks(text: str) -> list[str]:
    """Parts of a text; every part but the first stands for blank + part."""
    return _CUT.split(text) if _ODD_BLANKS.search(text) else text.split(" ")


def is_byte_level(tokenizer) -> bool:
    from tokenizers.pre_tokenizers import ByteLevel

    pre = tokenizer.pre_tokenizer
    return tokenizer.normalizer is None and isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space


class ChunkTable(dict):
    """part -> encoding; misses are encoded by the library and kept."""

    def __init__(self, tokenizer, encode, join, frequent=None, first: ChunkTable | None = None, cached: int | None = None):
        super().__init__(frequent or {})
        self.tokenizer, self.encode, self.join, self.frequent = tokenizer, encode, join, frequent or {}
        self.cached = CACHE_ENTRIES if cached is None else cached
        self.prefix = "" if first is None else " "
        self.first = self if first is None else first
        self.model, self.blank = tokenizer.model, "" if first is None else _BYTE_CHARS[32]

    def __missing__(self, part):
        # two more places where a new pre-token always starts: a line end between
        # words, and a run of punctuation marks after letters
        lines = _LINE_END.split(part) if "\n" in part else ()
        if len(lines) > 1:  # a loop: a part may have any number of lines
            values = [self[lines[0]]]
            for line in lines[1:]:
                values += self.first["\n"], self.first[line]
            return self.join(values)
        if part.isalpha():  # one pre-token: the library's merges alone
            value = self.encode([t.id for t in self.model.tokenize(self.blank + byte_chars(part))])
        elif (word := part.rstrip(_MARKS)) != part and word.isalpha():
            value = self[word] + self.first[part[len(word):]]
        else:
            value = self.encode(self.tokenizer.encode(self.prefix + part, add_special_tokens=False).ids)
        if len(part) <= CACHED_CHARS:
            if len(self) >= self.cached + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[part] = value
        return value


class ChunkEncoder:
    """Encodes whole texts; ``encode`` maps one part's ids to a value and
    ``join`` combines the values of a text; ``cached``: parts that each tier keeps."""

    def __init__(self, path: str, encode, join, frequent=None, cached: int | None = None):
        self.tokenizer = load_tokenizer(path)
        self.encode, self.join = encode, join
        self.cut = is_byte_level(self.tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = ChunkTable(self.tokenizer, encode, join, cached=cached)
        self.rest = ChunkTable(self.tokenizer, encode, join, frequent, self.first, cached)

    def __call__(self, text: str | None):
        if not text:
            return self.join([])
        if not self.cut or any(s in text for s in self.special):
            return self.join([self.encode(self.tokenizer.encode(text, add_special_tokens=False).ids)])
        parts = split_chunks(text)
        values = [self.first[parts[0]]]
        values.extend(map(self.rest.__getitem__, parts[1:]))
        return self.join(values)


@lru_cache(maxsize=2)
def counting_encoder(path: str, table) -> ChunkEncoder:
    """Text -> number of tokens.  One per worker and broadcast table, so that
    later tasks find the cache warm."""
    return ChunkEncoder(path, len, sum, table.value)


@lru_cache(maxsize=2)
def id_encoder(path: str, dtype: str, cached: int | None = None) -> ChunkEncoder:
    """Text -> bytes of its ids.  One per worker, see above."""
    kind = {"<u2": "H", "<u4": "I"}[dtype]  # array() is faster than NumPy for a few ids
    swap = sys.byteorder != "little"

    def pack(ids: list[int]) -> bytes:
        a = array(kind, ids)
        if swap:
            a.byteswap()
        return a.tobytes()

    return ChunkEncoder(path, pack, b"".join, cached=cached)
