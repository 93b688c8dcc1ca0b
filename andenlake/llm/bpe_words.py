"""Encoding of one white-space-separated chunk of text, and of whole texts through a table
of chunks. Used by the encoder and by the packer."""

from __future__ import annotations

import functools
import re
import struct
import unicodedata

import numpy as np

#: Characters at which Python's split() cuts but the tokenizer's pattern does not.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: Chunks a task remembers before it starts anew; keeps a worker's memory bounded.
CACHE = 300_000


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself
    where it prints, else the next free one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


class Remembered(dict):
    """key -> ``made(key)``, made on demand; starts anew beyond ``limit`` keys."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def made(self, key: str) -> bytes:
        raise NotImplementedError

    def __missing__(self, key: str) -> bytes:
        ids = self.made(key)
        if len(self) > self.limit:
            self.clear()
        self[key] = ids
        return ids


class WordTable(Remembered):
    """word (normalised, as cut) -> ids as little-endian uint32 bytes, by the merges."""

    def __init__(self, model, limit: int):
        super().__init__(limit)
        self.tokenize = model.tokenize
        self.letters = byte_letters()

    def made(self, key: str) -> bytes:
        mapped = key if key.isascii() and key.isprintable() else "".join(
            [self.letters[b] for b in key.encode()])
        ids = [t.id for t in self.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)


class ChunkTable(Remembered):
    """chunk -> ids as little-endian uint32 bytes, filled on demand.

    A chunk is normalised (NFC, lower case) and cut into words as the tokenizer
    does it; each distinct word is run through the merges once. Python's character tables and
    the tokenizer's differ in age, so a chunk that is not in NFC or holds a character on which
    they disagree goes through the tokenizer itself."""

    def __init__(self, path: str, limit: int = CACHE):
        import regex
        from tokenizers import Tokenizer
        super().__init__(limit)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.find_ascii = re.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+").findall
        self.words = WordTable(self.tokenizer.model, limit)
        self.alike: set[str] = set()
        self.apart: set[str] = set()

    def cut(self, chunk: str) -> bytes:
        """Ids of a chunk in NFC, or of any text in ASCII, by this table's own cuts."""
        if chunk.isascii():
            found = self.find_ascii(chunk.lower())
        else:
            found = self.find(chunk.lower() if "Σ" not in chunk
                              else "".join(c.lower() for c in chunk))
        return b"".join(map(self.words.__getitem__, found))

    def by_library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def agrees(self, c: str) -> bool:
        """Whether both sides cut alike around a character: alone, beside a letter, a digit and
        a sign, and before and after marks that would change places with a mark."""
        if c in self.alike or c in self.apart:
            return c in self.alike
        around = [c, f"a{c}a", f"1{c}1", f"-{c}-", f"a{c}\u0334", f"a\u0345{c}"]
        own = (self.cut(unicodedata.normalize("NFC", x)) for x in around)
        same = b"".join(own) == self.by_library(" ".join(around))
        (self.alike if same else self.apart).add(c)
        return same

    def made(self, key: str) -> bytes:
        own = key.isascii() or unicodedata.is_normalized("NFC", key) and (
            self.alike.issuperset(key) or all(map(self.agrees, key)))
        return self.cut(key) if own else self.by_library(key)

    def odd(self, text: str) -> bool:
        """Texts holding a special token's string, or rare control characters, are cut by
        the tokenizer itself."""
        return (any(s in text for s in self.special)
                or not text.isascii() and "᠎" in text
                or any(c in text for c in ODD_SPACE))

    def encode(self, text: str) -> bytes:
        """All ids of a text, as the tokenizer gives them without added special tokens."""
        if self.odd(text):
            return self.by_library(text)
        if text.isascii():  # one cut for all of it: no match goes over white space
            return self.cut(text)
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=1)
def chunk_table(path: str) -> ChunkTable:
    """The table of a Python worker: what one task has filled serves the tasks after it."""
    return ChunkTable(path)
