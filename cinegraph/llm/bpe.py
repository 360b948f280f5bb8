"""Byte-level BPE of whole texts, each distinct piece encoded once.

The tokenizers library is exact but spends most of its time splitting long texts.  Its
split never joins characters over a space that a non-space character follows, except
that this space goes to what follows.  So a text is the concatenation of its *pieces*,
cut before every such space, and its tokens are the pieces' tokens.  A new piece is cut
into pre-tokens by the vocabulary's own pattern and each new pre-token goes to the
library's BPE model; both are kept in bounded tables.  Pieces with characters outside
the range on which pattern and library were compared (``PLAIN``) go to the library as
they are, and a text that holds a special token's string goes there whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the split pattern of byte-level vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: characters on which PATTERN and the library's split were compared one by one
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ]*")

#: white space in front, at the end or after a space: such texts are cut by pattern
_ODD = re.compile(r"^\s| \s| $")
_CUT = re.compile(r" (?=\S)")
_PRE_TOKENS = regex.compile(PATTERN).findall
_MARKS = frozenset(".,;:!?")


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = (chr(256 + i) for i in range(256 - len(own)))
    return [chr(b) if b in own else next(rest) for b in range(256)]


_LETTERS = dict(enumerate(byte_letters()))
_BYTES = {ord(c): b for b, c in _LETTERS.items()}


def letters(piece: str) -> str:
    """A piece of text as the vocabulary spells it."""
    return piece.encode("utf-8").decode("latin-1").translate(_LETTERS)


def spelled(token: str) -> bytes:
    """The bytes that a vocabulary string stands for."""
    return token.translate(_BYTES).encode("latin-1")


def load(path: str):
    """The library's tokenizer, from a file that is on every executor."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def special_strings(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


class Pieces(dict):
    """What ``value`` makes of the ids of " " + key, by key; ``bare`` has it for pieces
    and pre-tokens that no space precedes.  Both go back to what was ``known`` ahead when
    they hold ``most`` keys."""

    def __init__(self, path: str, value: Callable, join: Callable, known: dict | None = None, most: int = 1_000_000):
        super().__init__()
        self.value, self.join, self.most = value, join, most
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.special = special_strings(self.tokenizer)
        known = known or {}
        self.known = {k[1:]: v for k, v in known.items() if k[0] == " " and len(k) > 1}
        self.known_bare = {k: v for k, v in known.items() if k[0] != " " or len(k) == 1}
        self.bare = dict(self.known_bare)
        self.update(self.known)

    def __missing__(self, key: str):
        if key[-1:] in _MARKS and key[:-1].isalpha():
            # a word and a mark: not kept, so that the table is left to the words
            return self.join((self[key[:-1]], self.without_space(key[-1])))
        value = self.merge(" " + key) if key.isalpha() and PLAIN.fullmatch(key) else self.cut(" " + key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
                self.update(self.known)
            self[key] = value
        return value

    def without_space(self, word: str):
        value = self.bare.get(word)
        if value is None:
            value = self.merge(word)
            if len(word) <= 64:
                if len(self.bare) >= self.most:
                    self.bare = dict(self.known_bare)
                self.bare[word] = value
        return value

    def cut(self, piece: str):
        """A piece by its pre-tokens."""
        if not PLAIN.fullmatch(piece):
            return self.whole(piece)
        parts = _PRE_TOKENS(piece)
        if len(parts) == 1:
            return self.merge(piece)
        return self.join([self[p[1:]] if p[0] == " " and len(p) > 1 and p[1] != " " else self.without_space(p)
                          for p in parts])

    def merge(self, word: str):
        """One pre-token through the library's BPE model."""
        return self.value([t.id for t in self.model.tokenize(letters(word))])

    def whole(self, text: str):
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str):
        for s in self.special:
            if s in text:
                return self.whole(text)
        if not text:
            return self.join([])
        if _ODD.search(text):
            first, *rest = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
        return self.join([self.cut(first) if first else self.join([]), *map(self.__getitem__, rest)])


def _id_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


#: tables of this Python worker process; later tasks in it go on with them
_TABLES: dict[tuple, Pieces] = {}


def encoder(path: str, most: int = 1_000_000) -> Pieces:
    """Text to its ids, as little-endian unsigned 32-bit bytes."""
    if ("ids", path, most) not in _TABLES:
        _TABLES["ids", path, most] = Pieces(path, _id_bytes, b"".join, most=most)
    return _TABLES["ids", path, most]


def counter(path: str, known: Iterable[str]) -> Pieces:
    """Text to its number of tokens; ``known`` pre-tokens count one without merging."""
    if ("count", path) not in _TABLES:
        _TABLES["count", path] = Pieces(path, len, sum, dict.fromkeys(known, 1))
    return _TABLES["count", path]


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings that, alone as a text, are one pre-token and one token:
    each is encoded once, ahead of any data.  A string that the merge rules cannot
    reach, that is split, or that is no whole UTF-8 text is left out."""
    tokenizer = load(path)
    special, found = set(special_strings(tokenizer)), []
    for token in tokenizer.get_vocab():
        if token in special or not all(ord(c) in _BYTES for c in token):
            continue
        try:
            text = spelled(token).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if PLAIN.fullmatch(text) and len(tokenizer.encode(text, add_special_tokens=False).ids) == 1:
            found.append(text)
    return sorted(found)
