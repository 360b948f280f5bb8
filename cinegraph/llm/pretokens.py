"""Byte-level BPE of batches of texts on arrays: split, look up, merge what is new.

The split of byte-level vocabularies of the GPT-2 family is decided byte by byte from
character classes, so the pre-tokens of all texts of a batch are found at once.  One of at
most 16 bytes is known by these bytes themselves (two words, no hash to collide), and an
open-addressing table holds its token ids; the pre-tokens of a batch that are not there
yet are merged together (``bulk_bpe``).  Longer ones go through a dictionary.  Texts with
characters outside the classes, or with a special token's string, go to ``bpe`` as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from .bpe import _LETTERS, encoder
from .bulk_bpe import Merger

_LETTER, _DIGIT, _SPACE, _BLANK, _MARK, _ODD = range(6)
_SLICE = 1_000_000         # bytes of texts handled at once

_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x80:0xC0] = _LETTER            # second bytes
_CLASS[0xC3:0xC9] = _LETTER            # U+00C0 to U+023F, but for two signs
_CLASS[0x20] = _SPACE
_CLASS[[0x09, 0x0A, 0x0D]] = _BLANK

_LOW = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1] * 9, np.uint64)            # of the first 8 bytes
_HIGH = np.array([0] * 9 + [(1 << 8 * n) - 1 for n in range(1, 8)] + [2**64 - 1], np.uint64)  # of the next


def classes(data: np.ndarray) -> np.ndarray:
    kind = _CLASS[data]
    sign = np.flatnonzero((data[1:] == 0x97) | (data[1:] == 0xB7))         # multiplication and division
    kind[sign[data[sign] == 0xC3]] = _ODD
    return kind


def starts(data: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start; ``first`` are the starts of the (non-empty) texts."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[first] = begins[n] = True
    blank = (kind == _SPACE) | (kind == _BLANK)
    at = np.zeros(n, bool)
    at[1:] = kind[1:] != kind[:-1]
    # blanks are one run; its last one, if text follows, starts anew, and a space goes to that text
    at[1:] &= ~(blank[1:] & blank[:-1])
    at[1:] &= ~(~blank[1:] & (kind[:-1] == _SPACE))
    at[:-1] |= blank[:-1] & ~blank[1:] & ~begins[1:n]
    at |= begins[:n]
    # contractions: an apostrophe that starts a pre-token, and some letters
    for i in np.flatnonzero((data == 0x27) & at).tolist():
        if i + 1 < n and not begins[i + 1]:
            size = 2 if data[i + 1] in b"stmd" else 0
            if i + 2 < n and not begins[i + 2] and bytes(data[i + 1:i + 3]) in (b"re", b"ve", b"ll"):
                size = 3
            if size:
                at[i + 1:i + size] = False
                if i + size < n:
                    # a space after it still starts, and goes to what follows
                    at[i + size] = True
    return np.flatnonzero(at)


#: a place where a text can be cut: the space goes to what follows, whatever stands around
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _parts(text: str) -> Iterator[str]:
    """A very long text in parts of about ``_SLICE`` characters that are split alike."""
    lo = 0
    while lo < len(text):
        cut = _CUT.search(text, lo + _SLICE)
        hi = cut.start() if cut else len(text)
        yield text[lo:hi]
        lo = hi


class PreTokens:
    """Token ids of texts, through a table of at most ``most`` pre-tokens that starts anew
    when it is full.  ``known`` pre-tokens are in it from the start, as one token each."""

    def __init__(self, path: str, most: int, known: Iterable[str] = ()):
        self.path = path
        self.merger = Merger(path, _LETTERS)
        self.special = [s.encode() for s in self.merger.special]
        self.most, self.known = most, [k.encode() for k in known]
        self._clear()

    @property
    def whole(self):
        """The library's way, loaded when a text needs it."""
        return encoder(self.path, min(self.most, 100_000))

    def _room(self, size: int) -> None:
        self.size, self.used = size, 0
        self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.entry = np.full(size, -1, np.int32)

    def _clear(self) -> None:
        self._room(1 << (2 * self.most).bit_length())
        self.longer: dict[bytes, int] = {}
        self.begin, self.count, self.held = np.zeros(1024, np.int64), np.zeros(1024, np.int32), 0
        self.ids, self.filled = np.zeros(4096, np.int32), 0
        if self.known:
            zero = [np.zeros(1, np.int32)] * len(self.known)
            entry = self._keep(zero)
            data = np.frombuffer(b"".join(self.known) + bytes(16), np.uint8)
            size = np.fromiter(map(len, self.known), np.int64, len(self.known))
            short = size <= 16
            low, high = self._keys(data, (np.cumsum(size) - size)[short], size[short])
            self._insert(low, high, entry[short])
            self.longer |= {self.known[i]: int(entry[i]) for i in np.flatnonzero(~short)}

    @staticmethod
    def _keys(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of short pre-tokens; ``data`` has 16 bytes to spare."""
        words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
        return words[at] & _LOW[size], words[np.minimum(at + 8, len(words) - 1)] & _HIGH[size]

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h >> np.uint64(24)) & np.uint64(self.size - 1)).view(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        slot, found, left = self._slot(low, high), np.full(len(low), -1, np.int32), np.arange(len(low))
        while len(left):
            entry = self.entry[slot]
            hit = (entry >= 0) & (self.low[slot] == low[left]) & (self.high[slot] == high[left])
            found[left[hit]] = entry[hit]
            on = ~hit & (entry >= 0)
            left, slot = left[on], (slot[on] + 1) & (self.size - 1)
        return found

    def _insert(self, low: np.ndarray, high: np.ndarray, entry: np.ndarray) -> None:
        """Different keys that are not in the table."""
        while 10 * (self.used + len(low)) > 7 * self.size:             # a slice of very many new ones
            full = self.entry >= 0
            old = self.low[full], self.high[full], self.entry[full]
            self._room(2 * self.size)
            self._insert(*old)
        self.used += len(low)
        slot, left = self._slot(low, high), np.arange(len(low))
        while len(left):
            one = np.zeros(len(left), bool)
            one[np.unique(slot, return_index=True)[1]] = True
            put = one & (self.entry[slot] < 0)
            at = slot[put]
            self.low[at], self.high[at], self.entry[at] = low[left[put]], high[left[put]], entry[left[put]]
            left, slot = left[~put], (slot[~put] + 1) & (self.size - 1)

    def _keep(self, ids: list[np.ndarray]) -> np.ndarray:
        """New entries for these ids."""
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        while len(self.begin) < self.held + len(ids):
            self.begin, self.count = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.count, 2 * len(self.count))
        while len(self.ids) < self.filled + len(flat):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        new = slice(self.held, self.held + len(ids))
        self.begin[new], self.count[new] = self.filled + np.cumsum(count) - count, count
        self.ids[self.filled:self.filled + len(flat)] = flat
        self.held, self.filled = new.stop, self.filled + len(flat)
        return np.arange(new.start, new.stop, dtype=np.int32)

    def _entries(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of every pre-token; those not known yet are merged and kept."""
        short = size <= 16
        low, high = self._keys(data, at[short], size[short])
        entry, found = np.empty(len(at), np.int32), self._find(low, high)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = new[np.lexsort((low[new], high[new]))]
            first = np.concatenate(([True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])))
            one = order[first]
            where, length = at[short][one].tolist(), size[short][one].tolist()
            view = memoryview(data)
            made = self._keep(self.merger([bytes(view[a:a + n]) for a, n in zip(where, length, strict=True)]))
            self._insert(low[one], high[one], made)
            found[order] = made[np.cumsum(first) - 1]
        entry[short] = found
        long = np.flatnonzero(~short).tolist()
        if long:
            view = memoryview(data)
            words = [bytes(view[a:a + n]) for a, n in zip(at[long].tolist(), size[long].tolist(), strict=True)]
            fresh = [w for w in dict.fromkeys(words) if w not in self.longer]
            # a run of hundreds of bytes would make one long row of merges: the library takes it
            usual = [w for w in fresh if len(w) <= 64]
            ids = dict(zip(usual, self.merger(usual), strict=True)) | {w: self._by_library(w) for w in fresh if len(w) > 64}
            self.longer |= dict(zip(fresh, self._keep([ids[w] for w in fresh]).tolist(), strict=True))
            entry[long] = [self.longer[w] for w in words]
        return entry

    def _by_library(self, word: bytes) -> np.ndarray:
        return np.array([t.id for t in self.whole.model.tokenize("".join(_LETTERS[b] for b in word))], np.int32)

    def _slices(self, column: pa.Array) -> Iterator[tuple[int, int]]:
        """Ranges of texts of about ``_SLICE`` bytes."""
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + _SLICE, "right")) - 1)
            yield lo, min(hi, len(column))
            lo = min(hi, len(column))

    def batches(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, counts, ids) for ranges of the texts of a string column; null is empty."""
        if not isinstance(column, pa.StringArray):
            column = column.cast(pa.string())
        if column.null_count:
            column = column.fill_null("")
        for lo, hi in self._slices(column) if len(column) else ():
            some = column.slice(lo, hi - lo)
            if hi - lo == 1 and len(some[0].as_py()) > _SLICE:
                parts = [self._encode(pa.array([part])) for part in _parts(some[0].as_py())]
                yield lo, hi, sum(n for n, _ in parts), np.concatenate([ids for _, ids in parts])
            else:
                yield lo, hi, *self._encode(some)

    def _encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        n, data = len(raw), np.concatenate((raw, np.zeros(16, np.uint8)))
        if self.held + len(self.longer) > self.most:
            self._clear()
        kind = classes(data[:n])
        apart = np.zeros(len(texts), bool)
        strange = [np.flatnonzero(kind == _ODD)]
        held = data[:n].tobytes()
        for s in self.special:
            found, spots = held.find(s), []
            while found >= 0:
                spots.append(found)
                found = held.find(s, found + 1)
            strange.append(np.array(spots, np.int64))
        apart[np.searchsorted(offsets, np.concatenate(strange), "right") - 1] = True
        if not self.merger.usable:
            apart[:] = True
        begin = starts(data[:n], kind, offsets[:-1][offsets[1:] > offsets[:-1]])
        size = np.diff(np.append(begin, n))
        of = np.searchsorted(offsets, begin, "right") - 1
        plain = ~apart[of]
        begin, size, of = begin[plain], size[plain], of[plain]
        entry = self._entries(data, begin, size)
        if apart.any():
            # these texts stand as one entry of their own each, for this batch only
            held, filled = self.held, self.filled
            where = np.flatnonzero(apart)
            ids = [np.frombuffer(self.whole(texts[int(i)].as_py()), "<u4").astype(np.int32) for i in where]
            entry, of = np.concatenate((entry, self._keep(ids))), np.concatenate((of, where))
            order = np.argsort(of, kind="stable")
            entry, of = entry[order], of[order]
            self.held, self.filled = held, filled
        count = self.count[entry].astype(np.int64)
        per_text = np.bincount(of, weights=count, minlength=len(texts)).astype(np.int64)
        total = int(count.sum())
        shift = self.begin[entry] - (np.cumsum(count) - count)
        return per_text, self.ids[np.repeat(shift, count) + np.arange(total)]


#: tables of this Python worker process; later tasks in it go on with them
_TABLES: dict[tuple, PreTokens] = {}


def pre_tokens(path: str, most: int = 1_000_000, known: Iterable[str] = ()) -> PreTokens:
    key = (path, most, bool(known))
    if key not in _TABLES:
        _TABLES[key] = PreTokens(path, most, known)
    return _TABLES[key]
