"""Byte-pair merging of many words at once.

The words of one length are the rows of a matrix of token ids.  A round merges, in every
row, the leftmost pair of least rank, as the library's queue does one by one; rows
without a pair that merges are done.  Ranks come from an open-addressing table of the
vocabulary's merges, probed for whole columns.
"""

from __future__ import annotations

import json

import numpy as np

_NONE = np.int32(2**31 - 1)
_ROWS = 20_000             # words merged at once: their matrices stay in the cache


class Merger:
    """The merges of a byte-level vocabulary file.  ``usable`` is false where the file asks
    for more than plain merging by rank, or where a merge could outrank the one that made
    its part: then words go to the library."""

    def __init__(self, path: str, letters: dict[int, str]):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, self.special = file["model"], [t["content"] for t in file.get("added_tokens") or []]
        vocab = model.get("vocab", {})
        plain = model.get("type") == "BPE" and not any(
            model.get(c) for c in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                   "byte_fallback", "ignore_merges"))
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(merges):
            plain = plain and all(x in vocab and (len(x) == 1 or made.get(x, rank) < rank) for x in (a, b)) and a + b in vocab
            made.setdefault(a + b, rank)
        self.usable = bool(plain and isinstance(vocab, dict) and all(c in vocab for c in letters.values()))
        if self.usable:
            self.letter = np.array([vocab[letters[b]] for b in range(256)], np.int32)
            self._table(np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int64).reshape(-1, 3))

    def _table(self, merges: np.ndarray) -> None:
        """Slots for pair keys; a key lies at most ``probes`` slots after its own."""
        size = 1 << max(4, int(4 * len(merges)).bit_length())
        self.mask = np.int64(size - 1)
        keys = (merges[:, 0] << 32) | merges[:, 1]
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, _NONE, np.int32)
        self.joined = np.zeros(size, np.int32)
        slot, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            at = (slot[left] + self.probes) & self.mask
            free = self.keys[at] == -1
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True          # of several keys for a slot, one
            put = free & first
            self.keys[at[put]], self.ranks[at[put]] = keys[left[put]], left[put]
            self.joined[at[put]] = merges[left[put], 2]
            left, self.probes = left[~put], self.probes + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(40)).view(np.int64) & self.mask

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined token) of pairs; the highest rank where they do not merge."""
        keys = (a.astype(np.int64) << 32) | b
        slot = self._slot(keys)
        rank, joined = np.full(keys.shape, _NONE, np.int32), np.zeros(keys.shape, np.int32)
        left = np.arange(keys.size)
        for probe in range(self.probes):
            at = (slot[left] + probe) & self.mask
            held = self.keys[at]
            hit = held == keys[left]
            rank[left[hit]], joined[left[hit]] = self.ranks[at[hit]], self.joined[at[hit]]
            left = left[~hit & (held != -1)]                           # an empty slot ends the search
            if not len(left):
                break
        return rank, joined

    def _merge(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the rows, and how many each row has left."""
        n, length = ids.shape
        out, count = ids.copy(), np.full(n, length)
        row = np.arange(n)
        rank, joined = (x.reshape(n, length - 1) for x in self._look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel()))
        while length > 1 and len(row):
            at = rank.argmin(axis=1)
            own = np.arange(len(row))
            more = rank[own, at] != _NONE
            if not more.all():
                done = ~more
                out[row[done], :length], count[row[done]] = ids[done], length
                ids, rank, joined, row, at = ids[more], rank[more], joined[more], row[more], at[more]
                own = np.arange(len(row))
                if not len(row):
                    break
            ids[own, at] = joined[own, at]
            # close the gap after the merged token
            keep = np.arange(length - 1) + (np.arange(length - 1) > at[:, None])
            ids, length = np.take_along_axis(ids, keep, axis=1), length - 1
            if length == 1:
                out[row, 0], count[row] = ids[:, 0], 1
                break
            pairs = np.arange(length - 1) + (np.arange(length - 1) > at[:, None])
            pairs = np.minimum(pairs, length - 1)
            rank, joined = np.take_along_axis(rank, pairs, axis=1), np.take_along_axis(joined, pairs, axis=1)
            for side in (at - 1, at):                                  # the pairs with the new token
                some = np.flatnonzero((side >= 0) & (side < length - 1))
                rank[some, side[some]], joined[some, side[some]] = self._look_up(ids[some, side[some]], ids[some, side[some] + 1])
        return out, count

    def __call__(self, words: list[bytes]) -> list[np.ndarray]:
        """The token ids of each word (of at least one byte)."""
        result: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            for lo in range(0, len(part), _ROWS):
                some = part[lo:lo + _ROWS].tolist()
                data = np.frombuffer(b"".join([words[i] for i in some]), np.uint8).reshape(len(some), -1)
                ids, count = self._merge(self.letter[data])
                for i, row, n in zip(some, ids, count.tolist(), strict=True):
                    result[i] = row[:n]
        return result
