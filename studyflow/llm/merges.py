"""Byte-pair merges of many words at once.

The ids equal the tokenizer's own: in every step each word joins its pair of the least rank, the leftmost of equals. Words lie in rows of a
matrix, and all rows take a step together.
"""

from __future__ import annotations

import json

import numpy as np

LONGEST = 48
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b) if b in own else chr(free))
        free += b not in own
    return out


class Merges:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix, letters = model["vocab"], model["end_of_word_suffix"], byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.mask = np.int64(2**20 - 1)
        self.keys, self.ranks, self.probes = np.full(2**20, -1, np.int64), np.full(2**20, NONE, np.int32), 1
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self.slot(keys).tolist())):
            step = 0
            while self.keys[(slot + step) & 0xFFFFF] not in (-1, key):
                step += 1
            at = (slot + step) & 0xFFFFF
            if self.keys[at] == -1:
                self.keys[at], self.ranks[at] = key, rank
            self.probes = max(self.probes, step + 1)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        slot = self.slot(key)
        out = np.where(self.keys[slot] == key, self.ranks[slot], NONE)
        for step in range(1, self.probes):
            at = (slot + step) & self.mask
            np.copyto(out, self.ranks[at], where=self.keys[at] == key)
        return out

    def rows(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of 1 to ``width`` bytes."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        symbols = self.inner[raw]
        every = np.arange(n)
        symbols[every, size - 1] = self.final[raw[every, size - 1]]
        place = np.arange(width)[None, :]
        live = place < size[:, None]
        after = np.where(place + 1 < size[:, None], place + 1, width) * np.ones((n, 1), np.int64)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        ranks = np.full((n, width), NONE, np.int32)
        pairs = live[:, 1:]
        ranks[:, :-1][pairs] = self.rank(symbols[:, :-1][pairs], symbols[:, 1:][pairs])
        row = every
        while len(row):
            at = ranks[row].argmin(axis=1)
            least = ranks[row, at]
            row, at, least = row[least != NONE], at[least != NONE], least[least != NONE]
            if not len(row):
                break
            gone = after[row, at]
            beyond = after[row, gone]
            symbols[row, at] = self.merged[least]
            live[row, gone] = False
            ranks[row, gone] = NONE
            after[row, at] = beyond
            inside = beyond < width
            r, a, b = row[inside], at[inside], beyond[inside]
            before[r, b] = a
            ranks[row, at] = NONE
            ranks[r, a] = self.rank(symbols[r, a], symbols[r, b])
            first = before[row, at]
            inside = first >= 0
            r, a, b = row[inside], first[inside], at[inside]
            ranks[r, a] = self.rank(symbols[r, a], symbols[r, b])
        flat = symbols[live].astype("<u4").tobytes()
        cuts = np.concatenate(([0], np.cumsum(live.sum(axis=1)) * 4)).tolist()
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of words of at most ``LONGEST`` bytes."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        for low in range(0, len(order), 8192):
            part = order[low : low + 8192].tolist()
            for k, ids in zip(part, self.rows([words[k] for k in part], int(size[part[-1]]))):
                out[k] = ids
        return out
