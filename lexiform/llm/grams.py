"""Byte n-grams as packed integers, and a hash table over them whose lookups are array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that one array operation works on, at most.
CHUNK = 1 << 19


def packed(data: np.ndarray, n: int) -> np.ndarray:
    """For each position from ``n - 1`` on, the last ``n`` bytes, the latest lowest."""
    size = len(data) - n + 1
    out = np.zeros(max(size, 0), np.uint64)
    for k in range(n if size > 0 else 0):
        out <<= np.uint64(8)
        out |= data[k : k + size]
    return out


def streams(texts: list[bytes], lead: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The texts, each after ``lead``, in arrays of bounded size: (bytes with what stands before them, text number of each
    scored position, bytes of context in front). Long texts go on in the next array with their own last bytes as context."""
    n = len(lead)
    parts: list[bytes] = []
    owners: list[np.ndarray] = []
    held = 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t), 1), CHUNK):
            body = t[at : at + CHUNK]
            before = lead if at == 0 else t[at - n : at]
            parts.append(before + body)
            owners.append(np.concatenate([np.full(n, -1, np.int32), np.full(len(body), i, np.int32)]))
            held += len(body)
            if held >= CHUNK:
                yield np.frombuffer(b"".join(parts), np.uint8), np.concatenate(owners), n
                parts, owners, held = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), np.concatenate(owners), n


def counted(texts: Iterator[bytes], n: int, lead: bytes, hold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-grams and their counts; handed on whenever ``hold`` distinct ones are held."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pending: list[np.ndarray] = []
    size = 0

    def fold(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, c = np.unique(np.concatenate(pending), return_counts=True)
        every, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
        return every, np.bincount(at, np.concatenate([counts, c]).astype(np.float64), len(every)).astype(np.int64)

    batch: list[bytes] = []
    held = 0

    def take() -> None:
        nonlocal size
        for data, owner, lead_n in streams(batch, lead):
            got = packed(data, n)[lead_n + 1 - n :] if lead_n + 1 >= n else packed(data, n)
            pending.append(got[owner[lead_n:] >= 0])
            size += len(pending[-1])

    for t in texts:
        batch.append(t)
        held += len(t)
        if held >= CHUNK:
            take()
            batch, held = [], 0
            if size >= 16 * CHUNK:
                keys, counts = fold(keys, counts)
                pending, size = [], 0
                if len(keys) >= hold:
                    yield keys, counts
                    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if batch:
        take()
    if pending:
        keys, counts = fold(keys, counts)
    if len(keys):
        yield keys, counts


class GramTable:
    """Open addressing with linear probing: keys (not all ones) to 32-bit floats."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, self.EMPTY, np.uint64)
        self.values = np.zeros(1 << bits, np.float32)
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):
            free = self.keys[slots] == self.EMPTY
            winners = np.unique(slots[free], return_index=True)[1]
            at = np.flatnonzero(free)[winners]
            self.keys[slots[at]] = keys[left[at]]
            self.values[slots[at]] = values[left[at]]
            rest = np.ones(len(left), bool)
            rest[at] = False
            left, slots = left[rest], (slots[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.FACTOR) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value)."""
        slots = self._slots(keys)
        there = self.keys[slots]
        found = there == keys
        values = np.where(found, self.values[slots], np.float32(0))
        left = np.flatnonzero(~found & (there != self.EMPTY))
        slots = slots[left]
        while len(left):
            slots = (slots + 1) & self.mask
            there = self.keys[slots]
            hit = there == keys[left]
            found[left[hit]] = True
            values[left[hit]] = self.values[slots[hit]]
            go = ~hit & (there != self.EMPTY)
            left, slots = left[go], slots[go]
        return found, values
