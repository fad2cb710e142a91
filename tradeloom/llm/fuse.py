"""Binary fuse filters: static sets of 64-bit keys in about nine bits a key.

Every key owns three slots in neighbouring segments; the exclusive or of the three is the
key's fingerprint byte. Building peels slots that one key owns alone, round by round, and then
fills them in reverse order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Fuse:
    seed: int
    segment: int
    cells: np.ndarray


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _places(h: np.ndarray, segment: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots and the fingerprint of each hash."""
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(cells - 2 * segment)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third], axis=1).astype(np.int64), ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def build(keys: np.ndarray) -> Fuse:
    """A filter of distinct keys; it holds all of them and one in 256 others."""
    n = len(keys)
    if not n:
        return Fuse(0, 0, np.zeros(0, np.uint8))
    segment = 1 << min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25))
    room = n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    cells = (max(1, int(np.ceil(room / segment)) - 2) + 2) * segment
    for seed in range(1, 1000):
        slots, prints = _places(_mixed(keys, seed), segment, cells)
        rounds = _peel(slots, cells)
        if rounds is not None:
            table = np.zeros(cells, np.uint8)
            for key, slot in reversed(rounds):
                table[slot] = prints[key] ^ np.bitwise_xor.reduce(table[slots[key]], axis=1)
            return Fuse(seed, segment, table)
    raise ValueError("keys are not distinct")


def _peel(slots: np.ndarray, cells: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    n = len(slots)
    owners = np.bincount(slots.ravel(), minlength=cells)
    names = np.bincount(slots.ravel(), np.repeat(np.arange(n, dtype=np.float64), 3), cells)
    rounds, left = [], n
    while left:
        alone = np.flatnonzero(owners == 1)
        if not len(alone):
            return None
        key, first = np.unique(names[alone].astype(np.int64), return_index=True)
        rounds.append((key, alone[first]))
        gone = slots[key].ravel()
        owners -= np.bincount(gone, minlength=cells)
        names -= np.bincount(gone, np.repeat(key.astype(np.float64), 3), cells)
        left -= len(key)
    return rounds


def contains(fuse: Fuse, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the set; never False for a key that is."""
    if not len(fuse.cells) or not len(keys):
        return np.zeros(len(keys), bool)
    slots, prints = _places(_mixed(keys, fuse.seed), fuse.segment, len(fuse.cells))
    return np.bitwise_xor.reduce(fuse.cells[slots], axis=1) == prints
