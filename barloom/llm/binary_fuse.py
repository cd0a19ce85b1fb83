"""Static binary-fuse filters: about nine bits a key, three memory probes, no false negatives."""

from __future__ import annotations

import math
import struct

import numpy as np

HEAD = "<QIII"  # seed, segment length, segment count, number of keys
_U = np.uint64


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + _U(seed)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _places(h: np.ndarray, segment: int, count: int) -> np.ndarray:
    """Three slots in three consecutive segments for each hash."""
    first = ((h >> _U(32)) * _U(segment * count)) >> _U(32)
    mask = _U(segment - 1)
    second = (first + _U(segment)) ^ ((h >> _U(18)) & mask)
    third = (first + _U(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third], axis=1).astype(np.int64)


def _mark(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> _U(32))) & _U(0xFF)).astype(np.uint8)


def _sizes(n: int) -> tuple[int, int]:
    if n <= 1:
        return 4, 1
    segment = 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    slots = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return segment, max(1, math.ceil(slots / segment) - 2)


def _peel(places: np.ndarray, slots: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot that each of them has to itself), or None if keys remain.

    All keys with a slot of their own go at once: none of them can hold another's own slot.
    """
    n = len(places)
    degree = np.bincount(places.reshape(-1), minlength=slots)
    owner = np.zeros(slots, np.int64)  # xor of the keys at a slot: the key itself if it is alone
    for column in places.T:
        np.bitwise_xor.at(owner, column, np.arange(n))
    rounds, left = [], n
    single = np.flatnonzero(degree == 1)
    while len(single):
        keys, first = np.unique(owner[single], return_index=True)
        rounds.append((keys, single[first]))
        left -= len(keys)
        touched = places[keys].reshape(-1)
        np.subtract.at(degree, touched, 1)
        np.bitwise_xor.at(owner, touched, np.repeat(keys, 3))
        touched = np.unique(touched)
        single = touched[degree[touched] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of 64-bit keys; repeated keys count once."""
    keys = np.unique(np.asarray(keys).astype(_U))
    segment, count = _sizes(len(keys))
    slots = segment * (count + 2)
    for seed in range(1, 1000):
        h = _hash(keys, seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        places = _places(h, segment, count)
        rounds = _peel(places, slots)
        if rounds is not None:
            break
    else:
        raise ValueError(f"no seed peels {len(keys)} keys")
    table, mark = np.zeros(slots, np.uint8), _mark(h)
    for own, slot in reversed(rounds):
        others = np.bitwise_xor.reduce(table[places[own]], axis=1) ^ table[slot]
        table[slot] = others ^ mark[own]
    seed = seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return struct.pack(HEAD, seed, segment, count, len(keys)) + table.tobytes()


def may_contain(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the set, and for about one in 256 others."""
    seed, segment, count, n = struct.unpack_from(HEAD, filter_bytes)
    if not n:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_bytes, np.uint8, offset=struct.calcsize(HEAD))
    h = _hash(np.asarray(keys).astype(_U), seed)
    found = np.bitwise_xor.reduce(table[_places(h, segment, count)], axis=1)
    return found == _mark(h)
