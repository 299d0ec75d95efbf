"""XXH64 of many short byte ranges at once."""

from __future__ import annotations

import numpy as np
import xxhash

# The primes of the published XXH64 specification.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)
    for x in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of ``data[start : start + length]`` for each pair, as unsigned 64-bit values.

    Ranges of 32 bytes and more go to the xxhash library one by one; shorter ones,
    the rule for a few words, are hashed together, eight bytes a step.
    """
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = np.empty(len(starts), dtype=np.uint64)
    long = lengths >= 32
    if long.any():
        raw = padded.tobytes()
        out[long] = [
            xxhash.xxh64_intdigest(raw[a : a + n], seed)
            for a, n in zip(starts[long].tolist(), lengths[long].tolist(), strict=True)
        ]
    at = np.flatnonzero(~long)
    at = at[np.argsort(lengths[at], kind="stable")]
    start, length = starts[at], lengths[at]
    acc = np.uint64(seed) + _P5 + length.astype(np.uint64)

    def rest(values: np.ndarray) -> int:
        return int(np.searchsorted(values, True))

    for k in (8, 16, 24):
        i = rest(length >= k)
        v = _rotl(eight[start[i:] + (k - 8)] * _P2, 31) * _P1
        acc[i:] = _rotl(acc[i:] ^ v, 27) * _P1 + _P4
    i = np.flatnonzero(length & 4)
    v = eight[start[i] + (length[i] & ~7)] & np.uint64(0xFFFFFFFF)
    acc[i] = _rotl(acc[i] ^ (v * _P1), 23) * _P2 + _P3
    for k in range(3):
        i = np.flatnonzero((length & 3) > k)
        v = padded[start[i] + (length[i] & ~3) + k].astype(np.uint64)
        acc[i] = _rotl(acc[i] ^ (v * _P5), 11) * _P1
    acc = (acc ^ (acc >> np.uint64(33))) * _P2
    acc = (acc ^ (acc >> np.uint64(29))) * _P3
    out[at] = acc ^ (acc >> np.uint64(32))
    return out
