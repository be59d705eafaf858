"""Hashed n-grams of byte buffers, without a loop over words or documents."""

from __future__ import annotations

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(32))
    x = x * MIX
    x ^= x >> np.uint64(29)
    return x * ODD


def hashed(buf: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket (``bits`` bits) of the n bytes from each place of ``buf`` on;
    n is at most 8. Shorter than n: no buckets."""
    if len(buf) < n:
        return np.zeros(0, np.int64)
    word = np.zeros(len(buf) - n + 1, np.uint64)
    for i in range(n):
        word = (word << np.uint64(8)) | buf[i:len(buf) - n + 1 + i]
    return (mixed(word + np.uint64(n * int(ODD) % (1 << 64))) >> np.uint64(64 - bits)).astype(np.int64)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer, with the start and end of each."""
    ends = np.cumsum(np.array([len(t) for t in texts], np.int64)) if texts else np.zeros(0, np.int64)
    starts = np.concatenate(([0], ends[:-1])) if texts else ends
    return np.frombuffer(b"".join(texts), np.uint8), starts, ends


def chunks(texts: list[bytes], size: int = 1 << 20):
    """Slices of a list of texts of about ``size`` bytes each."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
