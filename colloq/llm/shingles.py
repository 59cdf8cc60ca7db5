"""Hashed shingles of a text, and the bits that most of them have."""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``size`` words, lower-cased in ASCII and joined by one space."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, "<u8")
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, 42)], "<u8")
    lengths = np.fromiter(map(len, words), "int64", len(words))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip((ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], 42) for a, b in spans), "<u8", len(words) - size + 1)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit numbers have each bit: added up byte-wise in blocks of 255."""
    total = np.zeros(64, "int64")
    for k in range(0, len(h), 255 * 1024):
        part = np.ascontiguousarray(h[k : k + 255 * 1024]).view("u1").reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        blocks = -(-len(bits) // 255)
        padded = np.zeros((blocks * 255, 64), "u1")
        padded[: len(bits)] = bits
        total += padded.view("<u8").reshape(blocks, 255, 8).sum(axis=1).view("u1").reshape(blocks, 64).sum(axis=0, dtype="int64")
    return total


def majority(h: np.ndarray) -> bytes:
    """The 64 bits, little-endian, that are set in over half the hashes; none are without hashes."""
    return np.packbits(bit_counts(h) * 2 > len(h), bitorder="little").tobytes() if len(h) else bytes(8)
