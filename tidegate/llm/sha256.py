"""SHA-256 over many messages at once, with states that can be kept and resumed.

A state is the eight words after some whole blocks of 64 bytes. A digest as hex text is one such block, so
the state before every digest of a concatenation can be kept, and hashing goes on from there.
"""

from __future__ import annotations

import numpy as np

U = np.uint32


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _root(p: int, degree: int) -> int:
    """The first 32 bits behind the point of a root of ``p``."""
    goal, low, high = p << (32 * degree), 0, p << 32
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**degree <= goal else (low, middle - 1)
    return low & 0xFFFFFFFF


START = np.array([_root(p, 2) for p in _primes(8)], U)
_K = np.array([_root(p, 3) for p in _primes(64)], U)
_HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), np.uint16)


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> U(n)) | (x << U(32 - n))


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) each."""
    w = [np.ascontiguousarray(x) for x in blocks.T]
    a, b, c, d, e, f, g, h = first = [np.ascontiguousarray(x) for x in states.T]
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            s0 = _turned(x, 7) ^ _turned(x, 18) ^ (x >> U(3))
            s1 = _turned(y, 17) ^ _turned(y, 19) ^ (y >> U(10))
            w.append(w[i - 16] + s0 + w[i - 7] + s1)
        s1 = _turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)
        t = h + s1 + (g ^ (e & (f ^ g))) + _K[i] + w[i]
        s0 = _turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)
        h, g, f, e, d, c, b, a = g, f, e, d + t, c, b, a, t + s0 + ((a & b) | (c & (a | b)))
    return np.stack([x + y for x, y in zip(first, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def started(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 8) as the blocks (n, 16) of their hex text."""
    text = _HEX[digests.astype(">u4").view(np.uint8).reshape(len(digests), 32)]
    return np.ascontiguousarray(text).view(">u4").astype(U).reshape(len(digests), 16)


def last_blocks(absorbed: np.ndarray) -> np.ndarray:
    """The closing blocks of messages of so many whole blocks."""
    out = np.zeros((len(absorbed), 16), U)
    out[:, 0] = 0x80000000
    bits = absorbed.astype(np.uint64) * np.uint64(512)
    out[:, 14], out[:, 15] = (bits >> np.uint64(32)).astype(U), bits.astype(U)
    return out


def to_bytes(digests: np.ndarray) -> np.ndarray:
    """Words (…, 8) as bytes (…, 32)."""
    return np.ascontiguousarray(digests.astype(">u4")).view(np.uint8).reshape(*digests.shape[:-1], 32)


def to_words(raw: np.ndarray) -> np.ndarray:
    """Bytes (…, 32) as words (…, 8)."""
    return np.ascontiguousarray(raw).view(">u4").astype(U).reshape(*raw.shape[:-1], 8)
