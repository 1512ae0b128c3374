"""SHA-256 with its state between blocks as an array, for many messages side by side.

A message of hex digests is a row of whole 64-byte blocks, one for each digest, so the state before each digest is
eight 32-bit numbers that can be kept, sent and resumed.
"""

from __future__ import annotations

import numpy as np

#: Lanes worked on at once: the arrays of one round stay in the processor's cache.
LANES = 4096
_MASK = (1 << 32) - 1
_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint8).reshape(256, 2)


def _root(x: int, k: int) -> int:
    """Integer k-th root."""
    low, high = 0, 1 << (x.bit_length() // k + 1)
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if mid**k <= x else (low, mid)
    return low


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, int(p**0.5) + 1))]
#: First 32 bits of the fractions of the primes' cube and square roots.
_ROUND = [np.uint32(_root(p << 96, 3) & _MASK) for p in _PRIMES]
START = np.array([_root(p << 64, 2) & _MASK for p in _PRIMES[:8]], np.uint32)


def start(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))


def _turn(x: np.ndarray, *by: int) -> np.ndarray:
    """x rotated right by each of by, combined by exclusive or."""
    out = None
    for r in by:
        y = (x >> np.uint32(r)) | (x << np.uint32(32 - r))
        out = y if out is None else out ^ y
    return out


def _absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(np.ascontiguousarray(block.T))
    first = list(np.ascontiguousarray(state.T))
    a, b, c, d, e, f, g, h = first
    for k, const in enumerate(_ROUND):
        if k >= 16:
            x, y = w[1], w[14]
            w.append(w[0] + (_turn(x, 7, 18) ^ (x >> np.uint32(3))) + w[9] + (_turn(y, 17, 19) ^ (y >> np.uint32(10))))
            w.pop(0)
        up = h + _turn(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + const + w[min(k, 15)]
        h, g, f, e, d, c, b, a = g, f, e, d + up, c, b, a, up + _turn(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
    return np.stack([x + y for x, y in zip(first, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more digest each, (n, 32) bytes, as hex text."""
    blocks = np.ascontiguousarray(_HEX[digests].reshape(len(digests), 64)).view(">u4").astype(np.uint32)
    parts = [_absorb(state[a : a + LANES], blocks[a : a + LANES]) for a in range(0, len(state), LANES)]
    return np.concatenate(parts) if parts else state


def finish(state: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of states that took count hex digests each."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0], last[:, 15] = 1 << 31, count * 512
    parts = [_absorb(state[a : a + LANES], last[a : a + LANES]) for a in range(0, len(state), LANES)]
    return np.concatenate(parts).astype(">u4").view(np.uint8).reshape(-1, 32) if parts else np.zeros((0, 32), np.uint8)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """(n, 64) bytes of hex text."""
    return _HEX[digests].reshape(len(digests), 64)
