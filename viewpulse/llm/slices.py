"""64-bit hashes of many slices of a byte buffer at once, and word positions in texts."""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of MurmurHash3)."""
    x = x.astype(U)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> U(33)
        x *= U(factor)
    x ^= x >> U(33)
    return x


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit number for each byte."""
    return mix(np.arange(256, dtype=U) + U(256 * (seed + 1)))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
    return tuple(_powers_of(b, size + 1) for b in (base, pow(base, -1, 1 << 64)))


def _powers_of(base: int, size: int) -> np.ndarray:
    """The first ``size`` powers modulo 2^64: every 1024th times the first 1024."""
    chain = lambda b, n: np.cumprod(np.append(np.ones(1, U), np.full(n - 1, b % (1 << 64), U)))
    return np.multiply.outer(chain(base**1024, (size - 1) // 1024 + 1), chain(base, 1024)).ravel()[:size]


def slice_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A polynomial hash of ``raw[starts[i]:ends[i]]``, mixed with its length."""
    power, inverse = _powers(len(raw))
    total = np.concatenate([np.zeros(1, U), np.cumsum(table[raw] * power[: len(raw)])])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))


def parts(texts: list[str], size: int = 1_000_000):
    """Indices and UTF-8 bytes of texts, a bounded number of bytes at a time (a longer text alone)."""
    at, own, total = [], [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass")
        if own and total + len(b) > size:
            yield at, own
            at, own, total = [], [], 0
        at.append(i)
        own.append(b)
        total += len(b)
    if own:
        yield at, own


def words(own: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends, words of each text) of the words between ASCII white space, A-Z in lower case."""
    split = [b.lower().split() for b in own]
    count = np.array([len(s) for s in split], np.int64)
    raw = np.frombuffer(b" ".join([b" ".join(s) for s in split if s]), np.uint8)
    if not len(raw):
        none = np.empty(0, np.int64)
        return raw, none, none, count
    ends = np.append(np.flatnonzero(raw == 32), len(raw))
    return raw, np.append(0, ends[:-1] + 1), ends, count
