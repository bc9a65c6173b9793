"""SetSketch registers in numpy: exponentially spaced, truncated minima (Ertl, "SetSketch: filling the gap between MinHash
and HyperLogLog", 2021), their bands, and the joint maximum-likelihood estimate of the Jaccard similarity.

A register holds floor(1 - log_b(x)), cut to 0..Q+1, where x is the least of exponentially distributed hash values of the
set's elements. Registers of a union are the maxima of the registers, so sketches can be merged.
"""

from __future__ import annotations

import math

import numpy as np

BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
BASE, RATE, Q = 1.001, 20.0, 65534

_rng = np.random.default_rng(20211)
_XOR = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)[:, None]
_MUL = (_rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1))[:, None]
_BAND_MUL = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_ADD = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_CHUNK = 2048


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minima(hashes: np.ndarray) -> np.ndarray:
    """For every register the least 32-bit hash of the elements (uint64 hashes)."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    for i in range(0, len(x), _CHUNK):
        h = (x[None, i : i + _CHUNK] ^ _XOR) * _MUL
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(low, h.min(axis=1), out=low)
    return low


def registers(low: np.ndarray) -> np.ndarray:
    """uint16 registers from minima, for any shape."""
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, Q + 1).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """[sets, BANDS] signed 64-bit keys of [sets, REGISTERS]; a key holds its band's number."""
    r = regs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mix((r * _BAND_MUL).sum(axis=2, dtype=np.uint64) + _BAND_ADD).view(np.int64)


def bits(regs: np.ndarray) -> np.ndarray:
    """[sets, 4] signed 64-bit words with one bit of each register: sets of similarity J differ in about (1 - J) / 2 of the bits."""
    h = mix(regs.astype(np.uint64) + (np.arange(REGISTERS, dtype=np.uint64) << np.uint64(20)))
    one = np.zeros((len(regs), 256), np.uint8)
    one[:, :REGISTERS] = h & np.uint64(1)
    return np.packbits(one, axis=1).view(np.int64)


def most_bits_apart(similarity: float, sigmas: float = 5.5) -> int:
    """Sets of that similarity or more differ in more bits with a probability below 1e-7."""
    p = (1 - similarity) / 2
    return math.ceil(REGISTERS * p + sigmas * math.sqrt(REGISTERS * p * (1 - p)))


def least_estimate(similarity: float, sigmas: float = 5.5) -> float:
    return similarity - sigmas * math.sqrt(similarity * (1 - similarity) / REGISTERS)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, grid: int = 200) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches ([pairs, REGISTERS]) of sets of known sizes.

    With relative sizes u and v, a register is larger in a with probability p(u - vJ), in b with p(v - uJ), else equal,
    where p(x) = -log_b(1 - x (b - 1) / b). The likelihood of the three counts is greatest at the estimate.
    """
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.minimum(u / v, v / u) * np.linspace(0, 1, grid + 1)[None, :]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    like = more * np.log(up + tiny) + less * np.log(down + tiny) + (REGISTERS - more - less) * np.log(np.clip(1 - up - down, tiny, 1))
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], axis=1)[:, 0]
