"""Vectorised hashing of the words of one text: every loop over words runs in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
_rng = np.random.default_rng(20240607)
#: Random 64-bit values for each byte, two independent sets, and odd multipliers.
BYTE = _rng.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * U(2) + U(1)
MULT = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(m: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[U(1)], np.full(n - 1, MULT[m], dtype=np.uint64)]), dtype=np.uint64)


_POW = [_powers(0, 256), _powers(1, 256)]


def split(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: exactly what bytes.split() cuts at."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(data: bytes, which: int = 0) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 bytes, in order; ``which`` picks one of two independent hashes."""
    a = np.frombuffer(data, dtype=np.uint8)
    space = (a == 32) | ((a >= 9) & (a <= 13))
    inside = ~space
    edge = np.flatnonzero(inside[1:] & space[:-1]) + 1
    starts = np.concatenate([[0], edge]) if len(a) and inside[0] else edge
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    kept = np.flatnonzero(inside)
    # the rank of each byte in its word
    first = np.searchsorted(kept, starts)
    lens = np.diff(np.concatenate([first, [len(kept)]]))
    rank = np.arange(len(kept)) - np.repeat(first, lens)
    if rank.max() >= len(_POW[which]):
        _POW[which] = _powers(which, int(rank.max()) * 2)
    value = BYTE[which][a[kept]] * _POW[which][rank]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64))


def gram_hashes(wh: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hashes of all runs of k words from word hashes (an empty array where there are fewer)."""
    n = len(wh) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = wh[:n].copy()
    for j in range(1, k):
        out *= MULT[which]
        out += wh[j : j + n]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def sliding_max(x: np.ndarray, w: int) -> np.ndarray:
    return ~sliding_min(~x, w)


def minimizers(grams: np.ndarray, w: int) -> np.ndarray:
    """Places of the values that are least in some run of w consecutive values; all where there are fewer than w.

    The choice depends on the run alone, so equal runs choose equal values at equal places.
    """
    if len(grams) < w:
        return np.zeros(0, dtype=np.int64) if not len(grams) else np.flatnonzero(grams == grams.min())
    low = sliding_min(grams, w)
    pad = np.zeros(w - 1, dtype=np.uint64)
    return np.flatnonzero(sliding_max(np.concatenate([pad, low, pad]), w) == grams)
