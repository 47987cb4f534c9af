"""Fingerprints of word windows, vectorised inside a task."""

from __future__ import annotations

import numpy as np

#: Odd multipliers and a table of byte values, drawn once from a fixed seed.
_RNG = np.random.Generator(np.random.PCG64(20240501))
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = int(_RNG.integers(1, 1 << 62)) * 4 + 3
STEP_BACK = pow(STEP, -1, 1 << 64)
WORD_STEP = int(_RNG.integers(1, 1 << 62)) * 4 + 3
BLOCK = 1 << 18

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK + 1024), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly; no two values meet."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_prints(text: str | None, lower: bool = False) -> np.ndarray:
    """A 64-bit fingerprint of each word (runs without blank and tab to carriage return); ``lower`` maps A-Z first."""
    if not text:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(text.encode(), np.uint8)
    if lower:
        raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    parts, i = [], 0
    while i < len(starts):
        # Whole words of about a block, so that powers and sums stay small for texts of any length.
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        low, high = starts[i], ends[j - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(BYTE[raw[low:high]] * _powers(STEP, high - low), out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        parts.append((sums[e] - sums[s]) * _powers(STEP_BACK, high - low + 1)[s])
        i = j
    return mix(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def window_prints(words: np.ndarray, size: int) -> np.ndarray:
    """A fingerprint of each window of ``size`` words; none where there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    powers = _powers(WORD_STEP, size)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += words[k : k + n] * powers[k]
    return mix(out + np.uint64(size))


def sequence_print(words: np.ndarray) -> np.ndarray:
    """A fingerprint of all words in their order, as an array of one."""
    total = (words * _powers(WORD_STEP, len(words))).sum(keepdims=True)
    return mix(total + np.uint64(len(words)))


def all_windows(text: str | None, size: int) -> np.ndarray:
    """The windows of the lower-cased text in their order; a shorter text is one window, an empty one has none."""
    words = word_prints(text, lower=True)
    return window_prints(words, min(size, len(words))) if len(words) else words


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct windows of the lower-cased text in order of fingerprint."""
    return np.unique(all_windows(text, size))
