"""Vectorised hashes of words and byte strings: polynomials over 64-bit integers, with a random value for each byte."""

from __future__ import annotations

import re

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LETTERS = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1); kept and grown by doubling."""
    p = _powers.get(base)
    if p is None or len(p) < n:
        size = 1 << max(12, (n - 1).bit_length())
        p = np.full(size, U(base))
        p[0] = U(1)
        _powers[base] = p = np.multiply.accumulate(p)
    return p[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(29))
    h = h * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def prefix(b: np.ndarray) -> np.ndarray:
    """Prefix sums: with them the hash of any substring is two look-ups."""
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(LETTERS[b] * powers(BASE, len(b)), out=out[1:])
    return out


def substrings(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings from begin to end."""
    inverse = powers(INVERSE, len(sums))
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def grams(b: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte strings of b, each built from halves."""
    out, done, level, n = None, 0, LETTERS[b], 1
    while True:
        if k & n:
            if out is None:
                out, done = level, n
            else:
                m = len(b) - done - n + 1
                out = out[:m] * U(pow(BASE, n, 1 << 64)) + level[done : done + m]
                done += n
        n *= 2
        if n > k:
            return mix(out)
        level = level[: -n // 2] * U(pow(BASE, n // 2, 1 << 64)) + level[n // 2 :]


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minima of all w neighbouring values."""
    m, n, size = v, 1, len(v) - w + 1
    while n * 2 <= w:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    return np.minimum(m[:size], m[w - n : w - n + size])


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


LONG = 1 << 20  # bytes of a text that are hashed at once
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lowered; long texts are cut at white space."""
    raw, out, at = raw.translate(FOLD), [], 0
    while at < len(raw):
        cut = BLANK.search(raw, at + LONG)
        end = cut.end() if cut else len(raw)
        b = np.frombuffer(raw, np.uint8, end - at, at)
        edge = np.diff(np.concatenate(([True], SPACE[b], [True])).astype(np.int8))
        out.append(substrings(prefix(b), np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of fewer words the whole sequence is the only one."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(w):
        return w
    n = min(width, len(w))
    h = np.full(len(w) - n + 1, U(n))
    for k in range(n):
        h = h * U(BASE) + w[k : len(w) - n + 1 + k]
    return np.unique(mix(h))
