"""Words and shingles of whole texts, hashed with numpy over many documents at once.

A word is a run of bytes other than the six ASCII blanks (0x20, 0x09-0x0D).
Hashes have 64 bits: a random value for each byte, summed with powers of an odd
base by prefix sums, then mixed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_ROOT = pow(_BASE, -1, 1 << 64)


class Words(NamedTuple):
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after it
    offsets: np.ndarray  # words before each document, and of all
    hashes: np.ndarray


def blank_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, by doubling."""
    p = np.ones(max(n, 1), _U)
    have = 1
    with np.errstate(over="ignore"):
        while have < n:
            more = min(have, n - have)
            np.multiply(p[:more], _U(pow(base, have, 1 << 64)), out=p[have : have + more])
            have += more
    return p[:n]


def byte_values(lower: bool) -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
    if lower:
        v[65:91] = v[97:123]
    return v


def prefix_sums(raw: np.ndarray, lower: bool = False) -> np.ndarray:
    """sums[j] - sums[i], times root powers at i, is the hash of bytes i to j."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, _U)
        np.cumsum(byte_values(lower)[raw] * powers(_BASE, len(raw)), out=sums[1:])
    return sums


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run of bytes."""
    with np.errstate(over="ignore"):
        roots = powers(_ROOT, len(sums)) if roots is None else roots
        return mix((sums[ends] - sums[starts]) * roots[starts] + (ends - starts).astype(_U))


def letter_gaps() -> np.ndarray:
    """All bytes but ASCII letters, digits and those of longer UTF-8 characters."""
    t = np.ones(256, bool)
    t[48:58] = t[65:91] = t[97:123] = t[128:] = False
    return t


def word_spans(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray | None = None, by_byte: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes not in ``gaps``), and the words before each document.

    ``gaps`` tells for each value of a byte, or with ``by_byte`` for each byte of ``raw``.
    """
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    blank = gaps if by_byte else (blank_bytes() if gaps is None else gaps)[raw]
    before, after = np.empty_like(blank), np.empty_like(blank)
    before[0], before[1:] = True, blank[:-1]
    after[-1], after[:-1] = True, blank[1:]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    starts, ends, at = word_spans(raw, offsets)
    sums = prefix_sums(raw, lower)
    return Words(starts, ends, at, spans_hash(sums, starts, ends))


def windows(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside a document, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, _U)
        for j, p in enumerate(powers(0xD6E8FEB86659FD93, width + 1)[1:]):
            out += hashes[j : j + n] * p
    last = np.repeat(offsets[1:], np.diff(offsets))[:n]
    first = np.flatnonzero(np.arange(n) + width <= last)
    return mix(out[first] + _U(width)), first


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each document one after another (repeats included), and the offset of each document.

    A document of fewer words has its whole sequence as one shingle; one without
    words has none.
    """
    full, first = windows(hashes, offsets, width)
    count = np.diff(offsets)
    sizes = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(at[-1], _U)
    out[_inside(at, count >= width)] = full
    with np.errstate(over="ignore"):
        for n in range(1, width):
            docs = np.flatnonzero(count == n)
            h = np.zeros(len(docs), _U)
            for j, p in enumerate(powers(0xD6E8FEB86659FD93, n + 1)[1:]):
                h += hashes[offsets[docs] + j] * p
            out[at[docs]] = mix(h + _U(n))
    return out, at


def _inside(offsets: np.ndarray, which: np.ndarray) -> np.ndarray:
    return np.repeat(which, np.diff(offsets))
