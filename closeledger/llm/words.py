"""Words and word shingles of one text as numpy arrays of 64-bit hashes.

A-Z is lower-cased; a word is a run of bytes other than space and the bytes
0x09-0x0D.  A text's shingles are its runs of ``width`` words; a text with
fewer words has one shingle, the whole sequence; a text without words has
none.  Equal shingles always have equal hashes; two different ones share a
hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    """Powers 0..n of ``base`` modulo 2**64; the table grows by doubling."""
    table = _powers[kind]
    while len(table) <= n:
        step = base ** np.uint64(len(table))
        table = np.concatenate([table, table * step])
    _powers[kind] = table
    return table[: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a hash so that every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * base**position, for hashes of any slice."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data))[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, whatever its place."""
    down = _power("down", _INVERSE, len(sums) - 1)
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def all_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """``span_hashes`` of every slice of ``width`` bytes, in order."""
    h = (sums[width:] - sums[:-width]) * _power("down", _INVERSE, len(sums) - 1)[: len(sums) - width]
    return mix(h + np.full(1, width, np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and the start and end of every word."""
    data = _LOWER[np.frombuffer(text.encode("utf-8"), np.uint8)]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SEPARATOR[data]
    edges = np.flatnonzero(np.diff(inside))
    return data, edges[::2], edges[1::2]


def word_hashes(text: str) -> np.ndarray:
    data, starts, ends = word_spans(text)
    return span_hashes(prefix_sums(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)


def shingle_hashes(text: str, width: int = 5) -> np.ndarray:
    """One hash per shingle place, in text order (not distinct)."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    used = min(width, len(words))
    total = np.full(n, np.uint64(used))
    for j in range(used):
        total = total * np.uint64(0xD1342543DE82EF95) + words[j : j + n]
    return mix(total)


def shingle_set(text: str, width: int = 5) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(text, width))


def shingle_strings(text: str, width: int = 5) -> set[bytes]:
    """Distinct shingles as bytes, words joined by a space."""
    data, starts, ends = word_spans(text)
    raw = data.tobytes()
    words = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}
