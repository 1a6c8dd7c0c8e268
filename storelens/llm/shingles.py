"""Distinct word-shingle hashes of whole texts, vectorised over blocks of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BLOCK = 1 << 19
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 2 * _BLOCK), base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if len(have) <= 8 * _BLOCK:  # a rare huge text must not stay in memory
            _powers[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased) and each text's first word index (plus the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    return span_hashes(_BYTE[_LOWER[data]], start, end), np.concatenate(([0], np.searchsorted(start, ends_of)))


def span_hashes(numbers: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of a sequence of 64-bit numbers, the same wherever the span stands."""
    table = np.concatenate((np.zeros(1, np.uint64), np.cumsum(numbers * _power(_P, "up", len(numbers)), dtype=np.uint64)))
    return mix((table[end] - table[start]) * _power(_P_INV, "down", len(numbers) + 1)[start])


def byte_numbers(data: np.ndarray) -> np.ndarray:
    """A fixed random number for each byte, the same for A-Z and a-z."""
    return _BYTE[_LOWER[data]]


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles.

    A text of fewer words has its whole word sequence as one shingle; without words, or null, none.
    """
    at = 0
    while at < len(texts):
        block, total = [], 0
        while at < len(texts) and (not block or total < _BLOCK):
            block.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            total += len(block[-1])
            at += 1
        words, first = word_hashes(block)
        n = len(words)
        runs = np.zeros(max(0, n - size + 1), dtype=np.uint64)
        for k in range(size):
            runs += words[k:k + len(runs)] * _STEP[k]
        runs = mix(runs)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if hi - lo >= size:
                yield np.unique(runs[lo:hi - size + 1])
            elif hi > lo:
                own = (words[lo:hi] * _STEP[:hi - lo]).sum(dtype=np.uint64, keepdims=True)
                yield mix(own + _STEP[size + hi - lo:size + hi - lo + 1])
            else:
                yield np.zeros(0, dtype=np.uint64)
