"""Hashed word shingles of whole texts, with numpy over many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
CHUNK_BYTES = 3_000_000

_U = np.uint64
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of lower-cased bytes that end in white space."""
    solid = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid])))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return begin, np.zeros(0, np.uint64)
    size = end - begin
    ends = np.cumsum(size)
    local = np.arange(ends[-1]) - np.repeat(ends - size, size)
    power = np.full(int(size.max()), _STEP)
    power[0] = 1
    power = np.multiply.accumulate(power)
    value = np.add.reduceat(_BYTE[raw[solid]] * power[local], ends - size)
    return begin, mix(value ^ (size.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A text with fewer words has one shingle, its whole sequence; one without words none.
    """
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) < CHUNK_BYTES):
            size += len(texts[b]) + 1
            b += 1
        yield from _chunk(texts[a:b], words)
        a = b


def _chunk(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    raw = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    begin, word = _word_hashes(raw)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    cut = np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes)])).tolist()
    n = len(word) - words + 1
    grams = np.zeros(0, np.uint64)
    if n > 0:
        grams = word[:n].copy()
        for k in range(1, words):
            grams *= _U(0xA0761D6478BD642F)
            grams += word[k : k + n]
        grams = mix(grams)
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:
            short = _U(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    short = short * _U(0xE7037ED1A0B428DB) + w
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
