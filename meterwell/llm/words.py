"""Hashes of words and of word strings, computed for many texts at once."""

from __future__ import annotations

import re

import numpy as np

# Bytes hashed in one step, so that a long text needs bounded working memory.
_SLICE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_rng = np.random.default_rng(20240214)
_SOLID = np.ones(256, bool)
_SOLID[[0x20, *range(0x09, 0x0E)]] = False
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)
_STEP = np.uint64(_rng.integers(1, 1 << 63) | 1)
_POWERS = np.cumprod(np.full(1 << 10, _STEP))
_NEXT = np.uint64(_rng.integers(1, 1 << 63) | 1)
_NEXT_BACK = np.uint64(pow(int(_NEXT), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _slice_hashes(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero(_SOLID[data])
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    sizes = np.diff(first, append=len(at))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    powers = _POWERS if sizes.max() <= len(_POWERS) else np.cumprod(np.full(sizes.max(), _STEP))
    return mixed(np.add.reduceat(_BYTE[data[at]] * powers[place], first))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each run of bytes other than 0x20 and 0x09-0x0D."""
    parts, at = [], 0
    while at < len(raw):
        end = at + _SLICE
        if end < len(raw):
            blank = _BLANK.search(raw, end)
            end = blank.start() if blank else len(raw)
        parts.append(_slice_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def hashed_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of all texts in a row, and where each text's words begin (and end)."""
    hashes: list[np.ndarray] = []
    counts = np.zeros(len(texts) + 1, np.int64)
    group: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal group, size
        if group:
            hashes.append(word_hashes(b" ".join(group)))
        group, size = [], 0

    for i, text in enumerate(texts):
        group.append(text)
        size += len(text)
        counts[i + 1] = len(text.split())
        if size >= _SLICE:
            flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.cumsum(counts)


def string_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each string of `n` consecutive words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(len(words), _NEXT))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    back = np.cumprod(np.full(len(words) - n + 1, _NEXT_BACK))
    return mixed((upto[n:] - upto[:-n]) * back)


def groups_of(texts: list, most: int) -> list[slice]:
    """Consecutive groups of texts of about `most` characters together, at least one text each."""
    found, begin, size = [], 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            found.append(slice(begin, i + 1))
            begin, size = i + 1, 0
    if begin < len(texts):
        found.append(slice(begin, len(texts)))
    return found
