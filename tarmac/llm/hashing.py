"""Word hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes per numpy step; a longer text is a step of its own

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: bytes that belong to a word: letters and non-ASCII
LETTERS = np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
#: bytes that belong to a word: all but white space
NO_SPACE = np.ones(256, dtype=bool)
NO_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_FACTORS = np.zeros(0, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (one-to-one)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _factors(n: int) -> np.ndarray:
    global _FACTORS
    if len(_FACTORS) < n:
        _FACTORS = mix(np.arange(1, max(256, 2 * n) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _FACTORS


def word_hashes(texts: list[bytes], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) and each text's first word (with the end).

    ``word`` tells which bytes belong to words.  A hash is the sum of bytes
    times a random factor per place, mixed.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    ends_at = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    inside = word[raw]
    inside[ends_at - 1] = False
    edge = np.flatnonzero(np.diff(inside, prepend=False).astype(bool))
    starts, ends = edge[0::2], edge[1::2]
    first = np.searchsorted(starts, np.concatenate([[0], ends_at]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), first
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    value = _LOWER[raw[inside]].astype(np.uint64) * _factors(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, at)), first


def _spaces_and_alone(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of white space (Unicode's too), and (first byte, end) of each character that is a word by itself."""
    space = ~NO_SPACE[raw]
    space |= (raw >= 0x1C) & (raw <= 0x1F)
    at = np.flatnonzero(raw >= 0xC2)  # first bytes of the characters beyond ASCII
    a = raw[at]
    b, c = (raw[np.minimum(at + k, len(raw) - 1)] for k in (1, 2))
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | (
        (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))
    for mask, n in ((two, 2), (three, 3)):
        for k in range(n):
            space[at[mask] + k] = True
    alone = (((a >= 0xE3) & (a <= 0xE9) & ~three)  # kana and Han
             | ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB))  # Thai, Lao
             | ((a == 0xE1) & ((b == 0x80) | (b == 0x81) | (b == 0x9E) | (b == 0x9F)))  # Burmese, Khmer
             | ((a == 0xF0) & (b >= 0xA0)))  # rarer Han
    return space, np.stack([at[alone], at[alone] + np.where(a[alone] == 0xF0, 4, 3)])


def word_bounds(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of the texts joined, first byte of every word, its end, each text's first word with the end).

    A word is a run without white space; in scripts that set none between words (Han, kana, Thai, Lao, Burmese,
    Khmer) every character is one.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    ends_at = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    space, alone = _spaces_and_alone(raw)
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[alone.ravel()] = True
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ~space
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return raw, starts, ends, np.searchsorted(starts, np.concatenate([[0], ends_at]))


def exact_word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """Hash of the bytes of every word, case kept."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for lo in range(0, len(starts), step):
        lengths = ends[lo:lo + step] - starts[lo:lo + step]
        at = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        value = (raw[np.repeat(starts[lo:lo + step], lengths) + place].astype(np.uint64) + np.uint64(1)) * _factors(int(lengths.max()))[place]
        out[lo:lo + step] = mix(np.add.reduceat(value, at))
    return out


def text_chunks(column: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8, null as empty) in steps of about ``chunk`` bytes."""
    texts: list[bytes] = []
    start = size = 0
    for lo in range(0, len(column), 128):  # a batch is not held twice
        for i, t in enumerate(column.slice(lo, 128).cast(pa.large_binary()).to_pylist(), lo):
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= chunk:
                yield start, texts
                texts, start, size = [], i + 1, 0
    if texts:
        yield start, texts
