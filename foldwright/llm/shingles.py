"""Word shingles of whole texts as 64-bit fingerprints, computed in numpy for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from foldwright.llm.common import mixed

_PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    forward, backward = (np.full(size, base, dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    forward[0] = backward[0] = 1
    return np.cumprod(forward), np.cumprod(backward)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of all texts, and the number of the text it stands in."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    inside = ~_SPACES[data]
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    size = 1 << max(20, int(len(data) + 1).bit_length())
    forward, backward = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * forward[: len(data)], out=sums[1:])
    words = (sums[last] - sums[first]) * backward[first]
    return mixed(words + (last - first).astype(np.uint64)), np.searchsorted(ends, first, side="right")


def _chained(words: np.ndarray, count: int, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words; ``count`` runs."""
    total = words[:count].copy()
    for k in range(1, width):
        total = mixed(total) + words[k : k + count]
    return mixed(total + np.uint64(width))


def _piece_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    words, owner = _word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    runs = max(0, len(words) - width + 1)
    hashes = _chained(words, runs, width) if runs else words[:0]
    starts = np.cumsum(counts) - counts
    found = []
    for start, count in zip(starts.tolist(), counts.tolist(), strict=True):
        if count >= width:
            found.append(np.unique(hashes[start : start + count - width + 1]))
        elif count:
            found.append(_chained(words[start : start + count], 1, count))
        else:
            found.append(words[:0])
    return found


def shingle_sets(texts: list, width: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted; empty for a text without words and for null.

    Words are runs of anything but the six ASCII spaces, A-Z lower-cased. A text with fewer than
    ``width`` words has one hash for the whole sequence. About half a million bytes are worked on at a
    time, or one longer text.
    """
    piece: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if piece and size + len(data) > _PIECE:
            yield from _piece_sets(piece, width)
            piece, size = [], 0
        piece.append(data)
        size += len(data) + 1
    if piece:
        yield from _piece_sets(piece, width)
