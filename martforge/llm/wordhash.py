"""64-bit word hashes of whole texts, vectorised over the bytes of a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at once; longer texts go in pieces cut between words.
PIECE = 1 << 20
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), _M3, np.uint64)]))


BYTE = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _M3)
BYTE[32] = 0  # the separator adds nothing
POWERS = _powers(256)


def word_bounds(norm: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text whose words are joined by one space."""
    if not norm:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    return np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(norm)]])


def _pieces(norm: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(norm):
        end = at + PIECE
        if end < len(norm):
            cut = norm.rfind(b" ", at, end)
            end = cut if cut > at else norm.find(b" ", end)
            end = len(norm) if end < 0 else end
        yield norm[at:end]
        at = end + 1


def word_hashes(norm: bytes) -> np.ndarray:
    """One hash for each word of a text whose words are joined by one space."""
    return np.concatenate([_hash_piece(p) for p in _pieces(norm)] or [np.empty(0, np.uint64)])


def _hash_piece(norm: bytes) -> np.ndarray:
    global POWERS
    data = np.frombuffer(norm, np.uint8)
    starts, ends = word_bounds(norm)
    lengths = np.diff(np.concatenate([starts, [len(data)]]))
    if (longest := int(lengths.max())) > len(POWERS):
        powers = _powers(longest)
        POWERS = powers if longest <= PIECE else POWERS  # one giant word is not kept around
    else:
        powers = POWERS
    within = np.arange(len(data)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(BYTE[data] * powers[within], starts)
    return mixed(sums + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n].copy()
    for j in range(1, k):
        total = mixed(total) + words[j:j + n]
    return mixed(total)
