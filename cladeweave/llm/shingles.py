"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import claim, utf8

WORDS = 5
_MEMO_LIMIT = 1 << 17
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def words(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), separated by ASCII white space."""
    return utf8(text).lower().split()


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingles of ``WORDS`` words; a shorter text is one shingle, none if empty."""
    claim("shingles", _hashes.clear)
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w), len(w))], np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, w), np.uint64, len(w))
    n = len(w) - WORDS + 1
    s = np.zeros(n, np.uint64)
    for i, factor in enumerate(_FACTORS):
        s += h[i : i + n] * np.uint64(factor)
        s ^= s >> np.uint64(29)
    s *= np.uint64(0x94D049BB133111EB)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed numbers."""
    digest = xxhash.xxh3_128_digest(tokens.tobytes())
    return tuple(int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))
