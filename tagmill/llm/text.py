"""Words of byte texts and their hashes, inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

# Texts are cut into words in pieces of about this many bytes, so a huge text needs no huge list.
PIECE = 1 << 22
SPACE = b" \t\n\r\x0b\x0c"
# Distinct words whose hashes are kept at a time.
CACHED_WORDS = 1 << 19


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Parts of a text cut only at white space."""
    start = 0
    while len(data) - start > size:
        end = start + size
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:] if start else data


def word_hashes(data: bytes, known: WordHashes) -> np.ndarray:
    """Hashes of the words of a text in order; words are what ``bytes.split`` finds between the six ASCII blanks."""
    parts = []
    for part in pieces(data):
        words = part.split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finalizer of SplitMix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingle_set(data: bytes, width: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text; A-Z are lowered.

    Fewer words than ``width`` make one shingle, no word makes none.
    """
    words = word_hashes(data.lower(), known)
    if not len(words):
        return words
    count = max(1, len(words) - width + 1)
    hashed = np.zeros(count, np.uint64)
    for i in range(min(width, len(words))):
        hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + words[i:i + count] + np.uint64(1))
    return sorted_distinct(hashed)
