"""Hashed words and n-grams of whole texts, for use inside tasks.

Words are separated by white space; a word's key is its XXH64, the key of an
n-gram mixes the keys of its words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import xxhash

CHUNK_BYTES = 4 << 20
START = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(0xC2B2AE3D27D4EB4F)
_FACTOR, _ODD = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The key of a left part and a right part."""
    x = (left ^ (left >> np.uint64(29))) * _FACTOR + right
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def hashed(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def lower_case_words(text: bytes) -> np.ndarray:
    """The keys of the words with A-Z folded to a-z."""
    return hashed(text.lower().split())


def text_chunks(
    texts: Iterable[bytes | None], words: Callable[[bytes], np.ndarray] = lower_case_words, size: int = CHUNK_BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(keys, ends)`` for runs of texts of about ``size`` bytes: the keys of the words
    of each text followed by ``END``, and where each text ends."""
    keys: list[np.ndarray] = []
    held = 0
    for text in texts:
        keys.append(np.append(words(text or b""), END))
        held += len(text or b"")
        if held >= size:
            yield np.concatenate(keys), np.cumsum([len(k) for k in keys])
            keys, held = [], 0
    if keys:
        yield np.concatenate(keys), np.cumsum([len(k) for k in keys])


def before(keys: np.ndarray, ends: np.ndarray, steps: int = 1) -> np.ndarray:
    """The key ``steps`` places earlier in the same text, ``START`` before its first."""
    shifted = np.full(len(keys), START, np.uint64)
    shifted[steps:] = keys[:-steps] if steps else keys
    starts = np.concatenate([[0], ends[:-1]])
    for i in range(steps):
        at = starts + i
        shifted[at[at < ends]] = START
    return shifted


def per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` per text."""
    return np.add.reduceat(values, np.concatenate([[0], ends[:-1]])) if len(ends) else np.zeros(0)


class Lookup:
    """A sorted table from keys to values; keys it does not hold get ``default``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float = 0):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values, self.default = keys[order], values[order], default

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.default, self.values.dtype)
        # sorted probes walk through the table, which is several times faster than jumping in it
        order = np.argsort(keys)
        asked = keys[order]
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        found = np.empty(len(keys), self.values.dtype)
        found[order] = np.where(self.keys[at] == asked, self.values[at], self.values.dtype.type(self.default))
        return found
