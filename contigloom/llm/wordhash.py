"""Words of many texts at once, and hashes of words and of windows of words, in numpy.

A word is a longest run of characters other than space and the controls 9 to 13, taken unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

#: Longer words are hashed one by one.
LONG = 256
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # of the first k bytes


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


class Words(NamedTuple):
    """All words of some texts: a hash, the text's index, and the place in ``data`` of each."""

    data: bytes
    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def bounds(self, n_texts: int) -> np.ndarray:
        """Where each text's words begin; one more entry than texts."""
        return np.searchsorted(self.text, np.arange(n_texts + 1))


def words_of(texts: list[str | None]) -> Words:
    """Split and hash; an empty text and a null have no words."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(parts) + b"\n"
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = (raw == 32) | ((raw - np.uint8(9)) < 5)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum([len(p) + 1 for p in parts])
    return Words(data, _hashes(data, start, end), np.searchsorted(ends, start, side="right"), start, end)


def _hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word: its length, then eight bytes after the other, each mixed into what came before.

    No sum over the bytes would do: there are words that any such sum takes for each other.
    """
    eight = np.ndarray((len(data),), dtype="<u8", buffer=data + bytes(8), strides=(1,))  # the eight bytes from each place on
    length = end - start
    value = mix(eight[start] & _MASK[np.minimum(length, 8)]) ^ mix(length.astype(np.uint64) + np.uint64(1))
    at = np.flatnonzero(length > 8)
    done = 8
    value = mix(value)
    while len(at) and done < LONG:
        value[at] = mix(value[at] ^ (eight[start[at] + done] & _MASK[np.minimum(length[at] - done, 8)]))
        done += 8
        at = at[length[at] > done]
    for i in at:
        value[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]], digest_size=8).digest(), "little")
    return value


def windows(words: Words, size: int, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` words of one text, and the index of its first word."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.text[:n] == words.text[size - 1:])
    if within is not None:
        at = at[within[at]]
    value = np.zeros(len(at), dtype=np.uint64)
    factor = 0x9FB21C651E98DF25
    for j in range(size):
        value += words.hash[at + j] * np.uint64(factor | 1)
        factor = factor * 0xD1342543DE82EF95 + 1 & (1 << 64) - 1
    return mix(value), at


def in_chunks(texts: list[str | None], chars: int = 250_000) -> Iterator[tuple[int, list[str | None]]]:
    """Slices of a list of texts that hold about so many characters, or one text; with the first's index."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= chars:
            yield first, texts[first:i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]
