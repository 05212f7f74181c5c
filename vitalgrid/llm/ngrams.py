"""Sets of word n-grams of many texts at once, as 64-bit hashes, without a step for each word in Python."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def text_bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts as UTF-8, one after another, and where each begins, with the end of the last. Null is empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return bytes(data[int(offsets[0]):int(offsets[-1])]) if data is not None else b"", offsets - offsets[0]


@dataclass(frozen=True)
class Words:
    """The words of many texts, in order."""

    hashes: np.ndarray
    number: np.ndarray  # words of each text
    letters: np.ndarray  # all texts as UTF-8
    first: np.ndarray  # where each word begins in it, and its length
    length: np.ndarray

    def last_letters(self) -> np.ndarray:
        """The last two bytes of each word as a number; one byte if it has no more."""
        last = self.letters[self.first + self.length - 1].astype(np.uint64)
        before = np.where(self.length > 1, self.letters[np.maximum(self.first + self.length - 2, 0)].astype(np.uint64) + np.uint64(1), 0)
        return before * np.uint64(256) + last


def words_of(texts: pa.Array, separators: np.ndarray = _SPACE, lower: bool = True) -> Words:
    """Words are runs of anything but ASCII white space, or other separating bytes, with A-Z lower-cased. Null has none."""
    data, offsets = text_bytes(texts)
    data = data.lower() if lower else data
    letters = np.frombuffer(data, np.uint8)
    solid = ~separators[letters]
    cut = np.zeros(len(letters) + 1, bool)  # a text begins or ends here
    cut[offsets] = True
    first = np.flatnonzero(solid & (cut[:-1] | ~np.concatenate([[False], solid[:-1]])))
    last = np.flatnonzero(solid & (cut[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    # eight letters at a time, at any place; letters beyond the word are cut off
    eights = np.ndarray((len(letters) + 1,), "<u8", data + bytes(16), strides=(1,))
    length = last - first
    hashes = mix64(length.astype(np.uint64) * _ODD)
    active, at = np.arange(len(first)), 0
    while len(active):
        left = np.minimum(length[active] - at, 8).astype(np.uint64)
        block = eights[first[active] + at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        hashes[active] = mix64(hashes[active] ^ block) * _ODD
        at += 8
        active = active[length[active] > at]
    return Words(hashes, np.diff(np.searchsorted(first, offsets)), letters, first, length)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many words each text has."""
    found = words_of(texts)
    return found.hashes, found.number


def ngram_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of each text, ascending, one text after another, and their numbers.

    A text of fewer words than ``width`` is one n-gram; one without words has none. The number of words
    is part of the hash, so a whole short text never equals a full n-gram.
    """
    hashes, words = word_hashes(texts)
    owner = np.repeat(np.arange(len(words)), words)
    # of all places that begin an n-gram, by the number of its words
    tokens, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    starts = np.cumsum(words) - words
    for k in range(1, width + 1):
        if k < width:
            place = starts[words == k]
        else:
            place = np.flatnonzero(owner[:len(owner) - k + 1] == owner[k - 1:]) if len(owner) >= k else np.zeros(0, np.int64)
        if len(place):
            mixed = np.full(len(place), k, np.uint64)
            for i in range(k):
                mixed = mixed * _ODD + hashes[place + i]
                mixed ^= mixed >> np.uint64(31)
            tokens.append(mix64(mixed))
            owners.append(owner[place])
    flat, of = np.concatenate(tokens), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    flat, of = flat[order], of[order]
    number = np.bincount(of, minlength=len(words))
    ends = np.cumsum(number)
    for end, n in zip(ends.tolist(), number.tolist()):
        flat[end - n:end].sort()
    once = np.ones(len(flat), bool)
    once[1:] = (flat[1:] != flat[:-1]) | (of[1:] != of[:-1])
    return flat[once], np.bincount(of[once], minlength=len(words))


def set_names(tokens: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A 64-bit sum over each set: equal for equal sets, 0 for empty ones."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(tokens ^ _ODD))])  # wraps around, as do differences
    ends = np.cumsum(number)
    return (total[ends] - total[ends - number]).view(np.int64)
