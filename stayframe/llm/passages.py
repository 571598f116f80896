"""Feature vectors of the passages of whole texts, in numpy.

A passage is ``WORDS`` words; its vector holds hashed counts of byte
trigrams (square roots of shares) and a few shares of its words and bytes.
"""

from __future__ import annotations

import numpy as np

WORDS, TRIGRAM_BINS, SHARES = 64, 248, 8
SIZE = TRIGRAM_BINS + SHARES
#: Bytes of text that one step of numpy works on; a longer text is a step by itself.
STEP_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_KIND = np.full(256, 3, np.uint8)  # 0 space, 1 small, 2 capital, 3 mark, 4 digit, 5 beyond ASCII
_KIND[_SPACE], _KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 4, 5
_MIX = np.random.default_rng(11).integers(0, 1 << 32, (3, 256), dtype=np.uint64).astype(np.uint32)
_WORD_BYTES = np.random.default_rng(12).integers(0, 1 << 64, 256, dtype=np.uint64)


def _steps(texts: list[bytes]):
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > STEP_BYTES:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, modulo 2^64."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))


def encode(texts: list[bytes]):
    """Yield (vectors as float32 rows, passages of each text) step by step; a
    text without words has one passage of zeros."""
    for held in _steps(texts):
        yield _encode(held)


def _encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b"".join(t + b"  " for t in texts), np.uint8)
    ends = np.cumsum([len(t) + 2 for t in texts])
    starts = np.concatenate(([0], ends[:-1]))
    inside = ~_SPACE[buffer]
    begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    stop = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    n_before = np.searchsorted(begin, starts)  # words before each text
    n_words = np.diff(np.append(n_before, len(begin)))
    n_passages = np.maximum(-(-n_words // WORDS), 1)
    first = np.cumsum(n_passages) - n_passages
    doc = np.repeat(np.arange(len(texts)), n_words)
    of_word = first[doc] + (np.arange(len(begin)) - n_before[doc]) // WORDS
    total = int(n_passages.sum())
    words = np.bincount(of_word, minlength=total)
    # bytes belong to the passage of the last word begun in their text
    word_of_byte = np.cumsum(np.bincount(begin, minlength=len(buffer))) - 1
    doc_of_byte = np.repeat(np.arange(len(texts)), ends - starts)
    of_byte = np.where(word_of_byte >= n_before[doc_of_byte], of_word[np.maximum(word_of_byte, 0)] if len(of_word) else 0, first[doc_of_byte])
    kinds = np.bincount(of_byte * 6 + _KIND[buffer], minlength=total * 6).reshape(total, 6).astype(np.float32)
    x = np.zeros((total, SIZE), np.float32)
    if len(buffer) > 2:
        mixed = _MIX[0][buffer[:-2]] + _MIX[1][buffer[1:-1]] + _MIX[2][buffer[2:]]
        mixed = (mixed ^ mixed >> np.uint32(15)) % np.uint32(TRIGRAM_BINS)
        own = np.ones(len(buffer), bool)  # trigrams that begin in a text end in the two spaces behind it
        own[ends - 1] = own[ends - 2] = False
        own = np.flatnonzero(own)
        counts = np.bincount(of_byte[own] * TRIGRAM_BINS + mixed[own], minlength=total * TRIGRAM_BINS).reshape(total, -1)
        x[:, :TRIGRAM_BINS] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    if len(begin):
        sums = _sums(_WORD_BYTES[buffer])
        name = (sums[stop] - sums[begin]) * np.uint64(0x9E3779B97F4A7C15) + _WORD_BYTES[buffer[begin]] * (stop - begin).astype(np.uint64)
        by = np.lexsort((name, of_word))
        new = np.ones(len(by), bool)
        new[1:] = (name[by][1:] != name[by][:-1]) | (of_word[1:] != of_word[:-1])
        distinct = np.bincount(of_word[new], minlength=total)
        length = np.bincount(of_word, weights=stop - begin, minlength=total)
        n = np.maximum(words, 1)
        size = np.maximum(kinds[:, 1:].sum(1), 1)
        x[:, TRIGRAM_BINS:] = np.stack([
            distinct / n, np.minimum(length / n / 10, 3), kinds[:, 2] / size, kinds[:, 3] / size, kinds[:, 4] / size,
            kinds[:, 5] / size, np.log1p(words) / 5, words > 0], axis=1)
    return x, n_passages


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bins(texts: list[bytes], bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bin) of the distinct bins of each text's words, in order,
    and the words of each text. A-Z count as a-z; only letters of a word and
    bytes beyond ASCII name its bin, so marks around it do not matter."""
    buffer = _LOWER[np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = ~_SPACE[buffer]
    begin = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    stop = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
    doc = np.searchsorted(ends, begin, "right")
    kind = _KIND[buffer]
    letter = (kind == 1) | (kind == 5)
    sums = _sums(np.where(letter, _WORD_BYTES[buffer], np.uint64(0)))
    pairs = _sums(np.where(letter[1:] & letter[:-1], _WORD_BYTES[buffer[1:]] * (_WORD_BYTES[buffer[:-1]] | np.uint64(1)), np.uint64(0)))
    name = (sums[stop] - sums[begin]) + (pairs[stop - 1] - pairs[begin]) * np.uint64(0x9E3779B97F4A7C15)
    bin_ = ((name ^ name >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(bins)
    key = np.unique(doc * bins + bin_.astype(np.int64))
    return key // bins, key % bins, np.bincount(doc, minlength=len(texts))
