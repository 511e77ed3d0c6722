"""Hashed features of words: the word itself and its character n-grams."""

import numpy as np

from tripstats.llm.common import mixed

_BASE = np.uint64(0x100000001B3)
# Code points outside Unicode mark the ends of a word.
_START, _END = 0x110000, 0x110001


def word_features(words: list[str], sizes: range, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids below ``buckets`` of all words, one word after the other, and where each
    word's begin (one more entry than words).  A word of ``n`` characters and two end marks has
    one feature for itself and one for each of its n-grams of the given sizes."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    lengths = np.array([len(word) for word in words], dtype=np.int64) + 2
    ends = np.cumsum(lengths)
    codes = np.empty(ends[-1], dtype=np.uint64)
    inner = np.ones(ends[-1], dtype=bool)
    inner[ends - 1] = inner[ends - lengths] = False
    codes[ends - 1], codes[ends - lengths] = _END, _START
    codes[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(ends, lengths) - np.arange(ends[-1])
    place = np.repeat(lengths, lengths) - left
    # The whole word: a polynomial of its codes.
    powers = np.ones(int(lengths.max()), dtype=np.uint64)
    if len(powers) > 1:
        powers[1:] = _BASE
        powers = np.multiply.accumulate(powers)
    whole = np.add.reduceat(mixed(codes) * powers[place], ends - lengths)
    owners, hashes = [np.arange(len(words))], [whole ^ np.uint64(1)]
    rolling = np.zeros(ends[-1], dtype=np.uint64)
    for n in range(1, sizes.stop):
        valid = len(codes) - n + 1
        if valid <= 0:
            break
        rolling = rolling[:valid] * _BASE + mixed(codes[n - 1 :])
        if n in sizes:
            fits = left[:valid] >= n
            owners.append(owner[:valid][fits])
            hashes.append(rolling[fits] + np.uint64(n << 8))
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners, kind="stable")
    ids = (mixed(hashes[order]) % np.uint64(buckets)).astype(np.int64)
    counts = np.bincount(owners, minlength=len(words))
    return ids, np.concatenate([[0], np.cumsum(counts)])
