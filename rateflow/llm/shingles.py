"""Words, word shingles and probability Jaccard, on plain Python and numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = 5
#: Values this near below a threshold are at it: the sums' last digits depend on which set comes first.
ROUNDING = 1e-9
_WORD = re.compile(r"\w+")
_MIX = [np.uint64(int(x) | 1) for x in np.random.default_rng(3).integers(1 << 40, 1 << 62, WORDS)]


class WordHashes(dict):
    """64-bit hash of each word, remembered (up to 100,000 words of at most 40 letters: some 20 MB)."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            if len(self) >= 100_000:
                self.clear()
            self[word] = found
        return found


_hashes = WordHashes()


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the text's words, lower-cased and without marks."""
    words = _WORD.findall(text.lower())
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of five words and how often each occurs. Fewer words are one shingle;
    no words, none."""
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = max(1, len(words) - WORDS + 1)
    h = np.full(n, len(words[:WORDS]), np.uint64)
    for i in range(min(WORDS, len(words))):
        h = (h ^ (h >> np.uint64(29))) * _MIX[i] + words[i:i + n]
    h ^= h >> np.uint64(32)
    return np.unique(h, return_counts=True)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], at_least: float = 0.0) -> float:
    """Probability Jaccard of two weighted sets: the sum over common elements d of
    1 / sum over e of max(x_e / x_d, y_e / y_d). It is 1 for equal weights (up to a factor) and
    the plain Jaccard for sets. Values certainly below ``at_least`` are given as 0."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    a, b = x[1] / x[1].sum(), y[1] / y[1].sum()
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    both = y[0][at] == x[0]
    mine, theirs = a[both], b[at[both]]
    if np.minimum(mine, theirs).sum() < at_least - ROUNDING:  # a bound: each sum over e is 1 / min at least
        return 0.0
    # sum over e of max(a_e, t * b_e) at each common ratio t, by sums over sorted ratios
    alone = np.ones(len(b), bool)
    alone[at[both]] = False
    ratio = mine / theirs
    order = np.argsort(ratio)
    ratio, mine, theirs = ratio[order], mine[order], theirs[order]
    lower = np.concatenate(([0.0], np.cumsum(theirs)))
    upper = np.concatenate(([0.0], np.cumsum(mine)))
    below = np.searchsorted(ratio, ratio)
    total = a[~both].sum() + (upper[-1] - upper[below]) + ratio * (lower[below] + b[alone].sum())
    return float((mine / total).sum())
