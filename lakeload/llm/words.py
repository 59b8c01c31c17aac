"""Words of a text as 64-bit hashes, and hashes of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

from lakeload.llm.scratch import worker_cache

#: Distinct words a Python worker remembers before it starts anew.
REMEMBERED_WORDS = 300_000

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64


class WordHashes(dict):
    """word (UTF-8 bytes) -> 64-bit hash; forgets everything when full, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@worker_cache
def word_hashes() -> WordHashes:
    return WordHashes()


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (``\\x20``, ``\\x09``-``\\x0D``), A-Z in lower case; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(word_hashes().__getitem__, words), U64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value (a finaliser of the splitmix kind)."""
    x = values ^ (values >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbouring words, by position; fewer words are one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(width, n)
    total = hashes[: n - size + 1].copy()
    for j in range(1, size):
        total = total * MULTIPLIER + hashes[j : n - size + 1 + j]
    return mixed(total + U64(size))
