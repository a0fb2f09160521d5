"""Words of a text and their 64-bit hashes. Words are what stands between ASCII white space, A-Z lower-cased."""

from __future__ import annotations

import numpy as np
import xxhash

from quarry.llm.common import process_cache

#: The word cache is emptied beyond this many words.
MAX_WORDS = 300_000
#: Odd constants that tell the places of a shingle apart.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    cache = process_cache("words").setdefault("words", WordHashes())
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    h = np.sort(h)
    if len(h) > 1:
        keep = np.empty(len(h), bool)
        keep[0] = True
        np.not_equal(h[1:], h[:-1], out=keep[1:])
        h = h[keep]
    return h


def shingles_of(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of the runs of ``size`` words; the whole sequence as one with fewer words; none without words."""
    words: list[bytes] = []
    ends = []
    for text in texts:
        words += words_of(text)
        ends.append(len(words))
    h = word_hashes(words)
    runs = np.zeros(max(0, len(h) - size + 1), np.uint64)                  # of the whole block; those across two texts aren't used
    for i in range(size):
        runs += h[i : i + len(runs)] * PLACES[i % len(PLACES)] ** np.uint64(1 + i // len(PLACES))
    runs = mixed(runs + np.uint64(size))
    out, at = [], 0
    for end in ends:
        k = min(size, end - at)
        if k == size:
            out.append(distinct(runs[at : end - size + 1]))
        else:
            total = np.zeros(1 if k else 0, np.uint64)
            for i in range(k):
                total += h[at + i : at + i + 1] * PLACES[i % len(PLACES)] ** np.uint64(1 + i // len(PLACES))
            out.append(mixed(total + np.uint64(k)))
        at = end
    return out


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    return shingles_of([text], size)[0]
