"""Encoding of many texts through a cache of text units.

A unit is what stands between two spaces, with the space before it. Where every space
is followed by a character that is no white space, the byte-level splitting rule always
begins a new token at the space, so units can be encoded one by one and in any order;
other texts are encoded whole.
"""

from __future__ import annotations

import re

import numpy as np

from quarry.llm.common import offsets_of, process_cache, ragged

LOOSE_SPACE = re.compile(r" (?!\S)")
#: Beyond this many units or characters the cache keeps the units it was asked for most, so many of them and of their characters.
MAX_UNITS, MAX_CHARS = 400_000, 8_000_000
KEPT_UNITS, KEPT_CHARS = 200_000, 4_000_000
#: Units that are encoded as one text.
JOINED = 256


class Places(dict):
    """Units to their places; a new unit gets the next place and is listed in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = place = len(self)
        self.new.append(unit)
        return place


class UnitStore:
    """Maps units to runs of ids in one flat array; ``encode_new`` encodes units it has not seen."""

    def __init__(self, encode_new):
        self.encode_new = encode_new
        self.kept: np.ndarray | None = None     # after it shrank: the places that the units it holds had before
        self.clear()

    def clear(self) -> None:
        self.index = Places()
        self.at = np.zeros(0, np.int64)         # places of the units encoded last
        self.flat, self.starts, self.lengths, self.asked = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = self.chars = 0

    def shrink(self) -> None:
        """Keep the units asked for most; their counts are halved, so that what is no longer asked for goes in time."""
        units = list(self.index)
        order = np.argsort(-self.asked[: len(units)], kind="stable")[:KEPT_UNITS]
        sizes = np.fromiter((len(units[i]) for i in order.tolist()), np.int64, len(order))
        order = np.sort(order[np.cumsum(sizes) <= KEPT_CHARS])
        lengths, asked = self.lengths[order], self.asked[order] // 2
        flat = ragged(self.flat, self.starts[order], lengths)
        kept = [units[i] for i in order.tolist()]
        self.clear()
        for unit in kept:
            self.index[unit] = len(self.index)
        self._store(kept, flat, lengths)
        self.asked[: len(kept)] = asked
        self.kept = order

    def _grow(self, name: str, need: int) -> None:
        old = getattr(self, name)
        if need > len(old):
            new = np.zeros(max(need, 2 * len(old)), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def _store(self, units: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        """Ids of the units that were placed last."""
        k = len(units)
        n = len(self.index) - k
        for name in ("starts", "lengths", "asked"):
            self._grow(name, n + k)
        self._grow("flat", self.used + len(flat))
        self.flat[self.used : self.used + len(flat)] = flat
        self.lengths[n : n + k] = lengths
        self.starts[n : n + k] = self.used + offsets_of(lengths)[:-1]
        self.used += len(flat)
        self.chars += sum(map(len, units))

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after another, and each unit's number of ids."""
        if len(self.index) > MAX_UNITS or self.chars > MAX_CHARS:
            self.shrink()
        at = self.at = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
        if new := self.index.new:
            self.index.new = []
            self._store(new, *self.encode_new(new))
        self.asked[: len(self.index)] += np.bincount(at, minlength=len(self.index))
        return ragged(self.flat, self.starts[at], self.lengths[at]), self.lengths[at]


class LibraryEncoder:
    """Whole texts to ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, for a byte-level tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocab_size = self.tokenizer.get_vocab_size()
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.opens = np.zeros(size, bool)      # ids whose text begins with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")
        self.store = UnitStore(self.encode_units)

    @staticmethod
    def cached(path: str) -> LibraryEncoder:
        cache = process_cache("library")
        if ("library", path) not in cache:
            cache["library", path] = LibraryEncoder(path)
        return cache["library", path]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Key ' x' is the unit x at a text's start; key 'x' is the unit x after a space."""
        first = [i for i, u in enumerate(units) if u[:1] == " "]
        if not first:
            return self._after_spaces(units)
        later = [i for i, u in enumerate(units) if u[:1] != " "]
        flat, sizes = self._after_spaces([units[i] for i in later])
        runs = self._whole([units[i][1:] for i in first])
        lengths = np.zeros(len(units), np.int64)
        lengths[later], lengths[first] = sizes, np.fromiter(map(len, runs), np.int64, len(runs))
        starts = np.zeros(len(units), np.int64)                            # in the later units' ids, then the first ones'
        starts[later], starts[first] = offsets_of(sizes)[:-1], len(flat) + offsets_of(lengths[first])[:-1]
        return ragged(np.concatenate([flat, *runs]), starts, lengths), lengths

    def _after_spaces(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that each follow a space; many are encoded as one text, and each begins at an id that begins with a space."""
        flat, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(units), JOINED):
            some = units[at : at + JOINED]
            [ids] = self._whole([" " + " ".join(some)])
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) == len(some) and begins[0] == 0:
                flat.append(ids)
                lengths.append(np.diff(begins, append=len(ids)))
            else:
                runs = self._whole([" " + u for u in some])
                flat += runs
                lengths.append(np.fromiter(map(len, runs), np.int64, len(runs)))
        return np.concatenate(flat), np.concatenate(lengths)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, each text's number of ids); None counts as empty."""
        units: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        odd: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if LOOSE_SPACE.search(text):
                [odd[i]] = self._whole([text])
                continue
            words = text.split(" ")
            words[0] = " " + words[0]
            units += words
            counts[i] = len(words)
        ids, lengths = self.store.encode(units)
        ends = offsets_of(lengths)[np.cumsum(counts)] if len(texts) else np.zeros(0, np.int64)
        sizes = np.diff(ends, prepend=0)
        if odd:
            runs = np.split(ids, ends[:-1])
            for i, run in odd.items():
                runs[i], sizes[i] = run, len(run)
            ids = np.concatenate(runs)
        return ids, sizes
