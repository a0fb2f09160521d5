"""Byte-pair encoding and decoding in numpy (operator 1).

The symbols of many words lie in one flat array. A round finds each word's pair of lowest
rank and merges all its places at once; ranks come from binary search over the sorted pair keys,
and only pairs next to a merge are searched again. Finished words leave the array.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quarry.llm.common import as_batch, doc_text, offsets_of, process_cache, text_blocks
from quarry.llm.subwords import UnitStore

NONE = np.iinfo(np.int64).max
#: Characters that Python's split() takes as white space and the tokenizer's pattern does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
BATCH_CHARS = 1_000_000


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class WordBpe:
    """A tokenizer file of the kind "white space dropped, lower case, byte-level BPE with a word-end suffix"."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        [split] = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.added = added
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.arange(len(keys))[order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        characters = byte_characters()
        self.inner = np.array([vocab[c] for c in characters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in characters], np.int64)
        self.tokens = [""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in [*vocab.items(), *added.items()]:
            self.tokens[i] = token
        self.utf8 = [t.encode() for t in self.tokens]
        self.decimal = [str(i).encode() for i in range(len(self.tokens))]
        self.store = UnitStore(self.encode_units)

    @staticmethod
    def cached(path: str) -> WordBpe:
        cache = process_cache("bpe")
        if ("bpe", path) not in cache:
            cache["bpe", path] = WordBpe(path)
        return cache["bpe", path]

    def _search(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs that begin at the given places."""
        nxt = np.minimum(at + 1, len(sym) - 1)
        key = sym[at] << 32 | sym[nxt]
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[k] == key) & (nxt > at) & (word[at] == word[nxt])
        return np.where(ok, self.ranks[k], NONE), self.merged[k]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and each word's number of ids. Words aren't empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        if len(words):
            ends = np.cumsum(lengths) - 1
            sym[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank, result = self._search(sym, word, np.arange(len(sym))) if len(sym) else (sym, sym)
        done_ids, done_words = [], []
        while len(sym):
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            low = np.minimum.reduceat(rank, begin)
            sizes = np.diff(begin, append=len(sym))
            lowest = np.repeat(low, sizes)
            over = lowest == NONE
            if over.any():
                done_ids.append(sym[over])
                done_words.append(word[over])
                sym, word, rank, result, lowest = (x[~over] for x in (sym, word, rank, result, lowest))
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == lowest)
            if len(hit) > 1:                                # of overlapping places (a a a) every second one counts
                fresh = np.diff(hit, prepend=-2) != 1
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            sym[hit] = result[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            hit = (np.cumsum(keep) - 1)[hit]
            sym, word, rank, result = sym[keep], word[keep], rank[keep], result[keep]
            near = np.unique(np.concatenate([hit, np.maximum(hit - 1, 0)]))
            rank[near], result[near] = self._search(sym, word, near)
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units hold no white space. Special tokens in a unit are found before anything else."""
        words: list[bytes] = []
        owner: list[int] = []
        fixed: list[tuple[int, int]] = []                    # (place among the words, id)
        for i, unit in enumerate(units):
            pieces = [(unit, None)]
            if self.special and self.special.search(unit):
                pieces, at = [], 0
                for m in self.special.finditer(unit):
                    pieces += [(unit[at : m.start()], None), ("", self.added[m.group()])]
                    at = m.end()
                pieces.append((unit[at:], None))
            for text, special in pieces:
                if special is not None:
                    fixed.append((len(words), special))
                    words.append(b"\0")
                    owner.append(i)
                    continue
                plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()   # no rule for a word's last sigma
                found = self.words.findall(plain)
                words += [w.encode("utf-8", "replace") for w in found]
                owner += [i] * len(found)
        ids, lengths = self.merge(words)
        starts = offsets_of(lengths)
        for k, special in fixed:
            ids[starts[k]] = special                         # the stand-in is one byte, so one id
        return ids.astype(np.uint32), np.bincount(np.array(owner, np.int64), weights=lengths, minlength=len(units)).astype(np.int64) if owner else np.zeros(len(units), np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's number of ids; None counts as empty."""
        units: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = [u for u in WHITE.split(text) if u] if text and SEPARATORS.search(text) else (text or "").split()
            units += found
            counts[i] = len(found)
        ids, lengths = self.store.encode(units)
        return ids, np.diff(offsets_of(lengths)[np.cumsum(counts)], prepend=0) if len(texts) else counts

    def decode(self, ids: list[int]) -> bytes:
        """The tokens' own text with a space between, as the file names no decoder; special tokens stay."""
        return b" ".join(map(self.utf8.__getitem__, ids))


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of each row: a null text is empty, a null doc_id stays null, repeated rows repeat."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.cached(tokenizer)
        for batch, texts in text_blocks(batches, chars=BATCH_CHARS):
            ids, sizes = bpe.encode(texts)
            runs = [r.tolist() for r in np.split(ids, np.cumsum(sizes)[:-1])]
            yield as_batch(schema, batch.column(0), sizes, runs, [bpe.decode(r).decode("utf-8", "replace") for r in runs])

    return doc_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded string")


def encode_decode_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The same round trip, with SHA-256 of the decimal ids and of the decoded text in place of both."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.cached(tokenizer)
        for batch, texts in text_blocks(batches, chars=BATCH_CHARS):
            ids, sizes = bpe.encode(texts)
            runs = [r.tolist() for r in np.split(ids, np.cumsum(sizes)[:-1])]
            yield as_batch(schema, batch.column(0), sizes,
                           [hashlib.sha256(b" ".join(map(bpe.decimal.__getitem__, r))).hexdigest() for r in runs],
                           [hashlib.sha256(bpe.decode(r)).hexdigest() for r in runs])

    return doc_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
