"""BPE (1), packing (2) and token files (6) against the tokenizers library and brute force."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quarry.llm.bpe import WordBpe, encode_decode, encode_decode_digests
from quarry.llm import subwords
from quarry.llm.packing import _dominated, _fillings, best_fit, lower_bound, pack, plan_bins, slots_of
from quarry.llm.subwords import LibraryEncoder
from quarry.llm.tokenfiles import read_token_files, write_token_files

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
PIECES = ["a", "b", "the", "THE", "'s", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "É", "é", "Σ", "ΣΑΣ", "İ", "ß", "1", "23", "½",
          "<|endoftext|>", "<|startoftext|>", "<|endoftext", ".", "!!", "😀", "👍🏽", "中文", "́", "ﬁ", "aaaaaa", "aaaaaaaaaaa", "----", "​", "\x00", "ñ"]
ODD = [None, "", "   ", " x", "x ", "x" * 3000, "word " * 5000, "a\n \nb", "é" * 10]
DOCS = [(1, "hello world"), (2, None), (3, ""), (4, "hello world"), (None, "no id"), (7, "word " * 3000), (7, "same id"), (9, "tail <|endoftext|> end"), (10, "x")]


def texts():
    rng = random.Random(3)
    return ODD + ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 30))) for _ in range(1500)]


@pytest.mark.parametrize("path,own", [(WORD, WordBpe), (BYTE, LibraryEncoder)])
def test_encoders_give_the_librarys_ids(path, own):
    library, mine = Tokenizer.from_file(path), own(path)
    ids, sizes = mine.encode(texts())
    at = 0
    for text, n in zip(texts(), sizes, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids[at : at + n].tolist() == want, text
        if own is WordBpe:
            assert mine.decode(want).decode() == library.decode(want, skip_special_tokens=False)
        at += n


def frame(spark, rows=DOCS):
    return spark.createDataFrame([(i, t, "lang", 5, "clash") for i, t in rows], "doc_id long, text string, ids string, piece int, n_tokens string")


def test_round_trip_rows(spark):
    library = Tokenizer.from_file(WORD)
    got = sorted(map(tuple, encode_decode_digests(frame(spark), WORD).collect()), key=str)
    want = []
    for i, t in DOCS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    row = encode_decode(frame(spark).where("doc_id = 1"), WORD).first()
    assert row.ids == library.encode("hello world", add_special_tokens=False).ids and row.decoded == library.decode(row.ids)
    assert encode_decode_digests(frame(spark, []), WORD).count() == 0


def with_end(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_token_files_hold_every_document_in_order(spark):
    library = Tokenizer.from_file(BYTE)
    got = [tuple(r) for r in read_token_files(*write_token_files(frame(spark), BYTE)).orderBy("start").collect()]
    start, want = 0, []
    for i, t in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = with_end(library, t)
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    assert read_token_files(*write_token_files(frame(spark, []), BYTE)).count() == 0


def test_packing_is_gapless_and_whole(spark):
    library = Tokenizer.from_file(BYTE)
    rows = pack(frame(spark), BYTE, capacity=64).collect()
    want = sorted((str(i), len(with_end(library, t))) for i, t in DOCS)
    found, bins, first = defaultdict(int), defaultdict(list), {}
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        found[str(r.doc_id)] += r.length
        assert r.length <= 64 and (r.piece == 0 or r.length == 64)
        first.setdefault((r.doc_id, r.ids_crc32), r)
    total = defaultdict(int)
    for i, n in want:
        total[i] += n
    assert found == total
    for v in bins.values():
        v.sort()
        assert [o for o, _ in v] == [sum(n for _, n in v[:k]) for k in range(len(v))] and sum(n for _, n in v) <= 64
    long_ids = with_end(library, "word " * 3000)
    assert any(zlib.crc32(long_ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.piece == 3 for r in rows if r.doc_id == 7)
    assert pack(frame(spark, []), BYTE).count() == 0


def fewest(items, capacity):
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= items[k]:
                at = bins.index(room)
                place(k + 1, [*bins[:at], room - items[k], *bins[at + 1 :]])
        place(k + 1, [*bins, capacity - items[k]])

    place(0, [])
    return best[0]


def test_search_goes_beyond_best_fit_and_is_complete():
    counts = np.bincount([6, 6, 4, 4, 4, 3, 3], minlength=16)               # best fit: 6 6 3, 4 4 4 3; exact
    assert sum(n for _, n in plan_bins(counts, 15)) == 2
    better = 0
    rng = random.Random(8)
    for _ in range(60):
        items = sorted((rng.randint(15, 60) for _ in range(12)), reverse=True)
        counts = np.bincount(items, minlength=101)
        found, first = sum(n for _, n in plan_bins(counts, 100)), sum(n for _, n in best_fit(counts, 100))
        assert found == fewest(items, 100)
        better += found < first
    assert better


def test_fillings_are_all_undominated_ones():
    counts = np.bincount([9, 7, 7, 5, 4, 3, 3, 1], minlength=21)
    want = set()
    for k in range(7):
        for some in combinations([9, 7, 7, 5, 4, 3, 3, 1], k):
            if sum(some) <= 18 and not _dominated(counts, list(some), 18 - sum(some)):
                want.add(tuple(sorted(some)))
    found = [tuple(sorted(f)) for f in _fillings(counts, 18, 18) if f is not None]
    assert set(found) == want and len(found) == len(want)
    assert [f for f in _fillings(np.zeros(6, int), 5, 5)] == [[]]


def test_units_are_kept_by_how_often_they_are_asked_for(monkeypatch):
    monkeypatch.setattr(subwords, "MAX_UNITS", 60)
    monkeypatch.setattr(subwords, "KEPT_UNITS", 10)
    library, mine = Tokenizer.from_file(BYTE), LibraryEncoder(BYTE)
    for k in range(20):
        some = [f" the often seen {k}x{j} words, and rare{k * j}" for j in range(30)] + ["the often"]
        ids, sizes = mine.encode(some)
        assert [list(x) for x in np.split(ids, np.cumsum(sizes)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert "often" in mine.store.index and len(mine.store.index) < 400


def test_bin_completion_is_optimal_on_small_inputs():
    rng = random.Random(1)
    for k in range(200):
        capacity = rng.choice([10, 20, 50, 100])
        near = [capacity // 3, capacity // 2, capacity // 3 + 1, capacity // 4, capacity // 2 + 1, capacity // 5 + 1]
        items = sorted((rng.randint(1, capacity) if k % 2 else rng.choice(near) for _ in range(rng.randint(0, 11))), reverse=True)
        counts = np.bincount(items, minlength=capacity + 1) if items else np.zeros(capacity + 1, np.int64)
        plan = plan_bins(counts, capacity)
        used = np.zeros(capacity + 1, int)
        for filling, n in plan:
            assert sum(a * b for a, b in filling) <= capacity
            for size, each in filling:
                used[size] += each * n
        best = fewest(items, capacity)
        assert (used == counts).all() and sum(n for _, n in plan) == best and lower_bound(counts, capacity) <= best
        slots = slots_of(plan)
        assert len(slots) == sum(len(f) for f, _ in plan)
