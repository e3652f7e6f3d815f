"""BPE against the tokenizers library; packing: whole, gapless, within the capacity and near the lower bound."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from arqueo.llm import bpe, packing, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.tokenizer_path())


@pytest.fixture(scope="module")
def own():
    return bpe.loaded(bpe.tokenizer_path())


TRICKY = ["", " ", "a", "Hello, World's 2nd 'LL don't", "<|endoftext|>", "Hi<|startoftext|>x <|ENDOFTEXT|>y", "ΑΣ Σ ς É e\u0301 İ", "\x1c\x85\u00a0x\u2003y",
          "😀 日本語 ½²", "x" * 3000, "\t\n\x0b\x0c\r", "''s'S", "#!$%" * 30]


def test_tricky_texts_equal_the_library(library, own):
    ids, raw = bpe.TextIds(own), bpe.TextBytes(own)
    for text, data in zip(TRICKY, raw.batch(TRICKY)):
        want = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want
        assert ids(text) == (" ".join(map(str, want)), library.decode(want, skip_special_tokens=False))
        assert np.frombuffer(data, dtype="<u4").tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=60))
def test_any_text_equals_the_library(text):
    lib, own = tokenizers.Tokenizer.from_file(bpe.tokenizer_path()) if not hasattr(bpe, "_lib") else bpe._lib, bpe.loaded(bpe.tokenizer_path())
    bpe._lib = lib
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids
    assert bpe.TextBytes(own).batch([text])[0] == np.array(own.encode(text), dtype="<u4").tobytes()


def test_cache_overflow_keeps_results(own):
    words = ["".join(random.Random(i).choices("abcdefgh", k=6)) for i in range(500)]
    small = bpe.TextIds(own)
    small.cache.limit = 10
    raw = bpe.TextBytes(own, limit=10)
    for i in range(0, 500, 50):
        text = " ".join(words[i:i + 50] + words[:20])
        want = own.encode(text)
        assert small(text)[0] == " ".join(map(str, want))
        assert raw.batch([text])[0] == np.array(want, dtype="<u4").tobytes()
    assert len(small.cache) <= 10


def test_known_words_are_not_parted_or_merged_again(own, monkeypatch):
    """A batch works on what is new to it: letters with a sign need no pattern, and only unseen words are merged."""
    raw = bpe.TextBytes(own)
    raw.batch(["One two three."])
    parted, merged = [], []
    words, rows = own.words, raw.merged.merge
    monkeypatch.setattr(own, "words", lambda c: parted.append(c) or words(c))
    monkeypatch.setattr(raw.merged, "merge", lambda data, size: merged.extend(bytes(d[:n]) for d, n in zip(data, size)) or rows(data, size))
    texts = ["two, one! THREE: four? four", " four. "]
    got = raw.batch(texts)
    assert sorted(merged) == [b"four", b"three"] and not any(parted)
    monkeypatch.undo()
    assert got == [np.array(own.encode(t), dtype="<u4").tobytes() for t in texts]


def test_chunks_in_columns_equal_whole_texts(own):
    """Blanks at the ends, signs after long and accented words, specials and rare blanks between them, over batches with a small cache."""
    texts = ["", "  ", " \ta.\x0b\x0cb \n", "w" * 70 + ". é.", "w" * 24 + "! " + "w" * 25 + "?", "Ünï, Ünï. ünï", "a.<|endoftext|>a. b", "x\u2003y.\x1cz", "..", ". . ,", "a1. b2, 3", "don't. 's,",
             "\u4e2d. \u4e2d\u6587\uff0c", "a.b.c.", "no\u0308el. no\u0308el"]
    raw = bpe.TextBytes(own, limit=3)
    for part in (texts, texts[::-1], texts[3:5] * 2, texts):
        assert raw.batch(part) == [np.array(own.encode(t), dtype="<u4").tobytes() for t in part]
        assert not any(len(c) > bpe.CACHE_LENGTH for c in raw.cache.words.to_pylist())
    assert raw.batch([]) == []


def test_query_equals_the_library(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op5(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_operator_gives_ids_and_text(make_docs, library):
    rows = bpe.encode_decode(make_docs([(1, "The thing."), (2, None), (None, "x"), (1, "The thing.")])).collect()
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in rows) == Counter(
        (d, len(i), tuple(i), library.decode(i, skip_special_tokens=False)) for d, t in [(1, "The thing."), (2, ""), (None, "x"), (1, "The thing.")]
        for i in [library.encode(t, add_special_tokens=False).ids])


def test_large_ids_beside_a_null_stay_whole(spark):
    big = 2**62 + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "c"), (big + 2, None)], "doc_id bigint, text string").coalesce(1)
    assert {r.doc_id for r in bpe.encode_decode(docs, digests=True).collect()} == {big, big + 2, None}
    assert {r.doc_id for r in packing.pack_documents(docs).collect()} == {big, big + 2, None}


def check_packing(rows, texts, encode, capacity, end):
    """Every document whole and in order, every sequence gapless and within the capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.sequence_id is not None and 0 < r.length <= capacity
    for d, copies in texts.items():
        ids = np.array([*encode(copies[0]), end], dtype="<u4")
        cuts = [ids[i:i + capacity] for i in range(0, len(ids), capacity)]
        want = [(p, p * capacity, len(c), zlib.crc32(c.tobytes())) for p, c in enumerate(cuts) for _ in copies]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[d]) == sorted(want)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), math.ceil(sum(r.length for r in rows) / capacity)


def test_packing_query(spark, sf, library):
    texts = {r.doc_id: [r.text or ""] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    used, least = check_packing(queries.op10(spark, sf).collect(), texts, lambda t: library.encode(t, add_special_tokens=False).ids, 4096, 1)
    assert used <= least * 1.02 + 1


def test_packing_odd_rows(make_docs, own):
    docs = make_docs([(1, None), (2, ""), (3, "a b c d e f g"), (3, "a b c d e f g"), (None, "x y"), (4, "word " * 50)])
    texts = {1: [""], 2: [""], 3: ["a b c d e f g"] * 2, None: ["x y"], 4: ["word " * 50]}
    check_packing(packing.pack_documents(docs, capacity=8).collect(), texts, own.encode, 8, 1)
    assert packing.pack_documents(docs.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1), st.just(40))
def test_plan_is_whole_and_tight(counts, capacity):
    left = Counter()
    sequences = 0
    for items, times in packing.plan(counts, capacity):
        assert sum(x * k for x, k in items) <= capacity and times > 0
        sequences += times
        for x, k in items:
            left[x] += k * times
    assert left == Counter(counts)
    # no two of those over half the capacity go together
    least = max(math.ceil(sum(x * n for x, n in counts.items()) / capacity), sum(n for x, n in counts.items() if 2 * x > capacity))
    assert sequences <= least * 1.5 + 1


def test_exact_complements_are_found():
    # 25 + 15, 25 + 10 + 5, 25 + 8 + 4 + 3 each fill 40
    plan = packing.plan({25: 3, 15: 1, 10: 1, 5: 1, 8: 1, 4: 1, 3: 1}, 40)
    assert sum(t for _, t in plan) == 3


def test_frequent_length_is_one_pattern():
    plan = packing.plan({100: 3_000_000, 96: 7}, 4096)
    assert len(plan) < 50 and sum(t for _, t in plan) <= math.ceil((300_000_000 + 672) / 4096 * 1.03)


def brute_fill(have, gap):
    """By enumeration: a single length, else the pair with the longest longer one, else the triple with the longest first one."""
    fits = lambda *x: all(have[y] >= n for y, n in Counter(x).items())
    for n in (1, 2, 3):
        found = [x for x in itertools.combinations_with_replacement(sorted(have, reverse=True), n) if sum(x) == gap and fits(*x)]
        if found:
            return max(found)
    return ()


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1), st.lists(st.integers(1, 20), max_size=25))
def test_index_finds_what_enumeration_finds(counts, gaps):
    """Also as counts run out, which links pairs past."""
    index, have = packing.SumIndex(counts, 20), Counter(counts)
    for gap in gaps:
        got = index.fill(gap)
        assert got == brute_fill(have, gap)
        for x in got:
            index.have[x] -= 1
            have[x] -= 1
            have += Counter()


def test_triple_only_fill_comes_from_the_index():
    counts = {25: 1, 8: 1, 4: 1, 3: 1, 12: 1}
    index = packing.SumIndex(counts, 40)
    asked = []
    real = index.pair
    index.pair = lambda *a, **k: asked.append((a, k)) or real(*a, **k)
    # no single length and no pair makes 15 but 12 + 3; without 12 only 8 + 4 + 3 does
    assert index.fill(15) == (12, 3)
    index.have[12] = 0
    assert index.fill(15) == (8, 4, 3) and asked[-1] == ((7, 8), {"held": 8})
    # what was set aside for a lookup is not taken for run out, and what has run out is not looked at again
    assert index.fill(15) == (8, 4, 3)
    dead = [i for i in range(index.start[15], index.start[16]) if index.next[i] != i]
    assert [int(index.low[i]) for i in dead] == [3]


def best_fit_alone(counts, capacity):
    have, n = Counter(counts), 0
    while have:
        gap, n = capacity, n + 1
        while fits := [x for x in have if x <= gap]:
            gap -= (x := max(fits))
            have[x] -= 1
            have += Counter()
    return n


@pytest.mark.parametrize("low, high, capacity, n", [(10, 60, 100, 400), (200, 2500, 4096, 1500)])
def test_index_needs_fewer_sequences_than_best_fit_alone(low, high, capacity, n):
    rng = np.random.default_rng(6)
    drawn = [Counter(rng.integers(low, high, n).tolist()) for _ in range(5)]
    own, other = ([f(c) for c in drawn] for f in (lambda c: sum(t for _, t in packing.plan(c, capacity)), lambda c: best_fit_alone(c, capacity)))
    assert sum(own) < sum(other) and all(a <= b for a, b in zip(own, other))


def test_pieces_of_one_length(make_docs, own):
    docs = make_docs([(d, "a b c d e f g") for d in range(300)])
    n = len(own.encode("a b c d e f g")) + 1
    rows = packing.pack_documents(docs, capacity=3 * n).collect()
    check_packing(rows, {d: ["a b c d e f g"] for d in range(300)}, own.encode, 3 * n, 1)
    assert len({r.sequence_id for r in rows}) == 100
