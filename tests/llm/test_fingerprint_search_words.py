"""Parsing fingerprints, best-position search and permuterm variants against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from arqueo.llm import best_position, parsing_fingerprint, permuterm, queries

M = 2**64 - 1


# ---- parsing fingerprints -------------------------------------------------

def plain_mix(x):
    x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & M
    x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & M
    return x ^ (x >> 33)


def plain_label(left, own):
    if left is None:
        return own & 1
    low = (left ^ own) & -(left ^ own)
    return 2 * (low.bit_length() - 1) + (1 if own & low else 0)


def plain_phrases(text):
    """Names of the phrases of each level, and how many code points each spans."""
    symbols, out = [(ord(c), 1) for c in text], []
    while symbols and (len(symbols) > 1 or not out):
        runs = []
        for s, n in symbols:
            if runs and runs[-1][0] == s:
                runs[-1] = (s, runs[-1][1] + 1, runs[-1][2] + n)
            else:
                runs.append((s, 1, n))
        symbols = [(s if k == 1 else plain_mix((s * int(parsing_fingerprint.RUN) + k) & M), n) for s, k, n in runs]
        own = [s for s, _ in symbols]
        for _ in range(4):
            own = [plain_label(own[i - 1] if i else None, own[i]) for i in range(len(own))]
        assert max(own) < 6 and all(a != b for a, b in zip(own, own[1:]))
        starts = [0] + [i for i in range(1, len(own) - 1) if own[i - 1] < own[i] > own[i + 1]]
        level = len(out) + 1
        symbols = [(plain_mix((sum(plain_mix((s + j * int(parsing_fingerprint.PLACE)) & M) for j, (s, _) in enumerate(symbols[a:b]))
                               + level * int(parsing_fingerprint.LEVEL[0])) & M), sum(n for _, n in symbols[a:b]))
                   for a, b in zip(starts, [*starts[1:], len(symbols)])]
        out.append(symbols)
    return out


def plain_fingerprint(text):
    best = {}
    for level, symbols in enumerate(plain_phrases(text), 1):
        counts = Counter(plain_mix(s ^ int(parsing_fingerprint.LEVEL[0])) >> 20 for s, _ in symbols)
        for h0, c in counts.items():
            power = 0
            while 2**power <= c:
                h = plain_mix((h0 * int(parsing_fingerprint.RUN) + power) & M)
                weight = (parsing_fingerprint.SHORT_WEIGHT if level == 1 else 1.0) * 2.0 ** max(power - 1, 0)
                value = np.float32(-np.log((((h >> 6) & 0xFFFFFFFF) + 1) / 2.0**32) / weight)
                mark = (value, max(h >> 48, 1))
                best[h % 64] = min(best.get(h % 64, mark), mark)
                power += 1
    return [best[b][1] if b in best else 0 for b in range(64)]


def sample_texts():
    rng = random.Random(3)
    words = ["the", "ñandú", "of", "cc", "aaa", "zu", "日本", "x", "😀😀", "lorem"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    return texts + ["", "a", "ab", "abc", "abcd", "a" * 1000, "ab" * 700, "\n" * 7, "w " * 3000, "q" * 5 + "ab" * 50]


def test_fingerprints_equal_plain_parsing(monkeypatch):
    texts = sample_texts()
    got = parsing_fingerprint.fingerprints(texts)
    assert got.tolist() == [plain_fingerprint(t) for t in texts]
    # one at a time: what else is parsed does not matter
    assert all((parsing_fingerprint.fingerprints([t])[0] == g).all() for t, g in zip(texts, got))
    assert parsing_fingerprint.fingerprints([]).shape == (0, 64)


def test_equal_substrings_share_phrases_at_any_offset():
    rng = random.Random(8)
    body = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    for before, after in (("", "tail"), ("x", ""), ("something else ", "and more"), ("日" * 17, "ab" * 40)):
        a, b = plain_phrases(body), plain_phrases(before + body + after)
        for level in range(3):
            own, other = Counter(s for s, _ in a[level]), Counter(s for s, _ in b[level])
            # but for a few phrases at the two ends
            assert (own - other).total() <= 12, level


def test_likeness_follows_shared_text():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    a, b = (" ".join(rng.choices(words, k=500)) for _ in range(2))
    near = lambda x, y: float(parsing_fingerprint.likeness(*parsing_fingerprint.fingerprints([x, y])))
    assert near(a, a) == near("", "") == 1 and near(a, "") == 0
    assert near(a, "some words before " + a) > 0.9
    assert near(a, parsing_fingerprint.edited(a, b)) > 0.4 > 0.15 > near(a, b)


def brute_results(rows):
    """(id, text) rows, all ids set: results by distinct (id, text)."""
    docs = sorted({(d, t or "") for d, t in rows}, key=lambda x: x[0])
    out = {}
    for (d, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        new = t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        f, g, h = (plain_fingerprint(x) for x in (t, new, after))
        near = lambda x, y: 1.0 if not any(x) and not any(y) else sum(a == b > 0 for a, b in zip(x, y)) / sum(a > 0 or b > 0 for a, b in zip(x, y))
        text = lambda x: np.array(x, "<u2").tobytes().hex()
        out[d] = (len(t), hashlib.sha256(new.encode()).hexdigest(), text(f), text(g), near(f, g), near(f, h))
    return out


def result(rows):
    return Counter((r.doc_id, (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)) for r in rows)


@pytest.mark.parametrize("span", [10, 100_000])
def test_documents_equal_brute_force(spark, make_docs, monkeypatch, span):
    monkeypatch.setattr(parsing_fingerprint, "SPAN", span)
    texts = sample_texts()
    rows = [(7 * i % 101, t) for i, t in enumerate(texts)] + [(200, None), (201, "same"), (202, "same")]
    # repeated rows: a hot one that fills whole parts, one at the end
    rows += [(150, "a repeated row of text")] * 400 + [(203, "last one")] * 3
    docs = make_docs(rows).repartition(5)
    want = brute_results(rows)
    assert result(parsing_fingerprint.fingerprint_documents(docs).collect()) == Counter((d, want[d]) for d, _ in rows)


def test_documents_odd_rows(spark, make_docs):
    one = make_docs([(5, "all alone in the table")])
    assert result(parsing_fingerprint.fingerprint_documents(one).collect()) == Counter([(5, brute_results([(5, "all alone in the table")])[5])])
    assert parsing_fingerprint.fingerprint_documents(one.limit(0)).count() == 0
    # a null id comes first, so the last document's next is it; equal ids go by the hashes of their texts
    docs = make_docs([(None, "first of all texts"), (1, "one text or more"), (1, "two texts or more"), (9, "the last of all texts")])
    got = {(r.doc_id, r.n_chars): r for r in parsing_fingerprint.fingerprint_documents(docs).collect()}
    assert len(got) == 4
    assert got[9, 21].edited_sha256 == hashlib.sha256(parsing_fingerprint.edited("the last of all texts", "first of all texts").encode()).hexdigest()
    long = make_docs([(1, "very long text " * 40_000), (2, "x")])
    assert {r.doc_id: r.n_chars for r in parsing_fingerprint.fingerprint_documents(long).collect()} == {1: 600_000, 2: 1}


def test_fingerprint_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_results(rows)
    assert result(queries.op11(spark, sf).collect()) == Counter((d, want[d]) for d, _ in rows)


# ---- best positions -------------------------------------------------------

TERM = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_search(docs, items, k):
    """Rows (item, rank, doc, score), by the formulas alone."""
    own = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n_docs, n_terms = len(own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for d, c in own:
            m = 75 + 25 * c.total() * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                scored.append((-s, d is not None, d if d is not None else 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def found(df):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, make_docs, monkeypatch, small):
    if small:  # many chunks, rounds and query blocks
        for name, value in (("CHUNK", 50), ("STEP", 1), ("BLOCK", 60)):
            monkeypatch.setattr(best_position, name, value)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "éa", "THE", "the", "日本"]
    text = lambda n: " ".join(words[min(int(rng.expovariate(0.08)), 64)] + rng.choice(["", ",", "!"]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(300)]
    # ties: equal texts under many ids; repeated rows; a null id and a null text; a very long text
    docs += [(i, "w1 w2 w3 tie") for i in range(400, 430)] + [(500, "w5 tie")] * 4 + [(None, "w1 w2 w3 tie"), (501, None), (502, ""), (503, " .,! "), (504, "w7 " * 50_000)]
    items = [(0, "tie w1"), (1, text(30)), (2, "w5 w5 w5 the THE"), (3, "unknown"), (4, None), (5, ""), (6, text(4)), (6, "w0"), (7, " ".join(words)), (8, "w9"), (8, "w9"), (None, "w3 É")]
    frame = spark.createDataFrame([(*x, "extra") for x in items], "item_id bigint, text string, rank string")
    assert found(best_position.search(make_docs(docs), frame, 5)) == brute_search(docs, items, 5)


def test_search_odd_tables(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert found(best_position.search(docs, items)) == brute_search([(1, "a b"), (2, None)], [(1, "a")], 20)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text IS NULL"), items)):
        assert best_position.search(d, i).collect() == []
    # a word in every document still weighs ln((2N + 2) / (2N + 1))
    every = [(i, "all " + "x" * i) for i in range(30)]
    assert found(best_position.search(make_docs(every), spark.createDataFrame([(1, "all")], "item_id bigint, text string"))) == brute_search(every, [(1, "all")], 20)


def lists(postings, n_docs, n_terms):
    doc, term, impact = (np.array(x, np.int64) for x in zip(*postings))
    return best_position.ImpactLists(doc, term, impact, n_docs, n_terms)


def test_best_positions_run_ahead_of_reads(monkeypatch):
    """Documents met in one list are seen in the other, so that its best position lies beyond what was read."""
    monkeypatch.setattr(best_position, "STEP", 1)
    # list 0: documents 0, 1, 2 ...; list 1: 1, 0, 3, 2 ...: both are read alike, so seen places are contiguous
    postings = [(d, 0, 1000 - d) for d in range(100)] + [(d ^ 1, 1, 1000 - d) for d in range(100)]
    trace = {}
    docs, scores = lists(postings, 100, 2).search([(0, 1), (1, 1)], 1, np.empty(0, np.int64), trace)
    assert docs.tolist() == [0] and scores.tolist() == [1999]
    assert min(trace["ends"]) >= trace["read"] and trace["n_scored"] < 100
    # equal scores below the bound: a tie at the bound is read on, for a smaller id
    tied = [(d, 0, 5) for d in range(50)]
    docs, _ = lists(tied, 50, 1).search([(0, 1)], 3, np.empty(0, np.int64))
    assert docs.tolist() == [0, 1, 2]
    # an earlier k-th score ends the search at once, an equal one does not
    trace = {}
    lists(postings, 100, 2).search([(0, 1), (1, 1)], 1, np.array([2500]), trace)
    assert trace["n_scored"] == 2
    trace = {}
    lists([(d, 0, 9) for d in range(40)], 40, 1).search([(0, 1)], 1, np.array([9]), trace)
    assert trace["n_scored"] == 40


def test_chunks_keep_all_rows(monkeypatch):
    monkeypatch.setattr(best_position, "CHUNK", 7)
    sizes = [0, 3, 9, 1, 1, 1, 7, 0, 0, 20, 2]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(sizes), pa.array([b"\0" * 4 * n for n in sizes], pa.binary())], names=["id", "n", "t"])
    parts = [c.column("id").to_pylist() for c in best_position.chunks(iter([batch.slice(0, 5), batch.slice(5)]))]
    assert sum(parts, []) == list(range(len(sizes))) and len(parts) > 3


# ---- permuterm ------------------------------------------------------------

def brute_words(docs, damage=97):
    n = Counter()
    for d, t in docs:
        for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            x = x.translate(LOWER)
            if damage:
                h = zlib.crc32(f"{'' if d is None else d}:{x}".encode())
                if h % damage == 0:
                    x = x[:h % len(x)] + x[h % len(x) + 1:]
            n[x] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    near = defaultdict(list)
    for w in words:
        for v in words:
            if abs(len(w) - len(v)) < 2 and one_edit(w, v):
                near[w].append(v)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v))
        if words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("damage", [None, 3])
def test_variants_equal_brute_force(spark, make_docs, damage):
    rng = random.Random(6)
    base = ["".join(rng.choice("abñÀ") for _ in range(rng.randint(4, 8))) for _ in range(25)] + ["aaaaa", "aaaaaa", "aaaaab", "abababab"]
    docs = []
    for d in range(150):
        own = []
        for _ in range(rng.randint(0, 25)):
            w = list(base[min(int(rng.expovariate(0.2)), len(base) - 1)])
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                rng.choice([lambda: w.pop(i), lambda: w.insert(i, rng.choice("abÿ×")), lambda: w.__setitem__(i, rng.choice("ABñ"))])()
            own.append("".join(w))
        docs.append((d, rng.choice([" ", "-", "1"]).join(own)))
    docs += [(900, None), (901, ""), (902, "12 34"), (None, "aaaaa bbbbb aaaaa"), (903, "long" * 4000 + " " + "aaaaa " * 3000)] + [(904, "bbbbb bbbbc")] * 4
    got = variants(permuterm.group_words(make_docs(docs), damage_every=damage))
    words = brute_words(docs, damage)
    assert got == brute_variants(words) and len(words) > 40


def test_variants_odd_tables(spark, make_docs):
    assert permuterm.group_words(make_docs([(1, None)]).limit(0)).collect() == []
    assert permuterm.group_words(make_docs([(1, "rare words only")])).collect() == []
    words = spark.createDataFrame([("abcde", 10), ("abcdf", 10), ("abcd", 5), ("zzzzz", 7)], "word string, n long")
    # the tie goes to the smaller word; equal frequency is no form; a word without near words is its own root
    assert variants(permuterm.spelling_variants(words)) == {
        "abcde": (None, "abcde", 10, 2, None), "abcdf": (None, "abcdf", 10, 2, None), "abcd": ("abcde", "abcde", 5, 2, 10), "zzzzz": (None, "zzzzz", 7, 0, None)}
    with pytest.raises(ValueError):
        permuterm.spelling_variants(words, ratio=1)
    ladder = spark.createDataFrame([("a" * i, 3 * 2**i) for i in range(5, 24)], "word string, n long")
    assert {r.root for r in permuterm.spelling_variants(ladder).collect()} == {"a" * 23}


def test_groups_are_bounded_by_the_alphabet(spark):
    """All words of one shape: no prefix holds more rotations than letters and the word without one."""
    letters = "abcdefghij"
    words = spark.createDataFrame([("".join((a, b, c)) + "tion", 5) for a in letters for b in letters for c in letters], "word string, n long")
    sizes = permuterm.rotations(words).groupBy("prefix").count().agg({"count": "max"}).first()[0]
    assert sizes == len(letters)
    assert {r.n_near for r in permuterm.neighbours(words).collect()} == {27}
