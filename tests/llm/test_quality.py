"""Robust rules, quality classifier and language model against plain recomputation; the pipeline's stages."""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arqueo.llm import log_bilinear, mcd_rules, queries, rff_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    count = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if count[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def stats(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_statistics(spark, sf, make_docs):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: stats(r) for r in queries.op4(spark, sf).collect()} == {d: base(t) for d, t in texts.items()}
    odd = {1: None, 2: "", 3: " \t\x0b", 4: "  é\x1cx a\nb\r\n\na\nb", 5: "a b c d e f g h " * 2, 6: "x " * 20_000, 7: "a b c d e f g h i a b c d e f g h",
           8: "😀 " * 30, 9: " ".join(map(str, range(50_000))), 10: "##|$%&<>*"}
    assert {r.key.id: stats(r) for r in mcd_rules.judge(make_docs(list(odd.items()))).collect()} == {d: base(t) for d, t in odd.items()}


def brute_mcd(vectors, sizes):
    """Squared distances by the same C-steps in numpy: to the end, from two starts, the smaller determinant kept.

    ``sizes``: the documents' characters in words, lines and words.
    """
    p = vectors.shape[1]
    coarse = np.floor(vectors * 100 + 0.5)
    mid = np.median(coarse, axis=0)
    scale = (1.4826 * np.median(np.abs(coarse - mid), axis=0) / 100) ** 2
    medians = np.exp(np.median(np.floor(np.log(sizes) * 100 + 0.5), axis=0) / 100)
    floors = np.diag([*np.square(mcd_rules.FLOORS), 1 / medians[0], 1 / medians[1], mcd_rules.REPEAT / medians[2]])
    consistent = mcd_rules.SUBSET / mcd_rules.chi_square(p + 2, mcd_rules.chi_square_quantile(p, mcd_rules.SUBSET))

    def distance(mean, cov):
        z = vectors - mean
        return np.einsum("ij,ij->i", z @ np.linalg.inv(cov + floors), z)

    ends = []
    for mean, cov in ((mid / 100, np.diag(scale)), (vectors.mean(axis=0), np.cov(vectors.T, bias=True))):
        det = np.inf
        for _ in range(mcd_rules.STEPS):
            r = np.round(np.log(distance(mean, cov) + 1), 3)
            own = vectors[r <= np.quantile(r, mcd_rules.SUBSET)]
            mean, cov = own.mean(axis=0), np.cov(own.T, bias=True)
            was, det = det, np.linalg.det(cov + floors)
            if abs(det - was) <= 1e-9 * was:
                break
        ends.append((det, len(ends), mean, cov))
    _, _, mean, cov = min(ends, key=lambda x: x[:2])
    return distance(mean, cov * consistent)


def test_estimates_equal_numpy(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for gid in (1, 2, 3):
        x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5)) * [1, 0.1, 0.05, 0, 0] + gid
        x[:30] += 4  # a cluster that shifts a plain mean
        x = np.round(x, 4)
        sizes = rng.integers([300, 3, 50], [3000, 40, 600], (200, 3))
        logs = np.floor(np.log(sizes) * 100 + 0.5).astype(int).tolist()
        rows += [(gid, i, *(int(round(v * mcd_rules.GRID)) for v in row), *logs[i]) for i, row in enumerate(x)]
        want |= {(gid, i): d for i, d in enumerate(brute_mcd(x, sizes))}
    df = spark.createDataFrame(rows, "gid bigint, key int, x1 bigint, x2 bigint, x3 bigint, x4 bigint, x5 bigint, size3 int, size4 int, size5 int")
    got = {(r.gid, r.key): r.d2 for r in mcd_rules.distances(df, mcd_rules.estimates(df)).collect()}
    assert got.keys() == want.keys()
    # a row at the subset's bound may fall on either side of it, and the steps that follow end in a subset that differs by a row or two of 150
    assert np.median([abs(got[k] - want[k]) / (1 + want[k]) for k in want]) < 0.05
    assert min(got[g, i] for g in (1, 2, 3) for i in range(30)) > 5 * np.median([got[g, i] for g in (1, 2, 3) for i in range(30, 200)])


def test_of_two_starts_the_smaller_determinant_stays(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.round(np.concatenate([rng.normal(size=(85, 5)) * 0.2, rng.normal(size=(15, 5)) * 0.2 + 2]), 4)
    df = spark.createDataFrame([(1, i, *(int(round(v * mcd_rules.GRID)) for v in row), 900, 600, 1000) for i, row in enumerate(x)],
                               "gid bigint, key int, x1 bigint, x2 bigint, x3 bigint, x4 bigint, x5 bigint, size3 int, size4 int, size5 int")
    far = lambda: {r.key for r in mcd_rules.distances(df, mcd_rules.estimates(df)).collect() if r.d2 > 40}
    assert far() == set(range(85, 100))
    # a first start at the far end keeps the cluster in its subset and ends in a larger determinant
    real = mcd_rules.start
    monkeypatch.setattr(mcd_rules, "start", lambda rows: real(rows).withColumns({f"m{i}": F.lit(50.0) for i in range(1, 6)} | {f"s{i}{i}": F.lit(1e-6) for i in range(1, 6)}))
    assert far() == set(range(85, 100))


def test_verdicts_equal_numpy(spark, sf):
    """kept of every document: base rule, groups and pools, vectors and estimates recomputed from the texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    stats_of = {r.doc_id: base(r.text) for r in docs}
    rows = [(r.doc_id, r.lang, r.source, stats_of[r.doc_id], len([x for x in (r.text or "").split("\n") if WORD.search(x)])) for r in docs if not stats_of[r.doc_id][5]]
    groups = Counter((lang, source) for _, lang, source, _, _ in rows)
    pools = Counter(lang for _, lang, source, _, _ in rows if groups[lang, source] < mcd_rules.LEAST)
    rest = sum(n for n in pools.values() if n < mcd_rules.LEAST)
    of = {}
    for d, lang, source, s, lines in rows:
        gid = (lang, source) if groups[lang, source] >= mcd_rules.LEAST else lang if pools[lang] >= mcd_rules.LEAST else "all" if rest >= mcd_rules.LEAST else None
        if gid is not None:
            vector = [math.log(s[0]), math.log(max(s[1] / s[0], 1)), math.sqrt(s[2] / s[1]), math.sqrt(s[3] / lines), math.sqrt(s[4] / s[0])]
            of.setdefault(gid, []).append((d, [round(v, 4) for v in vector], (s[1], lines, s[0])))
    far = {}
    for own in of.values():
        far |= zip((d for d, _, _ in own), brute_mcd(np.array([v for _, v, _ in own]), np.array([n for _, _, n in own])))
    cutoff = mcd_rules.chi_square_quantile(5, mcd_rules.LEVEL)
    got = {r.doc_id: r.kept for r in queries.op4(spark, sf).collect()}
    # next to the cut a few thousandths of the estimate decide
    clear = {d for d in got if abs(far.get(d, 0) / cutoff - 1) > 0.1}
    want = {d: not s[5] and far.get(d, 0) <= cutoff for d, s in stats_of.items()}
    assert len(clear) > 0.97 * len(got) and {d: got[d] for d in clear} == {d: want[d] for d in clear}
    assert sum(far.get(d, 0) > cutoff for d in clear) > 3


def test_mild_symbol_junk_goes_and_a_single_symbol_stays(spark, make_docs):
    clean = [(i, prose(i, 60 + 7 * i), "en", "s") for i in range(80)]
    single = [(500 + i, prose(i, 80) + " 5%", "en", "s") for i in range(5)] + [(600 + i, "a line\n" * 2 + prose(i, 80), "en", "s") for i in range(3)]
    mild = [(1000 + i, " ".join(w + "#" * (k % 6 == 0) for k, w in enumerate(prose(i).split())), "en", "s") for i in range(8)]
    got = {r.key.id: r.kept for r in mcd_rules.judge(make_docs(clean + single + mild)).collect()}
    assert {d for d, kept in got.items() if not kept} == {d for d, *_ in mild}


def test_chi_square():
    assert mcd_rules.chi_square_quantile(2, 0.95) == pytest.approx(-2 * math.log(0.05))
    assert mcd_rules.chi_square_quantile(5, 0.95) == pytest.approx(11.0705, abs=1e-3)


def prose(i, n=120):
    rng = np.random.default_rng(i)
    return " ".join(rng.choice(["the", "of", "running", "water", "house", "and", "quick", "brown", "fox", "jumps", "lazy", "dogs", "over"], n) + ["." if k % 9 == 8 else "" for k in range(n)])


def test_rules_reject_symbols_and_keep_prose(spark, make_docs):
    clean = [(i, prose(i, 60 + 7 * i), "en", "s") for i in range(80)]
    junk = [(1000 + i, re.sub(r" ", "%% ## ", prose(i)), "en", "s") for i in range(8)]
    few = [(2000 + i, prose(500 + i), None, f"rare{i}") for i in range(5)]  # too few anywhere: nothing is rejected
    docs = make_docs(clean + junk + few + [(3000, prose(1), "en", None), (3000, prose(1), "en", None)])
    got = [(r.key.id, r.kept) for r in mcd_rules.judge(docs).collect()]
    assert len(got) == 95
    assert {d for d, k in got if not k} == {d for d, *_ in junk}
    assert mcd_rules.judge(docs.limit(0)).count() == 0


def junk(i):
    return " ".join(w.upper() + "!!" for w in prose(i).split())


def test_classifier_learns_and_never_reads_held_out_labels(spark, make_docs):
    docs = make_docs([(i, junk(i) if i % 4 == 0 else prose(i)) for i in range(600)] + [(700, None), (701, ""), (None, prose(1)), (5, prose(5))])
    out = lambda flip: {(r.id, r.a): r for r in rff_quality.score_documents(
        docs, spark.createDataFrame([(i, int(i % 4 != 0) if not flip or zlib.crc32(str(i).encode()) % 5 else int(i % 4 == 0)) for i in range(500)]
                                    + [(1, None), (None, 1)], "doc_id bigint, quality int")).collect()}
    got, other = out(False), out(True)
    assert {k: r.score for k, r in got.items()} == pytest.approx({k: r.score for k, r in other.items()}, abs=1e-9)
    for r in got.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 5 == 0)
        if r.id is not None and r.id < 600:
            assert r.predicted == int(r.id % 4 != 0)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in rff_quality.score_documents(docs, none).collect()} == {0.5}
    assert rff_quality.score_documents(docs.limit(0), none).count() == 0


def test_isotonic():
    centres, values = rff_quality.isotonic(np.arange(5.0), np.ones(5) * 10, np.array([1, 5, 3, 9, 8]))
    assert (np.diff(values) >= 0).all() and len(values) == 3 and values[1] == pytest.approx(8.5 / 21)


def test_classifier_equals_plain_ridge(spark):
    """Weights and calibrated scores against one numpy solution over all rows; the same bits in a second run."""
    rng, p = np.random.default_rng(8), len(rff_quality.NAMES)
    x = rng.normal(size=(900, p))
    y = (np.sin(x[:, 0]) + x[:, 1] ** 2 + rng.normal(0, 0.3, 900) > 0.8).astype(float)
    held = rng.random(900) < 0.25
    rows = spark.createDataFrame([(a.tolist(), float(b), bool(c)) for a, b, c in zip(x, y, held)], "x array<double>, y double, calibrate boolean").repartition(7, "x")
    model, again = rff_quality.fit(rows), rff_quality.fit(rows)
    assert (model.weights == again.weights).all() and (model.values == again.values).all()
    t = x[~held]
    z = rff_quality.Basis(t.mean(axis=0), t.std(axis=0))
    want = np.linalg.solve(z(t).T @ z(t) + rff_quality.RIDGE * np.eye(rff_quality.FEATURES), z(t).T @ y[~held])
    assert np.allclose(model.weights, want, atol=1e-6)
    # calibration: the least squares fit that never falls, by the min-max formula over the bins
    bins = np.clip(np.floor((z(x[held]) @ want + 0.5) * rff_quality.BINS / 2), 0, rff_quality.BINS - 1)
    at = np.unique(bins)
    n, pos = np.array([(bins == b).sum() for b in at]), np.array([y[held][bins == b].sum() for b in at])
    up = [max(min(pos[i:j + 1].sum() / n[i:j + 1].sum() for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    blocks = [np.flatnonzero(np.isclose(up, v)) for v in sorted({round(v, 9) for v in up})]
    # half a row of either kind added to each block, and still in order after it
    assert np.allclose(model.values, np.maximum.accumulate([(pos[b].sum() + 0.5) / (n[b].sum() + 1) for b in blocks]))


def test_classifier_query(spark, sf):
    rows = queries.op6(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) >= 0.85


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check_model(rows, texts):
    words = {d: [*WORD.findall((t or "").translate(LOWER)), "\n"] for d, t in texts.items()}
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in rows}
    assert got.keys() == texts.keys()
    for d, ws in words.items():
        want = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)
        assert (got[d].held_out, got[d].n_tokens, got[d].n_known, got[d].train_tokens) == (held[d], len(ws), sum(count[w] > 0 for w in ws), n)
        assert got[d].base_score == pytest.approx(want, rel=1e-9, abs=1e-9)
    return got


def test_model_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = check_model(queries.op3(spark, sf).collect(), texts)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_model_learns_order_and_head_overflow(spark, make_docs, monkeypatch):
    """Words that follow one another get far more than their frequency; counts beyond the head are joined."""
    monkeypatch.setattr(log_bilinear, "HEAD", 6)
    texts = {i: "A b C d " * 1500 for i in range(60)} | {100: None, 101: "", 102: "b d é x \x1c " + "long" * 100, None: "a b"}
    got = check_model(log_bilinear.score_documents(make_docs(list(texts.items()))).collect(), texts)
    assert all(got[i].score > 0.6 * got[i].base_score for i in range(60))
    twice = log_bilinear.score_documents(make_docs([(1, "a b zz"), (1, "a b zz"), (2, "q")])).collect()
    assert Counter(r.doc_id for r in twice) == {1: 2, 2: 1} and twice[0].train_tokens in (10, 8, 2)
    assert log_bilinear.score_documents(make_docs([(1, "a")]).limit(0)).count() == 0


def test_model_is_normalised():
    """Over all classes the probabilities after any two classes sum to 1."""
    rng = np.random.default_rng(0)
    net = log_bilinear.Net.start(np.full(log_bilinear.Net.M, 1 / log_bilinear.Net.M))
    net.flat += rng.normal(0, 0.3, net.flat.shape).astype(np.float32)
    after_v, after_u = net.tables()
    for u in (0, 5, log_bilinear.Net.M):
        z = net.log_z(after_v, after_u[u])
        assert np.exp(after_v + after_u[u] - z[:, None]).sum(axis=1) == pytest.approx(1, abs=1e-4)


def test_normalisers_are_products_of_two_tables(monkeypatch):
    """No context has its own sum of exp over the classes but where the product loses digits; blocks taken whole, by rows and kept give the same."""
    monkeypatch.setattr(log_bilinear, "BLOCK", 200)
    rng, m = np.random.default_rng(0), log_bilinear.Net.M
    net = log_bilinear.Net.start(np.full(m, 1 / m))
    net.flat += rng.normal(0, 0.2, net.flat.shape).astype(np.float32)
    u, v, w = rng.integers(0, 300, 20_000), rng.integers(0, m + 1, 20_000), rng.integers(0, m, 20_000)
    s = (net.hidden(v, u) @ net.q.T + net.b).astype(np.float64)
    top = s.max(axis=1)
    want = s[np.arange(len(w)), w] - top - np.log(np.exp(s - top[:, None]).sum(axis=1))
    direct, real = [], log_bilinear.log_sums
    monkeypatch.setattr(log_bilinear, "log_sums", lambda s: direct.append(len(s)) or real(s))
    for few in (1, 10_000):
        monkeypatch.setattr(log_bilinear, "FEW", few)
        for _ in range(2):
            assert net.log_p(u, v, w) == pytest.approx(want, abs=1e-3)
    assert len(net.kept) > 1 and sum(direct) == 0
    # a class far ahead after v, another one after u
    net = log_bilinear.Net(net.flat.copy())
    net.q[:], net.b[:], net.r[:] = 0, 0, 0
    net.c[:] = np.concatenate([np.eye(log_bilinear.SIZE)] * 2)
    net.r[7, 0], net.q[1, 0], net.q[2, 0] = 10, 9, -9
    net.r[8, 0] = -10
    one = np.array([8, 0]), np.array([7, 0]), np.array([1, 2])
    assert net.log_p(*one) == pytest.approx([-math.log(m)] * 2, abs=1e-4) and sum(direct) == 1


def test_normalisers_of_all_contexts_at_once():
    """Where many tokens are scored, Z of all contexts is made once and kept, by products where these keep their digits."""
    rng, m = np.random.default_rng(0), log_bilinear.Net.M
    net = log_bilinear.Net.start(np.full(m, 1 / m))
    net.flat += rng.normal(0, 0.2, net.flat.shape).astype(np.float32)
    net.r[7, 0], net.q[1, 0], net.q[2, 0], net.r[8, 0] = 40, 12, -12, -40
    u, v, w = rng.integers(0, m + 1, 40_000), rng.integers(0, m + 1, 40_000), rng.integers(0, m, 40_000)
    u[:50], v[:50] = 8, 7
    s = (net.hidden(v, u) @ net.q.T + net.b).astype(np.float64)
    top = s.max(axis=1)
    want = s[np.arange(len(w)), w] - top - np.log(np.exp(s - top[:, None]).sum(axis=1))
    assert net.log_p(u, v, w) == pytest.approx(want, rel=1e-5, abs=1e-3) and net.whole_z.shape == ((m + 1) ** 2,)
    kept = net.whole_z
    assert net.log_p(u[:10], v[:10], w[:10]) == pytest.approx(want[:10], rel=1e-5, abs=1e-3) and net.whole_z is kept


def test_normalisers_of_a_large_class_table_come_in_slices(spark, make_docs, monkeypatch):
    """Where no worker may hold log Z of all contexts, none has a sum of its own for want of that: a slice of u at a time is made whole."""
    rng, m = np.random.default_rng(0), log_bilinear.Net.M
    net = log_bilinear.Net.start(np.full(m, 1 / m))
    net.flat += rng.normal(0, 0.2, net.flat.shape).astype(np.float32)
    net.r[7, 0], net.q[1, 0], net.q[2, 0], net.r[8, 0] = 40, 12, -12, -40
    assert net.slices() == [(0, m + 1)]
    texts = {i: f"a b {'c' * (i % 7)} d zeta eta theta {i} " * 30 for i in range(40)}
    docs = make_docs(list(texts.items()))
    whole = {r.doc_id: r.score for r in log_bilinear.score_documents(docs).collect()}
    monkeypatch.setattr(log_bilinear, "KEPT", 1)
    monkeypatch.setattr(log_bilinear, "BLOCK", 300)
    assert len(net.slices()) > 10 and [lo for lo, _ in net.slices()[1:]] == [hi for _, hi in net.slices()[:-1]]
    u, v, w = rng.integers(0, m + 1, 5_000), rng.integers(0, m + 1, 5_000), rng.integers(0, m, 5_000)
    u[:50], v[:50] = 8, 7
    s = (net.hidden(v, u) @ net.q.T + net.b).astype(np.float64)
    top = s.max(axis=1)
    want = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
    assert net.scores(u, v, w) == pytest.approx(s[np.arange(len(w)), w], rel=1e-5, abs=1e-3)
    for lo, hi in net.slices():
        at = (u >= lo) & (u < hi)
        z = net.slice_z(lo, hi)
        assert z.size <= log_bilinear.BLOCK ** 2 and z is net.slice_z(lo, hi) and z[u[at] - lo, v[at]] == pytest.approx(want[at], rel=1e-5, abs=1e-3)
    assert {r.doc_id: r.score for r in log_bilinear.score_documents(docs).collect()} == pytest.approx(whole, rel=1e-6)
    check_model(log_bilinear.score_documents(docs).collect(), texts)


def test_a_net_travels_without_its_normalisers():
    """A worker's tasks share one net, so that what a task normalised serves the next; only the parameters are sent."""
    net = log_bilinear.Net.start(np.full(log_bilinear.Net.M, 1 / log_bilinear.Net.M))
    sent = len(pickle.dumps(net))
    net.slice_z(0, 300)
    assert len(pickle.dumps(net)) == sent < net.flat.nbytes + 1_000
    got = pickle.loads(pickle.dumps(net))
    assert got.slice is None and (got.flat == net.flat).all()


def test_classes_of_a_column():
    """The classes of many words at once are those of each: frequent words by place, the others by ending and hash."""
    short = [b"the", b"\n", b"\xc3\xa9"]
    words = [b"the", b"a", b"ab", b"abc", b"\xc3\xa9", b"x" * 65, b"\n" + b"0" * 64, b"The", b"\n", b"\xff\x00"] + [b"%dation" % i for i in range(300)]
    for n_short, split in ((896, 1), (1_914, 15)):
        classes = log_bilinear.Classes(short, n_short, split)
        want = [short.index(w) if w in short else log_bilinear.rare_class(w, n_short, split) for w in words]
        column = pa.array([b"zz", *words], pa.binary())
        assert classes(column.slice(1)).tolist() == want and classes(column.slice(1, 1)).tolist() == [0] and classes(column.slice(0, 0)).tolist() == []


def test_training_finds_samples_and_repeats_ahead(monkeypatch):
    """Many steps at once give what one step at a time gives, over texts of any length; each step is the plain one."""
    rng, m = np.random.default_rng(4), log_bilinear.Net.M
    share = rng.dirichlet(np.ones(m))
    texts = [rng.choice(m, n, p=share).astype(np.int32) for n in (1, 2, 3, 900, 1, 300, 2_000, 5)]
    nets, calls, real = [], [], log_bilinear.Repeats
    monkeypatch.setattr(log_bilinear, "Repeats", lambda at, size: calls.append(at.shape) or real(at, size))
    for ahead in (1, 5, 32):
        monkeypatch.setattr(log_bilinear, "AHEAD", ahead)
        nets.append(log_bilinear.Net.start(share))
        assert nets[-1].train(log_bilinear.minibatches(iter(texts), m), share, 3) == sum(map(len, texts))
        calls.append(None)
    assert (nets[0].flat == nets[1].flat).all() and (nets[0].flat == nets[2].flat).all()
    assert calls.index(None) == 26 and len(calls[calls.index(None):]) == 3 + 8 + 4
    # one minibatch by the book, in doubles
    u, v, w = next(log_bilinear.minibatches(iter(texts), m))
    net, sampled = log_bilinear.Net.start(share), np.random.default_rng((log_bilinear.SEED, 3))
    r, out, c = (x.astype(np.float64) for x in (net.r, net.out, net.c))
    j = np.minimum(np.searchsorted(np.cumsum(share), sampled.random(log_bilinear.NOISE)), m - 1)
    x = np.concatenate([r[v], r[u]], axis=1)
    h, noise = np.column_stack([x @ c, np.ones(len(w))]), np.log(share * log_bilinear.NOISE)
    up = -1 / (1 + np.exp((h * out[w]).sum(axis=1) - noise[w]))
    down = 1 / (1 + np.exp(noise[j] - h @ out[j].T))
    dh = down @ out[j][:, :-1] + up[:, None] * out[w][:, :-1]
    grads = [np.zeros_like(y) for y in (r, out, c)]
    np.add.at(grads[0], v, dh @ c[:log_bilinear.SIZE].T)
    np.add.at(grads[0], u, dh @ c[log_bilinear.SIZE:].T)
    np.add.at(grads[1], w, up[:, None] * h)
    np.add.at(grads[1], j, down.T @ h)
    grads[2] += x.T @ dh
    assert net.train(iter([(u, v, w)]), share, 3) == len(w)
    for old, got, grad in zip((r, out, c), (net.r, net.out, net.c), grads):
        grad /= len(w)
        assert got == pytest.approx(old - log_bilinear.RATE * grad / np.sqrt(log_bilinear.FIRST + grad * grad), abs=1e-5)


def test_words_of_a_column():
    """The words of many texts at once are those of each, whatever blanks, signs and lengths."""
    texts = ["", " ", "a  b", " A \u00c9\x1cx\n\n", "x" * 200 + " y \x00z", "a\tb\x0bc\x0cd\re", "\u00c9" * 40 + " " + "\u00e9" * 32, "\x85 q\u2003r", "w" * 64 + " " + "W" * 65, ""]
    for some in (texts, texts[:2], texts[4:5], []):
        words, n = log_bilinear.word_column(pa.array(some, pa.string()))
        want = [log_bilinear.tokens(t) for t in some]
        assert n.tolist() == [len(x) for x in want] and words.cast(pa.binary()).to_pylist() == [x for y in want for x in y]
    assert log_bilinear.word_column(pa.array(texts).slice(2, 3))[0].to_pylist()[:2] == ["a", "b"]


def test_noise_contrastive_gradient():
    """One step goes down the loss: numeric check on a small batch."""
    share = np.random.default_rng(1).dirichlet(np.ones(log_bilinear.Net.M))
    net = log_bilinear.Net.start(share)
    u, v, w = (np.random.default_rng(k).integers(0, 50, 500) for k in (2, 3, 4))
    w = (v + 1) % 50
    score = lambda: float(((net.r[v] * net.c1 + net.r[u] * net.c2) * net.q[w]).sum(axis=1).mean() + net.b[w].mean())
    before = score()
    assert net.train(iter([(u, v, w)] * 30), share, 0) == 15_000
    assert score() > before + 0.5


def test_context_weights_are_full_matrices():
    """A step moves weights off the diagonals of C1 and C2, and the score tables follow them."""
    m = log_bilinear.Net.M
    share = np.full(m, 1 / m)
    net = log_bilinear.Net.start(share)
    u, v, w = (np.random.default_rng(k).integers(0, 50, 256) for k in (2, 3, 4))
    net.train(iter([(u, v, w)] * 5), share, 0)
    full = [np.diag(c) + e for c, e in ((net.c1, net.e1), (net.c2, net.e2))]
    assert all(c.shape == (32, 32) and np.abs(c - np.diag(np.diag(c))).max() > 1e-3 for c in full)
    after_v, after_u = net.tables()
    assert after_v == pytest.approx(net.r @ full[0] @ net.q.T + net.b, abs=1e-4) and after_u == pytest.approx(net.r @ full[1] @ net.q.T, abs=1e-4)
    assert (log_bilinear.SIZE, log_bilinear.NOISE, log_bilinear.BATCH) == (32, 64, 256)


def test_model_does_not_follow_the_partitions(spark, sf, monkeypatch):
    """The same rows in many more partitions learn as much; more than one group is averaged."""
    monkeypatch.setattr(log_bilinear, "GROUP", 20_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    few, many = ({r.doc_id: r for r in log_bilinear.score_documents(docs.repartition(n)).collect()} for n in (1, 24))
    held = lambda got: sum(r.score for r in got.values() if r.held_out)
    assert held(many) >= held(few) + 1e-4 * held(few)
    assert {d: r.score for d, r in many.items()} == pytest.approx({d: r.score for d, r in few.items()}, rel=1e-3)


def test_classes_grow_with_the_vocabulary():
    classes = [short + log_bilinear.RARE * split for short, split in map(log_bilinear.sizes, (0, 1_000, 400_000, 40_000_000))]
    assert classes[0] == classes[1] == log_bilinear.Net.M and classes[1] < classes[2] < classes[3] / 4
    words = [b"%dation" % i for i in range(2_000)]
    assert len({log_bilinear.rare_class(w) for w in words}) == 1 and len({log_bilinear.rare_class(w, 896, 5) for w in words}) == 5


def test_frequent_long_tokens_are_words_of_their_own(spark, make_docs):
    """A token longer than LONGEST goes by its digest: counted and known as itself, whatever its length and frequency."""
    long, other = "x" * 200, "x" * 199 + "y"
    texts = {i: f"{long} a {other} " * 20 for i in range(30)} | {50: f"{long} {long.upper()}", 51: other, 52: "x" * 198 + "zz", 53: "y" * 100_000}
    check_model(log_bilinear.score_documents(make_docs(list(texts.items()))).collect(), texts)
    (a, b, c), want = log_bilinear.tokens(f"{long} {other} " + "w" * log_bilinear.LONGEST), b"w" * log_bilinear.LONGEST
    assert c == want and a != b and a[:1] == log_bilinear.END and max(len(a), len(b)) <= log_bilinear.LONGEST + 1


def test_training_order_follows_the_tokens_alone():
    """Tokens in another order give the same sequence, and repeats of one token do not stay together."""
    rng = np.random.default_rng(0)
    uv, code = rng.integers(0, 50, 5_000), rng.integers(0, 20, 5_000)
    uv[:2_000], code[:2_000] = 7, 3
    mixed = rng.permutation(5_000)
    a, b = log_bilinear.dealt_anew(uv, code), log_bilinear.dealt_anew(uv[mixed], code[mixed])
    assert sorted(a) == list(range(5_000)) and (uv[a] == uv[mixed][b]).all() and (code[a] == code[mixed][b]).all()
    hot = ((uv[a] == 7) & (code[a] == 3)).reshape(10, 500).sum(axis=1)
    assert hot.min() > 100 and hot.max() < 300


def test_words_of_one_class_are_told_apart(spark, make_docs, monkeypatch):
    """Two equally frequent words of one class go by what stands before them; words of a class sum to 1."""
    monkeypatch.setattr(log_bilinear, "HEAD", 2)
    x, y = (i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2), (i for i in range(200, 300) if zlib.crc32(str(i).encode()) % 7 == 2)
    x, y = next(x), next(y)
    texts = {i: "left left mation right right nation " * 200 for i in range(60)} | {x: "left left mation right right nation " * 50, y: "left left nation right right mation " * 50}
    got = check_model(log_bilinear.score_documents(make_docs(list(texts.items()))).collect(), texts)
    assert log_bilinear.rare_class(b"mation") == log_bilinear.rare_class(b"nation")
    assert got[x].base_score == pytest.approx(got[y].base_score) and got[x].score > got[y].score + 10
    words, h = log_bilinear.Words(np.array([5, 1, 9])), np.random.default_rng(0).normal(size=(4, log_bilinear.SIZE))
    words.train(np.repeat(h, 100, axis=0), np.arange(400) % 3, 0)
    assert np.abs(words.q).max() > 0.1
    assert sum(np.exp(words.log_p(h, np.full(4, k))) for k in range(4)) == pytest.approx(1, abs=1e-5)


def test_stages(spark, sf):
    """Each stage's decisions take effect on what its predecessor kept; all but the last keep the documents' columns."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, docs, sf), "stage")
        if k == len(corpus_pipeline.STAGES) - 1:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
            break
        assert out.columns == docs.columns
        before, after = ({r.doc_id: r for r in x.collect()} for x in (docs, out))
        if k == 0:
            verdict = {r.id: r.predicted == 1 for r in rff_quality.score_documents(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
        elif k == 1:
            verdict = {r.key.id: r.kept for r in mcd_rules.judge(docs).collect()}
        elif k == 2:
            from .test_dedup import brute_lines

            left = brute_lines([(d, before[d].text) for d in sorted(before)])
            verdict = {d: left[d] == r.text or bool(WORD.search(left[d])) for d, r in before.items()}
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            from .test_dedup import brute_join

            verdict = {d: c == d for d, (c, _) in brute_join({d: r.text for d, r in before.items()}).items()}
        assert after.keys() == {d for d, keep in verdict.items() if keep}
        docs = out


def test_stages_of_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_copies_leave_between_line_dedup_and_packing(spark, sf, make_docs):
    """A hot group of exact copies, repeated rows, null texts and clashing columns through the last three stages."""
    lines = ["one line of the text", "another line of it", "and a third one here", "the last line of all"]
    text = "\n".join(lines)
    rows = [(d, text) for d in range(2000)] + [(5000, "a text of one line that is here alone")] * 700 + [(5001, None), (5002, ""), (None, "null id with its own text here")]
    rows += [(6000, "some words before\n" + text), (6001, " \n\t\n "), (6002, "x y z"), (6002, "x y z")]
    docs = make_docs(rows).withColumnRenamed("source", "n_removed").withColumnRenamed("lang", "llm_row")
    out = corpus_pipeline.written(corpus_pipeline.lines_stage(spark, docs, sf), "stage")
    # copies are emptied and go; what had no words before stays, as do words beside removed lines
    assert out.columns == docs.columns
    left = Counter((r.doc_id, r.text) for r in out.collect())
    assert left == Counter({(None, "null id with its own text here"): 1, (0, text): 1, (5000, "a text of one line that is here alone"): 700, (5001, None): 1, (5002, ""): 1,
                            (6000, "some words before"): 1, (6001, " \n\t\n "): 1, (6002, "x y z"): 2})
    out = corpus_pipeline.written(corpus_pipeline.near_copies_stage(spark, out, sf), "stage")
    assert out.columns == docs.columns and Counter((r.doc_id, r.text) for r in out.collect()) == Counter(dict.fromkeys(left, 1))
    pieces = corpus_pipeline.pack_stage(spark, out, sf).collect()
    assert sorted((r.doc_id for r in pieces), key=str) == sorted((d for d, _ in left), key=str)
    # without repeats the near-copy stage's input is passed on as it is
    from arqueo.llm.common import one_per_key

    assert one_per_key(out) is out and one_per_key(out.limit(0)).count() == 0


def test_repeated_rows_are_cut_before_their_shuffle(spark, make_docs):
    from arqueo.llm.common import one_per_key

    docs = make_docs([(1, "same")] * 50 + [(1, "other"), (None, "n"), (None, "n"), (2, None), (2, None)])
    once = one_per_key(docs)
    assert Counter((r.doc_id, r.text, r.id) for r in once.collect()) == Counter({(1, "same", 7): 1, (1, "other", 7): 1, (None, "n", 7): 1, (2, None, 7): 1})
