"""Line windows, the Jaccard join and the cover tree against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from arqueo.llm import chosen_path, common, cover_tree, line_windows, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lines(rows):
    """(id, text) rows with unique ids, in order of id: texts after removal."""
    seen, gone = set(), defaultdict(set)
    for d, t in rows:
        own = [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate((t or "").split("\n"))]
        own = [x for x in own if x[1]]
        for k in range(len(own) - 2):
            window = tuple(x for _, x in own[k:k + 3])
            if window in seen:
                gone[d].update(i for i, _ in own[k:k + 3])
            seen.add(window)
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows}


def test_line_windows_equal_brute_force(spark, make_docs):
    rng = random.Random(5)
    rows = [(d, "\n".join(rng.choice(["a", " a ", "b", "c", "", "  ", "d e"]) for _ in range(rng.randint(0, 25)))) for d in range(60)]
    rows += [(100, None), (101, ""), (102, "x\ny"), (103, "x\ny"), (104, "\n".join(["same"] * 3000)), (105, "w " * 50_000 + "\nq\nr\ns")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.id) for r in line_windows.dedup_lines(make_docs(rows)).collect()}
    want = brute_lines(rows)
    for d, t in rows:
        lines = 0 if t is None else t.count("\n") + 1
        left = lines if t is None else (want[d].count("\n") + 1 if want[d] or got[d][2] < lines else 0)
        assert got[d][0] == want[d], d
        assert got[d][1:] == (lines, lines - left, 7)


def test_line_windows_odd_rows(spark, make_docs):
    docs = make_docs([(1, "a\nb\nc\nz"), (1, "a\nb\nc\nz"), (2, "q\na\nb\nc"), (None, "a\nb\nc")])
    got = Counter((r.doc_id, r.text) for r in line_windows.dedup_lines(docs).collect())
    # a null id comes first; the equal rows change alike
    assert got == Counter({(1, "z"): 2, (2, "q"): 1, (None, "a\nb\nc"): 1})
    clash = docs.withColumnRenamed("id", "n_removed").withColumnRenamed("source", "llm_gone")
    out = line_windows.dedup_lines(clash)
    assert sorted(out.columns) == sorted(["doc_id", "text", "lang", "llm_gone", "n_chars", "n_lines", "n_removed"])
    assert out.count() == 4 and line_windows.dedup_lines(docs.limit(0)).count() == 0


def shingle_set(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_join(texts, threshold=0.8):
    """{id: (smallest id of the class, links)}."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    ids, root, links = sorted(texts), {d: d for d in texts}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, d in enumerate(ids):
        for e in ids[i + 1:]:
            if sets[d] and sets[e] and len(sets[d] & sets[e]) >= threshold * len(sets[d] | sets[e]) - 1e-12:
                links[d] += 1
                links[e] += 1
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (find(d), links[d]) for d in ids}


def near_copies(seed, groups, size):
    rng, out, d = random.Random(seed), {}, 0
    words = [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(12, 90))
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(words)
            out[d] = " ".join(own)
            d += 1
    return out


def joined(docs, **more):
    return {r.id: (r.class_id, r.n_links) for r in chosen_path.join_documents(docs, **more).collect()}


def test_join_equals_brute_force(spark, make_docs):
    texts = near_copies(3, 25, 14) | {1000: None, 1001: "", 1002: "one two", 1003: "one two", 1004: "one", 1005: "w " * 6000, 1006: "w " * 9000}
    assert joined(make_docs(list(texts.items()))) == brute_join(texts)


def test_join_with_small_chunks_and_blocks(spark, make_docs, monkeypatch):
    """Big nodes and groups cut into many pieces give the same links."""
    for name, value in (("LEAF", 4), ("CHUNK", 8), ("BLOCK_SETS", 6)):
        monkeypatch.setattr(chosen_path, name, value)
    texts = near_copies(9, 3, 60)
    assert joined(make_docs(list(texts.items()))) == brute_join(texts)


def test_join_keeps_one_of_each_class(spark, make_docs):
    docs = make_docs([(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (7, None), (8, None), (None, "q r s t u v")])
    rows = chosen_path.join_documents(docs).collect()
    assert sorted((r.id, r.class_id, r.n_links, r.kept) for r in rows if r.id is not None) == [
        (3, 3, 2, True), (3, 3, 2, True), (5, 3, 2, False), (7, 7, 0, True), (8, 8, 0, True)]
    assert [(r.class_id, r.kept) for r in rows if r.id is None] == [(None, True)]
    assert chosen_path.join_documents(docs.limit(0)).count() == 0


def test_runs_reach_the_recall():
    rng = np.random.default_rng(1)
    threshold, n = 0.8, 400
    found, total = 0, chosen_path.runs(threshold)
    starts = chosen_path.mix(np.arange(1, total + 1, dtype=np.uint64))
    for _ in range(n):
        a = rng.integers(0, 2**32, chosen_path.COORDS, dtype=np.uint32)
        b = np.where(rng.random(len(a)) < threshold, a, rng.integers(0, 2**32, len(a), dtype=np.uint32)).astype(np.uint32)
        x, y = starts, starts
        for _ in range(chosen_path.DEPTH):
            x = chosen_path.picked(x, np.tile(a, (len(x), 1)), 1 / threshold - 1)[1]
            y = chosen_path.picked(y, np.tile(b, (len(y), 1)), 1 / threshold - 1)[1]
            x = y = np.intersect1d(x, y)
        found += len(x) > 0
    assert found / n >= 0.98


def test_runs_count_shared_coordinates_and_the_cut():
    """Drawn coordinates, the cut included: the runs reach the recall, which 7 do not."""
    rng = np.random.default_rng(2)
    threshold, n = 0.8, 100_000
    equal = rng.binomial(chosen_path.COORDS, threshold, n)
    reached = {}
    for total in (7, chosen_path.runs(threshold)):
        # the path lives on by as many equal tokens as it picks
        paths = np.full(n, total)
        for _ in range(chosen_path.DEPTH):
            paths = rng.binomial(paths + rng.binomial(paths, 1 / threshold - 1), equal / chosen_path.COORDS)
        reached[total] = np.mean((paths > 0) & (equal >= chosen_path.cut(threshold)))
        assert reached[total] == pytest.approx(chosen_path.recall(total, threshold), abs=3e-4)
    assert chosen_path.recall(7, threshold) < 0.999 < 0.9995 <= chosen_path.recall(chosen_path.runs(threshold), threshold)
    assert 0 < chosen_path.runs(0.5) < 100


def test_join_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: (r.class_id, r.n_links) for r in queries.op8(spark, sf).collect()} == brute_join(texts)


def test_shared_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60 if i % 2 else 5000, rng.integers(0, 80))).astype(np.uint64) for i in range(90)]
    for left, right in ((np.arange(0, 50), np.arange(50, 90)), (np.arange(90), np.arange(90))):
        want = np.array([[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left])
        got = chosen_path.shared_counts(sets, left, right)
        other = left[:, None] != right[None, :]
        assert (got[other] == want[other]).all()


def brute_vectors(rows, threshold=0.95):
    good = {d: np.array(v, float) for d, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    root, links = {d: d for d, _ in rows}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in good:
        for e in good:
            if d < e and len(good[d]) == len(good[e]) and good[d] @ good[e] / math.sqrt(good[d] @ good[d]) / math.sqrt(good[e] @ good[e]) >= threshold:
                links[d] += 1
                links[e] += 1
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (links[d], find(d), find(d) == d) for d, _ in rows}


@pytest.mark.parametrize("small", [False, True])
def test_vectors_equal_brute_force(spark, monkeypatch, small):
    if small:  # many cells, blocks and chunks
        for name, value in (("SAMPLE", 40), ("FANOUT", 3), ("PART", 20), ("BLOCK", 9), ("VISITORS", 11)):
            monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        rows += [(len(rows) + i, (centre + rng.normal(size=8) * s).tolist()) for i, s in enumerate([0, 0.05, 0.1, 0.2, 0.3, 0.3, 0.5, 1, 1, 2])]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0, None]), (204, [float("nan")] * 8), (205, [float("inf")] + [1.0] * 7), (206, rows[3][1]),
             (207, [2 * x for x in rows[3][1]]), (208, [1.0, 1.0]), (209, [1.0, 1.1]), (210, [1e30] * 8), (211, [1e-30] * 8)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<double>, node int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.link_vectors(df).collect()}
    assert got == brute_vectors(rows)
    assert cover_tree.link_vectors(df.limit(0)).count() == 0


def unit_table(spark, x):
    return spark.createDataFrame([(i, 1, bytearray(r.tobytes())) for i, r in enumerate(cover_tree.unit(x))], "node bigint, copies bigint, v binary")


def test_upper_levels_are_nested_and_prune(spark, monkeypatch):
    """Clusters of clusters: every vector in one leaf and within its covers on all levels, far clusters never paired."""
    for name, value in (("SAMPLE", 60), ("FANOUT", 4), ("PART", 50), ("BLOCK", 20)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(4)
    x = np.concatenate([np.eye(6)[k % 6] + rng.normal(size=6) * 0.03 * (1 + k % 4) for k in range(300)]).reshape(-1, 6)
    x[:100] = np.eye(6)[0] + rng.normal(size=(100, 6)) * 0.02  # a third of all in one place
    theta = math.acos(0.95)
    leaves, nodes, depth = cover_tree.upper_levels(unit_table(spark, x), 6, theta)
    own, tree = {r.node: r.cell for r in leaves.collect()}, {r.cell: r for r in nodes.collect()}
    assert sorted(own) == list(range(300)) and depth > 1
    u = cover_tree.unit(x)
    for node, cell in own.items():
        assert tree[cell].leaf and (tree[cell].n <= 20 or tree[cell].tight)
        while cell != "0":
            assert math.acos(min(1, np.frombuffer(tree[cell].centre) @ u[node])) <= tree[cell].cover + 1e-6
            cell = tree[cell].parent
    pairs = {(r.a, r.b) for r in cover_tree.leaf_pairs(nodes, depth, 6, theta).collect()}
    n = sum(r.leaf for r in tree.values())
    assert len(pairs) < n * (n + 1) // 4  # of all pairs of leaves most are ruled out
    cosine = u @ u.T
    for i, j in zip(*np.nonzero(np.triu(cosine >= 0.95, 1))):  # and none that holds a link
        assert (own[i], own[j]) in pairs or (own[j], own[i]) in pairs
    assert all((b, a) not in pairs or a == b for a, b in pairs)


@pytest.mark.parametrize("depth", [24, 1])
def test_a_hot_cluster_is_counted_whole(spark, monkeypatch, depth):
    """A third of all vectors so close that they all link, a leaf that levels do not split, a null id and a repeated row."""
    for name, value in (("SAMPLE", 30), ("FANOUT", 8), ("BLOCK", 16), ("DEPTH", depth)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(6)
    x = [np.ones(5) + rng.normal(size=5) * (0.01 if i < 60 else 1.5) for i in range(180)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.link_vectors(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert got == brute_vectors(rows)
    odd = spark.createDataFrame([(None, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (9, [2.0, -1.0]), (None, None)], "vec_id bigint, embedding array<double>")
    got = Counter(tuple(r) for r in cover_tree.link_vectors(odd).select("vec_id", "n_links", "component_id", "kept").collect())
    assert got == Counter({(None, 2, 4, False): 1, (4, 2, 4, True): 2, (9, 0, 9, True): 1, (None, 0, None, False): 1})


def test_traversal_prunes():
    """Two far clusters: the traversal looks at leaves of neither pair across them."""
    rng = np.random.default_rng(3)
    near = cover_tree.unit(np.r_[np.tile([1, 0, 0, 0], (50, 1)), np.tile([-1, 0, 0, 0], (50, 1))] + rng.normal(0, 0.02, (100, 4)))
    tree = cover_tree.Tree(near)
    i, j = cover_tree.traverse(tree, tree, math.sqrt(0.1), 0.95, True)
    assert len(i) == 2 * 50 * 49 // 2 and ((i < 50) == (j < 50)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "u bigint, v bigint"), "u", "v").collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 560)}, 8: 8, 9: 8}
