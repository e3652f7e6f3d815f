"""Jaccard join of word-shingle sets by chosen paths.

Method: a set is seen through ``COORDS`` min-hash coordinates, each a sampled
token that two sets share with the probability of their similarity.  From the
root of each run a node picks one coordinate, or two (so that 1 / threshold on
average are picked), and a set goes to the child of each picked token; sets that
share tokens stay together.  A node of at most ``LEAF`` sets, or at ``DEPTH``,
is compared by brute force on the coordinates.  Runs are repeated until a pair at
the threshold is found with probability ``RECALL``, over the coordinates that all
runs share and the cut of that comparison (see :func:`recall`).

What is found ties sets into candidate groups, and an exact check follows: in
each group all pairs are compared by the true Jaccard similarity of their sets,
which gives the number of links and the classes.

Scale: equal sets are one set with a multiplicity.  Paths are (path, set) rows of
16 bytes; only sets that share a path go on.  Big nodes and groups are cut into
chunks whose pairs are separate pieces of work, so no group meets in one task;
links are counted where they are found and only a spanning forest is written,
never the pairs.  Shingle sets are built again from the text for group members
only.

Defined cases: words are what lies between blanks; a text of fewer words than a
shingle is one shingle of all of them; a text without words (or null) has no
links and is its own class; null ids count in links and sort first; rows equal in
id and text are copies of one document; a class is named by its smallest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_RUN, components, dealt, roots, row_key, streamed, written

COORDS, LEAF, DEPTH, RECALL, SEED = 128, 256, 3, 0.9995, 77
#: Pairs whose share of equal coordinates is this much below the threshold go to the exact check (3.5 deviations), or more if the cut alone would lose a quarter of what ``RECALL`` leaves (:func:`cut`).
SLACK = 0.125
#: Sets in a chunk of a big node; sets and shingles in a block of a big group.
CHUNK, BLOCK_SETS, BLOCK_SHINGLES = 16_384, 2_048, 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (all arithmetic wraps)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def equal_coordinates(threshold: float) -> np.ndarray:
    """Probabilities of 0 to ``COORDS`` equal coordinates of a pair at the threshold."""
    return np.array([math.comb(COORDS, k) * threshold**k * (1 - threshold) ** (COORDS - k) for k in range(COORDS + 1)])


def cut(threshold: float, least: float = RECALL) -> int:
    """Equal coordinates that a pair needs for the exact check."""
    lost = np.cumsum(equal_coordinates(threshold))
    return min(math.floor((threshold - SLACK) * COORDS), int(np.searchsorted(lost, (1 - least) / 4, side="right")))


def recall(n: int, threshold: float, least: float = RECALL, depth: int = DEPTH) -> float:
    """Probability that a pair at the threshold shares a leaf in one of ``n`` runs and passes the cut, be the leaf as deep as can be.

    All runs see the same coordinates, so they are independent only for a given number of equal ones.
    """
    two, share, found = 1 / threshold - 1, np.arange(COORDS + 1) / COORDS, np.ones(COORDS + 1)
    for _ in range(depth):
        s = share * found
        found = (1 - two) * s + two * (1 - (1 - s) ** 2)
    return float((equal_coordinates(threshold) * (1 - (1 - found) ** n))[cut(threshold, least):].sum())


def runs(threshold: float, least: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold is found with this probability."""
    n = 1
    while recall(n, threshold, least, depth) < least:
        n += 1
    return n


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` words in a row, from the words' 64-bit hashes."""
    w = words.astype(np.int64).view(np.uint64)
    if not len(w):
        return np.empty(0, np.uint64)
    n = max(len(w) - width + 1, 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(width, len(w))):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n] + np.uint64(k + 1))
    return np.unique(h)


def multipliers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def coordinates(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Min-hash coordinates (32 bits each) of a set of hashes."""
    low = np.full(COORDS, 2**32 - 1, np.uint32)
    for lo in range(0, len(own), 4_096):
        part = (factors[:, None] * own[None, lo:lo + 4_096]) >> np.uint64(32)
        low = np.minimum(low, part.min(axis=1).astype(np.uint32))
    return low


def word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(text, BLANK_RUN), ""), lambda w: F.xxhash64(w))


def described(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, a, b, f1, f2, size, coords) per document: row key, hash of the shingle set, its size and coordinates.  Written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key, kind = row_key(id_col, text), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = multipliers()
        for pdf in batches:
            sets = [shingles(np.asarray(w, dtype=np.int64), width) for w in pdf["w"]]
            yield pd.DataFrame({
                "id": pdf["id"], "a": pdf["a"], "b": pdf["b"], "f1": [int(x.sum(dtype=np.uint64).astype(np.int64)) for x in sets],
                "f2": [int(np.bitwise_xor.reduce(mix(x * np.uint64(3))).astype(np.int64)) if len(x) else 0 for x in sets],
                "size": [len(x) for x in sets], "coords": [coordinates(x, factors).tobytes() if len(x) else None for x in sets]})

    out = docs.select(key["id"].cast("string").alias("id"), key["a"].alias("a"), key["b"].alias("b"), word_hashes(text).alias("w")).mapInPandas(
        run, "id string, a bigint, b bigint, f1 bigint, f2 bigint, size bigint, coords binary")
    return written(out.withColumn("id", F.col("id").cast(kind)), "described")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """(node, f1, f2, size, copies, key, coords) per distinct set with words; node numbers it.  Written."""
    sets = rows.where("size > 0").groupBy("f1", "f2", "size").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "a", "b")).alias("key"), F.first("coords").alias("coords"))
    return written(sets.withColumn("node", F.monotonically_increasing_id()), "sets")


def picked(paths: np.ndarray, coords: np.ndarray, two: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of all children: each path picks one coordinate, with probability ``two`` another one."""
    first = mix(paths + np.uint64(0xA0761D6478BD642F))
    second = mix(paths + np.uint64(0xE7037ED1A0B428DB))
    more = np.flatnonzero((mix(paths + np.uint64(0x8EBC6AF09C88C6E3)) >> np.uint64(11)) < two * 2**53)
    row = np.concatenate([np.arange(len(paths)), more])
    at = np.concatenate([first % np.uint64(COORDS), second[more] % np.uint64(COORDS)]).astype(np.int64)
    token = coords[row, at].astype(np.uint64) + (at.astype(np.uint64) << np.uint64(32))
    child = mix(paths[row] * np.uint64(0x9E3779B97F4A7C15) ^ mix(token))
    return row, child


def stacked(coords: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(coords), dtype=np.uint32).reshape(-1, COORDS)


def children(rows: DataFrame, threshold: float, roots_of: int = 0) -> DataFrame:
    """(path, node) one level down; ``roots_of`` runs from the root, or from the rows' own path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = mix(np.arange(1, roots_of + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        for pdf in batches:
            if not len(pdf):
                continue
            coords, node = stacked(pdf["coords"]), pdf["node"].to_numpy()
            own = [pdf["path"].to_numpy().astype(np.int64).view(np.uint64)] if not roots_of else [np.full(len(pdf), s) for s in starts]
            for paths in own:
                row, child = picked(paths, coords, 1 / threshold - 1)
                yield pd.DataFrame({"path": child.view(np.int64), "node": node[row]}).drop_duplicates()

    return rows.select("node", "coords", *([] if roots_of else ["path"])).mapInPandas(run, "path bigint, node bigint")


def leaves(sets: DataFrame, threshold: float) -> DataFrame:
    """(path, node, chunks) of the leaves with company: chunks is 1, or for a big leaf the number of its chunks."""
    found, level, rows = [], 1, children(sets, threshold, runs(threshold))
    while True:
        rows = written(rows, "paths")
        sizes = written(rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), "nodes")
        shared = rows.join(sizes, "path")
        last = level == DEPTH
        chunks = F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")
        found.append(shared.where(F.lit(last) | (F.col("n") <= LEAF)).select("path", "node", chunks))
        if last or sizes.where(F.col("n") > LEAF).isEmpty():
            break
        rows = children(shared.where(F.col("n") > LEAF).select("path", "node").join(sets.select("node", "coords"), "node"), threshold)
        level += 1
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def paired(rows: DataFrame, parts: str, number: Column) -> DataFrame:
    """Rows of a group cut into ``parts`` parts, once for each pair (p, q) of parts that theirs (``part``) is in."""
    rows = rows.withColumn("part", F.pmod(number, F.col(parts)).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))
    return rows.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")}).drop("other")


def candidate_edges(sets: DataFrame, threshold: float) -> DataFrame:
    """Spanning forest (u, v) of the leaves' pairs that are similar by their coordinates."""
    least = cut(threshold)
    rows = paired(leaves(sets, threshold), "chunks", F.xxhash64("node")).join(sets.select("node", "coords"), "node")
    keys = ["path", "p", "q"]

    def reach(coords: np.ndarray, node: np.ndarray) -> Iterator[tuple[int, int]]:
        """Breadth first: what is reached is compared with what is not; a group of near copies is gone in one step."""
        open_ = np.arange(len(node))
        while len(open_) > 1:
            root, open_ = open_[0], open_[1:]
            queue = [root]
            while queue and len(open_):
                x = queue.pop()
                hit = (coords[open_] == coords[x]).sum(axis=1) >= least
                for y in open_[hit]:
                    yield int(node[root]), int(node[y])
                queue += open_[hit].tolist()
                open_ = open_[~hit]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, int]] = []
        for group in streamed(batches, keys):
            if len(group) > 1:
                out += reach(stacked(group["coords"]), group["node"].to_numpy())
            if len(out) > 20_000:
                yield pd.DataFrame(sorted(set(out)), columns=["u", "v"])
                out = []
        yield pd.DataFrame(sorted(set(out)), columns=["u", "v"]).astype("int64")

    return dealt(rows, keys).select(*keys, "node", "coords").mapInPandas(run, "u bigint, v bigint")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at the places ``left`` with those at ``right`` (undefined for a set with itself).

    Tokens in many sets go through matrix products, a slice at a time; those in few sets are paired off one by one.
    """
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    token = np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    count = np.diff(np.append(first, len(token)))
    number = np.repeat(np.arange(len(first)), count)
    at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
    at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros((len(left), len(right)), np.float32)
    frequent = np.flatnonzero(count > max(8, len(sets) // 32))
    for lo in range(0, len(frequent), 2_048):
        some = frequent[lo:lo + 2_048]
        column = np.full(len(first), -1)
        column[some] = np.arange(len(some))
        rows = np.flatnonzero(column[number] >= 0)
        table = np.zeros((len(sets), len(some)), np.float32)
        table[owner[rows], column[number[rows]]] = 1
        out += table[left] @ table[right].T
    # rare tokens: all ordered pairs of their owners, by how many owners they have
    for k in np.unique(count[(count > 1) & (count <= max(8, len(sets) // 32))]):
        starts = first[count == k]
        for lo in range(0, len(starts), max(1, 2_000_000 // int(k * k))):
            own = owner[starts[lo:lo + max(1, 2_000_000 // int(k * k))][:, None] + np.arange(k)]
            a, b = np.repeat(own, k, axis=1).ravel(), np.tile(own, (1, k)).ravel()
            a, b = at_left[a], at_right[b]
            ok = (a >= 0) & (b >= 0)
            flat = np.bincount(a[ok] * len(right) + b[ok], minlength=0)
            out.ravel()[:len(flat)] += flat.astype(np.float32)
    return out


def verified(group: pd.DataFrame, threshold: float) -> pd.DataFrame | None:
    """(node, links, root) of the sets of one pair of blocks that have a link."""
    if len(group) < 2:
        return None
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group["tokens"]]
    node, copies, part = (group[c].to_numpy() for c in ("node", "copies", "part"))
    p, q = int(group["p"].iloc[0]), int(group["q"].iloc[0])
    left, right = np.flatnonzero(part == p), np.flatnonzero(part == q)
    size = np.array([len(s) for s in sets], np.float64)
    same = shared_counts(sets, left, right).astype(np.float64)
    # J >= t is same * (1 + t) >= t * (|x| + |y|); a hair below, as the threshold is no binary fraction
    link = same * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) - 1e-9
    if p == q:
        np.fill_diagonal(link, False)
    links = np.zeros(len(sets))
    links[left] += link @ copies[right]
    if p != q:
        links[right] += link.T @ copies[left]
    a, b = np.nonzero(link)
    label = roots(len(sets), left[a], right[b])
    # the root of a component by its smallest node
    low = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(low, label, node)
    some = links > 0
    return pd.DataFrame({"node": node[some], "links": links[some].astype(np.int64), "root": low[label][some]})


def exact_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, id_col: str, text_col: str, width: int, threshold: float) -> DataFrame:
    """(node, links, root) partial results of all pairs inside the candidate groups.  Written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    members = groups.join(sets.select("node", "copies", "size", "key"), "node")
    totals = written(groups.join(sets.select("node", "size"), "node").groupBy("component").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")), "groups")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = written(members.join(totals, "component").select("component", "node", "copies", "key", blocks.alias("blocks")), "members")
    key = row_key(id_col, text)
    own = docs.select(key.alias("key"), text.alias("t"))
    k, m = own["key"], members["key"]
    same = k["id"].eqNullSafe(m["id"]) & (k["a"] == m["a"]) & (k["b"] == m["b"])
    # rows equal in id and text give the same set: one of them is enough
    texts = own.join(members.hint("merge"), same).select("component", "node", "copies", "blocks", word_hashes(F.col("t")).alias("w"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.drop(columns="w").assign(tokens=[shingles(np.asarray(w, dtype=np.int64), width).tobytes() for w in pdf["w"]])

    built = texts.mapInPandas(build, "component bigint, node bigint, copies bigint, blocks int, tokens binary")
    keys = ["component", "p", "q"]
    rows = dealt(paired(built, "blocks", F.xxhash64("node")), keys).select(*keys, "part", "node", "copies", "tokens")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in streamed(batches, keys):
            out = verified(group.drop_duplicates("node"), threshold)
            if out is not None and len(out):
                yield out

    return written(rows.mapInPandas(run, "node bigint, links bigint, root bigint"), "links")


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document: id, a, b (row key), class_id, n_links (other documents linked), kept (one row key per class)."""
    rows = described(docs, id_col, text_col, width)
    sets = distinct_sets(rows)
    groups = written(components(candidate_edges(sets, threshold), "u", "v"), "candidates")
    links = exact_links(docs, sets, groups, id_col, text_col, width, threshold)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), "u", "v")
    named = (sets.select("node", "f1", "f2", "size", "copies", "key").join(classes, "node", "left").join(counts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    named = written(named, "classes")
    heads = written(named.groupBy("component").agg(F.min("key").alias("head"), F.min("key.id").alias("class_id")), "heads")
    named = written(named.join(heads, "component").select("f1", "f2", "size", "copies", "links", "head", "class_id"), "named")
    out = rows.select("id", "a", "b", "f1", "f2", "size").join(named, ["f1", "f2", "size"], "left")
    alone = F.col("size") == 0
    head = F.col("head")
    first = F.col("id").eqNullSafe(head["id"]) & (F.col("a") == head["a"]) & (F.col("b") == head["b"])
    return out.select("id", "a", "b", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                      (alone | F.coalesce(first, F.lit(False))).alias("kept"))
