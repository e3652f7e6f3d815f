"""Exact cosine near-duplicates of embeddings by dual traversal of cover trees.

Method: for unit vectors a cosine of at least ``threshold`` is a distance of at
most tau = sqrt(2 - 2 threshold).  A cover tree has nested levels whose radii
halve; a node's covering radius is the largest distance of its vectors.  Two
nodes whose centres are further apart than both covering radii and tau hold no
pair, so their subtrees are never looked at; what is left at the leaves is
compared in double precision.

On Spark the tree's upper part is built level by level (``upper_levels``): every
cell of more than ``BLOCK`` vectors is split by farthest-first centres, found in a
sample of about ``SAMPLE`` of its vectors and chosen until half its radius covers
that sample, ``FANOUT`` at most; its vectors are dealt to tasks in parts.  The nodes
are a table.  Pairs of leaves come from a descent of the tree against itself, a join
of levels in which covering angles (which add up, and bound closer than distances)
rule out pairs after every step (``leaf_pairs``).  Pairs of leaf blocks are the pieces
of work; a vector visits those blocks that its own angle to their centre does not rule
out.  Each piece builds the lower levels of both blocks' trees and traverses them
together.  A leaf whose covering angle is below half the threshold's is not compared
with itself: all its vectors link.  Links are counted where they are found and only a
spanning forest is written, so the result is linear in the vectors however large a
cluster is.

Without cluster structure the bounds rule out little, as for any exact method in
many dimensions: the number of compared block pairs is then quadratic.

Defined cases: vectors that are null, of length 0 or zero norm, or that hold a
null or a non-finite component link with nothing; vectors of different lengths
do not link; equal vectors are one vector with a multiplicity; a null id counts
as a link of others and is in no component of its own number; labels and other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, dealt, roots, streamed, written

SAMPLE, BLOCK, VISITORS, TOGETHER = 2_048, 4_096, 16_384, 2_048
#: Children of a cell at most, levels at most, vectors of a cell dealt to one task, groups that the hosts of a block come in; visitors of one tree: ``TOGETHER``.
FANOUT, DEPTH, PART, STRIPES = 64, 24, 8_192, 4
#: Radii of the nested levels inside a block.
LEVELS = (1.0, 0.5, 0.25)
#: Bounds on distances are widened by this much against rounding.
HAIR = 1e-6


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with v the vector in double precision where it can link, else null."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_col).alias("id"), F.when(v.isNotNull() & (F.size(v) > 0) & ~bad & ~zero, v).alias("v"))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest component, so that squares neither overflow nor vanish)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def farthest_first(x: np.ndarray, most: int, enough: float = HAIR) -> np.ndarray:
    """Places of up to ``most`` centres, each the farthest from those before it, until all are within ``enough``: every prefix is a level of a nested cover."""
    order, far = [0], apart(x, x[:1])[:, 0]
    while len(order) < min(most, len(x)):
        nxt = int(far.argmax())
        if far[nxt] <= enough:
            break
        order.append(nxt)
        far = np.minimum(far, apart(x, x[nxt:nxt + 1])[:, 0])
    return np.array(order)


class Tree:
    """Lower levels of a block's tree: at each level the centres, their covering radii and their children.

    All distances inside the block are one matrix product (a block is of bounded size); a level then picks as centres,
    inside each node above, the vectors that no earlier centre covers.
    """

    def __init__(self, x: np.ndarray):
        self.x, n = x, len(x)
        cosine = x @ x.T
        owner, self.levels, self.leaves = np.zeros(n, np.int64), [], []
        for radius in LEVELS:
            near = cosine >= 1 - radius**2 / 2
            node, free = np.full(n, -1), np.ones(n, bool)
            alone = np.bincount(owner)[owner] == 1 if n else free
            centres = np.flatnonzero(alone).tolist()
            node[alone], free[alone] = np.arange(len(centres)), False
            for i in np.lexsort((np.arange(n), owner)).tolist():  # node by node
                if free[i]:
                    own = near[i] & free
                    if self.levels:
                        own &= owner == owner[i]
                    own = np.flatnonzero(own)
                    node[own] = node[i] = len(centres)
                    free[own] = free[i] = False
                    centres.append(i)
            centres = np.array(centres, np.int64)
            order = np.argsort(owner[centres], kind="stable")  # children of one node follow one another
            number = np.empty(len(centres), np.int64)
            number[order] = np.arange(len(centres))
            centres, node, above = centres[order], number[node], owner[centres[order]]
            cover = np.zeros(len(centres))
            np.maximum.at(cover, node, np.sqrt(np.maximum(2 - 2 * cosine[np.arange(n), centres[node]], 0)))
            cover[np.bincount(node, minlength=len(centres)) == 1] = 0  # a vector alone: not even rounding
            # children of a node above follow one another: first place and number
            count = np.bincount(above, minlength=owner.max() + 1 if n else 0)
            self.levels.append((centres, cover, np.cumsum(count) - count, count))
            owner = node
        order = np.argsort(owner, kind="stable")
        self.leaves = np.split(order, np.cumsum(np.bincount(owner))[:-1]) if n else []
        self.leaf_size = np.array([len(m) for m in self.leaves])


def expanded(i: np.ndarray, j: np.ndarray, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the given pairs of nodes; a and b: first child and number of children of each node."""
    (first_a, count_a), (first_b, count_b) = a, b
    nb = count_b[j]
    total = count_a[i] * nb
    owner = np.repeat(np.arange(len(total)), total)
    inside = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return first_a[i][owner] + inside // nb[owner], first_b[j][owner] + inside % nb[owner]


def traverse(a: Tree, b: Tree, tau: float, threshold: float, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all pairs with a cosine of at least the threshold; ``itself``: a is b, each pair once."""
    none = np.zeros(0, np.int64)
    if not len(a.x) or not len(b.x):
        return none, none
    # below the roots every centre meets every other one: one matrix product
    (ca, ra, _, _), (cb, rb, _, _) = a.levels[0], b.levels[0]
    cosine = a.x[ca] @ b.x[cb].T
    keep = cosine >= 1 - (tau + HAIR) ** 2 / 2  # between centres without a cover
    wide_a, wide_b = np.flatnonzero(ra > 0), np.flatnonzero(rb > 0)
    keep[wide_a] = cosine[wide_a] >= 1 - np.minimum(ra[wide_a][:, None] + rb[None, :] + tau + HAIR, 2) ** 2 / 2
    keep[:, wide_b] = cosine[:, wide_b] >= 1 - np.minimum(ra[:, None] + rb[wide_b][None, :] + tau + HAIR, 2) ** 2 / 2
    i, j = np.nonzero(keep)
    for (ca, ra, fa, na), (cb, rb, fb, nb) in zip(a.levels[1:], b.levels[1:]):
        if itself:
            i, j = i[i <= j], j[i <= j]
        keep_i, keep_j = [none], [none]
        for lo in range(0, len(i), 20_000):  # pairs of children, pruned by the covering radii
            p, q = expanded(i[lo:lo + 20_000], j[lo:lo + 20_000], (fa, na), (fb, nb))
            for at in range(0, len(p), 100_000):
                u, v = p[at:at + 100_000], q[at:at + 100_000]
                d = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", a.x[ca[u]], b.x[cb[v]]), 0))
                ok = d <= ra[u] + rb[v] + tau + HAIR
                keep_i.append(u[ok])
                keep_j.append(v[ok])
        i, j = np.concatenate(keep_i), np.concatenate(keep_j)
    if itself:
        i, j = i[i <= j], j[i <= j]
    found_a, found_b = [none], [none]
    single = (a.leaf_size[i] == 1) & (b.leaf_size[j] == 1)
    ends_a, ends_b = np.array([m[0] for m in a.leaves]), np.array([m[0] for m in b.leaves])
    for lo in range(0, int(single.sum()), 100_000):
        x, y = ends_a[i[single][lo:lo + 100_000]], ends_b[j[single][lo:lo + 100_000]]
        ok = np.einsum("ij,ij->i", a.x[x], b.x[y]) >= threshold
        if itself:
            ok &= x != y
        found_a.append(x[ok])
        found_b.append(y[ok])
    for p, q in zip(i[~single].tolist(), j[~single].tolist()):
        ma, mb = a.leaves[p], b.leaves[q]
        x, y = np.nonzero(a.x[ma] @ b.x[mb].T >= threshold)
        x, y = ma[x], mb[y]
        if itself and p == q:
            x, y = x[x < y], y[x < y]
        found_a.append(x)
        found_b.append(y)
    return np.concatenate(found_a), np.concatenate(found_b)


def angles(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def vectors_of(rows, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(-1, dimension)


def centres_of(pdf: pd.DataFrame, dimension: int) -> pd.DataFrame:
    """Centres of one cell's children, farthest first: the vector farthest from the cell's centre and its sample, to half its radius."""
    n, cover = int(pdf["n"].iloc[0]), float(pdf["cover"].iloc[0])
    x = vectors_of([pdf["far"].iloc[0], *pdf.sort_values("node")["v"]], dimension)
    centres = x[farthest_first(x, min(FANOUT, max(2, math.ceil(n / BLOCK))), 2 * math.sin(cover / 4))]
    return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "parts": [math.ceil(n / PART)], "centres": [centres.tobytes()]})


def children_of(vectors: pd.DataFrame, centres: pd.DataFrame, dimension: int) -> pd.DataFrame:
    """A part of one cell's vectors, each with the child of nearest centre, the angle to it and the centre."""
    if not len(vectors):
        return pd.DataFrame(columns=["node", "copies", "v", "parent", "cell", "d", "centre"])
    c = vectors_of(centres["centres"], dimension)
    cosine = vectors_of(vectors["v"], dimension) @ c.T
    at, parent = cosine.argmax(axis=1), vectors["cell"].iloc[0]
    return vectors[["node", "copies", "v"]].assign(parent=parent, cell=[f"{parent}.{k}" for k in at], d=angles(cosine.max(axis=1)),
                                                   centre=[c[k].tobytes() for k in at])


def upper_levels(vectors: DataFrame, dimension: int, theta: float) -> tuple[DataFrame, DataFrame, int]:
    """The tree above the blocks: (vectors (node, copies, v, cell), nodes (depth, parent, cell, centre, cover, n, leaf, tight), depth).

    A level splits all cells of more than ``BLOCK`` vectors at once.  Two kinds of leaves may be larger: a ``tight`` one,
    whose vectors all link (its covering angle is below half the threshold's), and what ``DEPTH`` levels have not split.
    """
    # written, so that the first level's joins too are by a column and not by a constant
    start = written(vectors.withColumns({"parent": F.lit(""), "cell": F.lit("0"), "d": F.lit(math.pi), "centre": F.col("v")}), "root")
    leaves, nodes, depth = None, None, 0
    while True:
        found = start.groupBy("parent", "cell").agg(F.count("*").alias("n"), F.max("d").alias("cover"), F.max_by("v", F.struct("d", "node")).alias("far"),
                                                    F.first("centre").alias("centre"))
        tight = F.col("cover") <= (theta - HAIR) / 2
        big = (F.col("n") > BLOCK) & ~tight & F.lit(depth < DEPTH)
        found = written(found.select(F.lit(depth).alias("depth"), "*", (~big).alias("leaf"), tight.alias("tight")), "cells")
        own = found.drop("far")
        nodes = own if nodes is None else nodes.union(own)
        open_ = found.where("NOT leaf")
        done = start.join(found.where("leaf").select("cell"), "cell").select("node", "copies", "v", "cell")
        leaves = done if leaves is None else leaves.union(done)
        if open_.isEmpty():
            return leaves, nodes, depth
        # a sample of the same size from every cell, however large it is, and its farthest vector
        rows = start.select("node", "copies", "v", "cell").join(open_.select("cell", "n", "cover", "far"), "cell")
        sample = rows.where(F.pmod(F.xxhash64(F.lit(3), "node"), F.col("n")) < SAMPLE).select("node", "v", "cell", "n", "cover", "far")
        sample = sample.union(open_.select(F.lit(-1).cast("long"), "far", "cell", "n", "cover", "far"))
        centres = written(sample.groupBy("cell").applyInPandas(lambda pdf: centres_of(pdf, dimension), "cell string, parts int, centres binary"), "centres")
        part = F.pmod(F.xxhash64(F.lit(4), "node"), F.col("parts")).cast("int")
        dealt_out = (start.select("node", "copies", "v", "cell").join(centres.select("cell", "parts"), "cell").withColumn("part", part)
                     .drop("parts").groupBy("cell", "part"))
        each = centres.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).groupBy("cell", "part")
        start = written(dealt_out.cogroup(each).applyInPandas(
            lambda v, c: children_of(v, c, dimension),
            "node bigint, copies bigint, v binary, parent string, cell string, d double, centre binary"), "level")
        depth += 1


def near(pairs: DataFrame, dimension: int, theta: float) -> DataFrame:
    """Those pairs of nodes (a, b, with their centres and covers) that the covering angles do not rule out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cosine = np.einsum("ij,ij->i", vectors_of(pdf["a_centre"], dimension), vectors_of(pdf["b_centre"], dimension))
                yield pdf[angles(cosine) <= pdf["a_cover"].to_numpy() + pdf["b_cover"].to_numpy() + theta + HAIR]

    return pairs.mapInPandas(run, pairs.schema)


def leaf_pairs(nodes: DataFrame, depth: int, dimension: int, theta: float) -> DataFrame:
    """Pairs (a, b) of leaves that may hold links, a = b among them: both trees are gone down together, level by level."""
    both = [F.col(c).alias(f"{x}_{c}") for x in "ab" for c in ("centre", "cover")]
    pairs = nodes.where("depth = 0").select(F.col("cell").alias("a"), F.col("cell").alias("b"), *both)
    for level in range(1, depth + 1):
        # leaves above this level stand for themselves
        below = nodes.where(F.col("depth") == level).select("parent", "cell", "centre", "cover").union(
            nodes.where((F.col("depth") < level) & F.col("leaf")).select(F.col("cell").alias("parent"), "cell", "centre", "cover"))
        for x, y in ("ab", "ba"):
            # the children of a node within a pair with itself meet each other once, when both sides have gone down
            same = F.col("same") if x == "b" else (F.col("a") == F.col("b"))
            pairs = pairs.withColumn("same", same).withColumnRenamed(x, "parent").drop(f"{x}_centre", f"{x}_cover")
            pairs = pairs.join(below.select("parent", F.col("cell").alias(x), F.col("centre").alias(f"{x}_centre"), F.col("cover").alias(f"{x}_cover")), "parent")
            pairs = near(pairs.drop("parent"), dimension, theta)
        pairs = written(pairs.where("NOT same OR a <= b").drop("same"), "pairs")
    return pairs.select("a", "b")


def linked(vectors: DataFrame, dimension: int, threshold: float) -> DataFrame:
    """(node, links, root): partial results of each piece of work over vectors (node, copies, v) of one length."""
    tau, theta = math.sqrt(2 - 2 * threshold), math.acos(max(-1.0, min(1.0, threshold)))

    def scaled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(v=[r.tobytes() for r in unit(np.stack(pdf["v"].to_numpy()))])

    own, nodes, depth = upper_levels(vectors.mapInPandas(scaled, "node bigint, copies bigint, v binary"), dimension, theta)
    pairs = leaf_pairs(nodes, depth, dimension, theta)
    # blocks: a leaf is one but for the large ones, which are cut by hash
    count = F.ceil(F.col("n") / BLOCK).cast("int")
    blocks = written(nodes.where("leaf").select("cell", "centre", "cover", "tight", "n", count.alias("count"), F.explode(F.sequence(F.lit(0), count - 1)).alias("part"))
                     .withColumn("block", F.monotonically_increasing_id()), "blocks")
    side = lambda x, *more: blocks.select(F.col("cell").alias(x), F.col("block").alias(f"{x}_block"), *more)
    held = F.ceil(F.col("n") / F.col("count"))
    met = (pairs.join(side("a", F.col("tight").alias("a_tight"), held.alias("a_n"), F.col("centre").alias("a_centre"), F.col("cover").alias("a_cover")), "a")
           .join(side("b", held.alias("b_n"), F.col("centre").alias("b_centre"), F.col("cover").alias("b_cover")), "b")
           .where("a_block != b_block AND (a != b OR (a_block < b_block AND NOT a_tight))"))
    # vectors of one block visit the other: those of the smaller block travel
    go = F.expr("a_n < b_n OR (a_n = b_n AND a_block < b_block)")
    pick = lambda p, q, name: F.when(go, F.col(p)).otherwise(F.col(q)).alias(name)
    met = met.select(pick("a_block", "b_block", "block"), pick("a_n", "b_n", "n"), pick("b_block", "a_block", "to"),
                     pick("b_centre", "a_centre", "centre"), pick("b_cover", "a_cover", "cover"))
    met = written(met, "meetings")
    chunks = met.groupBy(F.col("to").alias("block")).agg(F.ceil(F.sum("n") / VISITORS).cast("int").alias("chunks"))
    blocks = written(blocks.join(chunks, "block", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))), "blocks")
    place = F.pmod(F.xxhash64(F.lit(6), "node"), F.col("count")).cast("int")
    own = written(own.join(nodes.where("leaf").select("cell", "tight", count.alias("count")), "cell").withColumn("part", place)
                  .join(blocks.select("cell", "part", "block", "chunks"), ["cell", "part"]).select("node", "copies", "v", "cell", "tight", "block", "chunks"), "placed")
    # hosts of a block, so many at a time
    hosts = met.join(blocks.select(F.col("block").alias("to"), "chunks"), "to").withColumn("stripe", F.pmod(F.xxhash64("to"), F.lit(STRIPES)).cast("int"))
    stripes = written(hosts.select("block", "stripe").distinct(), "stripes")

    def send(v: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
        """A block's vectors to those hosts where a partner can be: no further from the host's centre than its cover and the threshold."""
        if not len(v) or not len(h):
            return pd.DataFrame(columns=["to", "chunks", "node", "copies", "v"])
        ok = angles(vectors_of(v["v"], dimension) @ vectors_of(h["centre"], dimension).T) <= h["cover"].to_numpy()[None, :] + theta + HAIR
        row, to = np.nonzero(ok)
        return v[["node", "copies", "v"]].iloc[row].assign(to=h["to"].to_numpy()[to], chunks=h["chunks"].to_numpy()[to])[["to", "chunks", "node", "copies", "v"]]

    sent = (own.join(stripes, "block").select("block", "stripe", "node", "copies", "v").groupBy("block", "stripe")
            .cogroup(hosts.select("block", "stripe", "to", "chunks", "centre", "cover").groupBy("block", "stripe"))
            .applyInPandas(send, "to bigint, chunks int, node bigint, copies bigint, v binary"))
    sent = sent.select("to", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("chunks")).cast("int").alias("chunk"), F.lit(True).alias("visitor"),
                       F.lit(False).alias("tight"), "node", "copies", "v")
    # a block's own vectors go along with each chunk of its visitors
    homes = own.select(F.col("block").alias("to"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("visitor"),
                       "tight", "node", "copies", "v")
    keys = ["to", "chunk"]
    rows = dealt(sent.union(homes), keys)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in streamed(batches, keys):
            out = compared(group, dimension, tau, threshold)
            if len(out):
                yield out

    # in a tight leaf all vectors link: counted, not compared
    whole = own.where("tight").groupBy("cell").agg(F.sum("copies").alias("all"), F.min("node").alias("root"), F.count("*").alias("size")).where("size > 1")
    inside = own.where("tight").join(whole, "cell").select("node", (F.col("all") - F.col("copies")).alias("links"), "root")
    return rows.mapInPandas(work, "node bigint, links bigint, root bigint").union(inside)


def compared(group: pd.DataFrame, dimension: int, tau: float, threshold: float) -> pd.DataFrame:
    """Links between a block's vectors and a chunk of its visitors, and (with the first chunk) among its own."""
    x = np.frombuffer(b"".join(group["v"]), dtype=np.float64).reshape(-1, dimension)
    node, copies, visitor = (group[c].to_numpy() for c in ("node", "copies", "visitor"))
    visitor = visitor.astype(bool)
    own, others = np.flatnonzero(~visitor), np.flatnonzero(visitor)
    tree = Tree(x[own])
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if group["chunk"].iloc[0] == 0 and not group["tight"].any():
        i, j = traverse(tree, tree, tau, threshold, True)
        a.append(own[i])
        b.append(own[j])
    for lo in range(0, len(others), TOGETHER):
        part = others[lo:lo + TOGETHER]
        i, j = traverse(tree, Tree(x[part]), tau, threshold, False)
        a.append(own[i])
        b.append(part[j])
    i, j = np.concatenate(a), np.concatenate(b)
    links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
    label = roots(len(node), i, j)
    low = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(low, label, node)
    some = links > 0
    return pd.DataFrame({"node": node[some], "links": links[some].astype(np.int64), "root": low[label][some]})


def link_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col)
    keyed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    sets = written(keyed.where("v IS NOT NULL").groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("id").alias("low"), F.first("v").alias("v"))
                   .withColumn("node", F.monotonically_increasing_id()), "vectors")
    partial = None
    for r in sets.select(F.size("v").alias("dimension")).distinct().collect():
        own = linked(sets.where(F.size("v") == r["dimension"]).select("node", "copies", "v"), r["dimension"], threshold)
        partial = own if partial is None else partial.union(own)
    if partial is None:
        partial = spark.createDataFrame([], "node bigint, links bigint, root bigint")
    partial = written(partial, "links")
    counts = partial.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(partial.select(F.col("node").alias("u"), F.col("root").alias("v")), "u", "v")
    named = sets.select("node", "h1", "h2", "copies", "low").join(classes, "node", "left").join(counts, "node", "left")
    named = written(named.withColumn("component", F.coalesce("component", "node")), "classes")
    heads = written(named.groupBy("component").agg(F.min("low").alias("component_id")), "heads")
    named = written(named.join(heads, "component").select("h1", "h2", "copies", "links", "component_id"), "named")
    # vectors that cannot link keep their hashes apart from all others: null keys match nothing
    out = keyed.select("id", *(F.when(F.col("v").isNotNull(), F.col(h)).alias(h) for h in ("h1", "h2"))).join(named, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return out.select(F.col("id").alias(id_col), links.cast("long").alias("n_links"), component.cast("long").alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
