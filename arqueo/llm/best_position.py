"""Ranked lexical search with the Best Position Algorithm.

Method: each term of a query has an impact list, its documents by descending
impact.  The lists are read from the top in parallel; every document met is looked
up in the other lists by direct access, which gives its whole score and marks its
places there as seen.  A list's best position is the end of its contiguous seen
places, however they came to be seen, so it lies at or beyond the last place read.
No unseen document can score more than the sum of the impacts at the best
positions; a query stops once that sum is strictly below its k-th best score (a tie
could still be won by a smaller id).

Scale: one pass over the texts keeps a row per document with its number of terms
and its counts of query terms; it is written.  A pass over these rows sums up the
statistics.  In the last pass each task builds the lists of ``CHUNK`` postings at a
time and runs all queries on them, with the k-th scores so far carried along; k rows
per query and task go to the final ranking.  Documents never meet by term, so no
term is a hot key.  Queries go out in blocks of ``BLOCK`` bytes of text, which bounds
what is broadcast; more queries mean more passes.

Defined cases: a null or empty text has no terms, is no document of the
statistics and is never found; a query without terms has no results; every row of
the documents is a document of its own, so repeated rows stand behind one another;
a null doc_id comes first among ties; a repeated query has its results once for each
repeat; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Terms: digits, ASCII letters and everything beyond ASCII.
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Bytes of query text in a block, postings in a chunk, places of each list read in the first round.
BLOCK, CHUNK, STEP = 4_000_000, 1_000_000, 16
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms(text: str | None) -> list[str]:
    """The terms of a text, with A-Z lower-cased."""
    return TERM.findall(text.encode().translate(LOWER).decode()) if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_rows(docs: DataFrame, vocabulary: dict[str, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, t, f): per document with terms its number of terms, and the numbers and counts of its query terms, as
    little-endian 32-bit integers.  Written."""
    kind = docs.schema[id_col].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            rows, n, t, f = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                own = terms(text)
                if not own:
                    continue
                known = np.array([v for v in map(get, own) if v is not None], "<i4")
                which, times = np.unique(known, return_counts=True)
                rows.append(row)
                n.append(len(own))
                t.append(which.tobytes())
                f.append(times.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(t, pa.binary()),
                                              pa.array(f, pa.binary())], names=["id", "n", "t", "f"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("t", T.BinaryType()), T.StructField("f", T.BinaryType())])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(texts.mapInArrow(count, schema), "terms")


def statistics(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the document count of each of the ``size`` query terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n_docs += batch.num_rows
            n_terms += pc.sum(batch.column(0)).as_py() or 0
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4"), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*held.tolist(), -1, -2], pa.int64()), pa.array([*df[held].tolist(), n_docs, n_terms], pa.int64())], names=["term", "n"])

    total = {r.term: r.n for r in rows.select("n", "t").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return total.get(-1, 0), total.get(-2, 0), np.array([total.get(t, 0) for t in range(size)], np.int64)


class ImpactLists:
    """The impact lists of a chunk of documents, with direct access by document.

    Documents are places in a list that is sorted by id, so that a smaller place is a smaller id.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        by_doc = np.lexsort((doc, term))
        self.doc, self.impact, term = doc[by_doc], impact[by_doc], term[by_doc]
        self.start = np.searchsorted(term, np.arange(n_terms + 1))
        # by impact: which posting stands at a place of its list, and at which place a posting stands
        self.order = np.lexsort((self.doc, -self.impact, term))
        self.place = np.empty(len(term), np.int64)
        self.place[self.order] = np.arange(len(term)) - self.start[term[self.order]]
        self.n_docs = n_docs

    def search(self, query: list[tuple[int, int]], k: int, best: np.ndarray, trace: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that can be among the ``k`` best beside earlier scores ``best`` (descending), for a query
        of (term, repeats)."""
        lists = [(self.start[t], self.start[t + 1], times) for t, times in query if self.start[t] < self.start[t + 1]]
        known = np.zeros(self.n_docs, bool)
        seen = [np.zeros(b - a, bool) for a, b, _ in lists]
        ends = [0] * len(lists)
        found, scores = [], []
        depth, step = 0, STEP
        while lists:
            met = np.concatenate([self.doc[self.order[a + depth:min(a + depth + step, b)]] for a, b, _ in lists])
            new = np.unique(met)
            new = new[~known[new]]
            known[new] = True
            score = np.zeros(len(new), np.int64)
            bound = 0
            for i, (a, b, times) in enumerate(lists):
                # direct access: the posting of each new document in this list
                own = self.doc[a:b]
                at = np.searchsorted(own, new)
                at[at == len(own)] = 0
                hit = own[at] == new
                at = at[hit] + a
                score[hit] += times * self.impact[at]
                seen[i][self.place[at]] = True
                if ends[i] < b - a:
                    rest = seen[i][ends[i]:]
                    gap = int(rest.argmin())
                    ends[i] = b - a if rest[gap] else ends[i] + gap
                if ends[i] < b - a:  # a list seen to its end adds nothing to an unseen document
                    bound += times * int(self.impact[self.order[a + ends[i] - 1]])
            found.append(new)
            scores.append(score)
            best = -np.sort(-np.concatenate([best, score[score > 0]]))[:k]
            if bound == 0 or len(best) == k and bound < best[-1]:
                break
            depth, step = depth + step, step * 2
        if trace is not None:
            trace.update(read=min(depth + step, max((b - a for a, b, _ in lists), default=0)), ends=ends, n_scored=int(known.sum()))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, score = np.concatenate(found), np.concatenate(scores)
        top = np.lexsort((docs, -score))[:k]
        top = top[score[top] > 0]
        return docs[top], score[top]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with about ``CHUNK`` postings at a time."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(np.array(pc.binary_length(batch.column(2)).to_pylist(), np.int64) // 4)
        lo = 0
        while lo < batch.num_rows:
            done = ends[lo - 1] if lo else 0
            hi = min(int(np.searchsorted(ends, done + CHUNK - size)) + 1, batch.num_rows)
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi - 1] - done)
            lo = hi
            if size >= CHUNK:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def lists_of(rows: pa.Table, n_docs: int, n_terms: int, weights: np.ndarray) -> tuple[ImpactLists, pa.Array]:
    """The impact lists of (id, n, t, f) rows, and the ids in their order."""
    rows = rows.take(pc.sort_indices(rows.column("id"), null_placement="at_start"))
    t, f = rows.column("t").to_pylist(), rows.column("f").to_pylist()
    term, tf = np.frombuffer(b"".join(t), "<i4").astype(np.int64), np.frombuffer(b"".join(f), "<i4").astype(np.int64)
    n = np.array(rows.column("n").to_pylist(), np.int64)
    doc = np.repeat(np.arange(len(n)), [len(x) // 4 for x in t])
    m = 75 + (25 * n * n_docs) // n_terms
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    return ImpactLists(doc, term, impact, len(n), len(weights)), rows.column("id")


def search_block(docs: DataFrame, queries: list[tuple], k: int, id_col: str, text_col: str) -> DataFrame:
    """(query, id, score): the ``k`` best documents of each task for each of the queries (their texts), by number."""
    counted = [Counter(terms(text)) for text in queries]
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
    asked = [[(vocabulary[t], times) for t, times in sorted(c.items())] for c in counted]
    rows = term_rows(docs, vocabulary, id_col, text_col)
    n_docs, n_terms, df = statistics(rows, len(vocabulary))
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    kind = rows.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list[tuple]] = {}
        id_type = None
        for chunk in chunks(batches):
            lists, ids = lists_of(chunk, n_docs, n_terms, weights)
            id_type = ids.type
            for q, query in enumerate(asked):
                own = top.get(q, [])
                found, scores = lists.search(query, k, np.array([-x[0] for x in own], np.int64))
                more = [(-s, i is not None, i) for s, i in zip(scores.tolist(), ids.take(pa.array(found)).to_pylist())]
                if more:
                    top[q] = sorted(own + more, key=lambda x: x if x[1] else x[:2])[:k]
        if top:
            flat = [(q, x[2], -x[0]) for q, own in top.items() for x in own]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], id_type),
                                              pa.array([x[2] for x in flat], pa.int64())], names=["query", "id", "score"])

    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("id", kind), T.StructField("score", T.LongType())])
    return rows.where(F.octet_length("t") > 0).mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each row of ``items``."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item"), F.col(query_col).cast("string").alias("text")).where("text IS NOT NULL")
    asked = written(asked.groupBy("item", "text").agg(F.count("*").alias("times")), "queries")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK
    out = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        best = search_block(docs, [r.text for r in own], k, id_col, text_col)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item, r.times) for i, r in enumerate(own)], T.StructType([
            T.StructField("query", T.LongType()), T.StructField("item", asked.schema["item"].dataType), T.StructField("times", T.LongType())]))
        best = best.join(names, "query").select("item", "rank", "id", "score", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("repeat"))
        best = best.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        out = best if out is None else out.union(best)
    return out
