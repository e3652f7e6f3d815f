"""Packing token sequences of a fixed capacity.

Method (exact-complement hashing): only how many pieces there are of each length
matters, a table of at most ``capacity`` counts whatever the number of documents.
The longest open piece starts a pattern; the gap left is looked up among single
lengths, in an index from sums to pairs of lengths, and as a length and a pair of
that index (triple sums), under the counts still available; while no combination
fills it exactly, the longest piece that fits is put in (best fit).
A pattern is used as often as its counts allow at once, so the plan is short.
Spark then ranks the pieces of each length (in hash buckets, so that a very
frequent length is not one group) and each rank finds its place in the plan.

Defined cases: a null text is the empty one and gives one piece of the end token
alone; repeated rows each get their own pieces; a null id is kept as null; empty
tables give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import text_bytes, tokenizer_path
from .common import written


class SumIndex:
    """Available lengths, and an index from each sum to the pairs of lengths that make it.

    The pairs of a sum lie together, the shorter length ascending.  Counts only fall, so a pair that has run out is linked
    past for good, and a lookup goes from live pair to live pair.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.have = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.have[length] = n
        lengths = np.flatnonzero(self.have).astype(np.int32)
        partners = [lengths[i:np.searchsorted(lengths, capacity - x, side="right")] for i, x in enumerate(lengths)]
        low = np.repeat(lengths, [len(p) for p in partners])
        total = low + np.concatenate([np.empty(0, np.int32), *partners])
        order = np.lexsort((low, total))
        self.low = low[order]
        self.start = np.searchsorted(total[order], np.arange(capacity + 2))
        #: The next pair of each pair that has run out; a live one's is itself.
        self.next = np.arange(len(low) + 1)

    def live(self, i: int) -> int:
        """The first pair from place ``i`` on that has not run out."""
        end = i
        while self.next[end] != end:
            end = self.next[end]
        while i != end:
            self.next[i], i = end, self.next[i]
        return int(end)

    def pair(self, total: int, most: int | None = None, held: int = 0) -> tuple[int, ...]:
        """Two available lengths with this sum, the longer one as long as can be (at most ``most``).

        One piece of length ``held`` is set aside by the caller for the time being.
        """
        i, end = int(self.start[total]), int(self.start[total + 1])
        if most is not None:
            i += int(np.searchsorted(self.low[i:end], total - most))
        i = self.live(i)
        while i < end:
            a = int(self.low[i])
            b = total - a
            if self.have[a] and self.have[b] and (a != b or self.have[a] > 1):
                return b, a
            if held not in (a, b):
                self.next[i] = i + 1
            i = self.live(i + 1)
        return ()

    def fill(self, gap: int) -> tuple[int, ...]:
        """One, two or three available lengths that fill the gap exactly: a single one, else a pair of the index, else a
        length with a pair for what it leaves."""
        if self.have[gap] > 0:
            return (gap,)
        if two := self.pair(gap):
            return two
        for a in np.flatnonzero(self.have[:gap - 1] > 0)[::-1].tolist():
            if 3 * a < gap:
                break
            self.have[a] -= 1
            two = self.pair(gap - a, a, held=a)
            self.have[a] += 1
            if two:
                return (a, *two)
        return ()

    def longest(self, gap: int) -> int:
        at = np.flatnonzero(self.have[:gap + 1] > 0)
        return int(at[-1]) if len(at) else 0


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns [(length, how often), ...] longest first, and how many sequences have each."""
    for length in counts:
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} for capacity {capacity}")
    sums, out = SumIndex(counts, capacity), []
    while first := sums.longest(capacity):
        used, gap = Counter(), capacity
        add: tuple[int, ...] = (first,)
        while add:
            for x in add:
                used[x] += 1
                sums.have[x] -= 1
                gap -= x
            if not gap:
                break
            add = sums.fill(gap) or ((x,) if (x := sums.longest(gap)) else ())
        for x, k in used.items():
            sums.have[x] += k
        times = min(int(sums.have[x]) // k for x, k in used.items())
        for x, k in used.items():
            sums.have[x] -= k * times
        out.append((sorted(used.items(), reverse=True), times))
    return out


class Places:
    """For the pieces of a length, by rank: sequence and offset."""

    def __init__(self, patterns: list[tuple[list[tuple[int, int]], int]]):
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for items, times in patterns:
            offset = 0
            for length, k in items:
                by.setdefault(length, []).append((k * times, k, sequence, offset))
                offset += length * k
            sequence += times
        self.by = {}
        for length, rows in by.items():
            n, k, first, offset = np.array(rows, dtype=np.int64).T
            self.by[length] = (np.cumsum(n), n, k, first, offset)

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            ends, n, k, first, start = self.by[int(x)]
            e = np.searchsorted(ends, rank[at], side="right")
            inside = rank[at] - (ends[e] - n[e])
            sequence[at] = first[e] + inside // k[e]
            offset[at] = start[e] + inside % k[e] * x
        return sequence, offset


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
           vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and end token, cut at the capacity."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = text_bytes(tokenizer_path(vocabulary))
        for pdf in batches:
            # some millions of characters at a time
            size = pdf["text"].str.len().fillna(0).cumsum().to_numpy()
            for _, part in pdf.groupby(size // 8_000_000, sort=False):
                ids = encode.batch([x if isinstance(x, str) else "" for x in part["text"]])
                rows = []
                for doc, data in zip(part["id"], ids):
                    data += end
                    for p, at in enumerate(range(0, len(data), 4 * capacity)):
                        cut = data[at:at + 4 * capacity]
                        rows.append((doc, p, at // 4, len(cut) // 4, zlib.crc32(cut)))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # ids go through pandas as text: a column of integers with a null would be one of floats
    return (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInPandas(run, "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint")
            .withColumn("doc_id", F.col("doc_id").cast(kind)))


def pack(cut: DataFrame, capacity: int = 4096, buckets: int = 256) -> DataFrame:
    """``cut`` (doc_id, piece, length and more) with sequence_id and offset of each piece.

    ``buckets``: hash buckets in which the pieces of one length are ranked.
    """
    spark = cut.sparkSession
    cut = written(cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")), "pieces")
    counts = written(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    patterns = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = counts.select("length", "bucket", (F.sum("n").over(W.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = (cut.withColumn("rank", rank).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "bucket"))
    shared = spark.sparkContext.broadcast(Places(patterns))
    names = [c for c in ranked.columns if c != "rank"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = shared.value
        for pdf in batches:
            sequence, offset = places(pdf["length"].to_numpy(), pdf["rank"].to_numpy())
            yield pdf[names].assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'doc_id' else f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    out = ranked.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, f"{schema}, sequence_id bigint, offset bigint")
    return out.withColumn("doc_id", F.col("doc_id").cast(ranked.schema["doc_id"].dataType)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
                   vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    return pack(pieces(docs, id_col, text_col, capacity, end_id, vocabulary), capacity)
