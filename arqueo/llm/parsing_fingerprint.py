"""Document fingerprints by locally consistent parsing.

Method: a text is a sequence of symbols, first its code points.  On each level runs
of one symbol become one symbol named by (symbol, length); then deterministic coin
tossing labels every symbol by the lowest bit in which it differs from its left
neighbour, and by that bit's value, and repeats this on the labels until they are
below 6.  A local maximum of the labels begins a phrase.  Phrases are named by a hash
of their symbols, and the names are the symbols of the next level, until one is left.

Where phrases begin depends on five symbols to the left and one to the right, so
equal substrings are cut alike at any offset, but for a few phrases at their ends,
on every level.

The fingerprint keeps, for each of ``BINS`` bins of name hashes, 16 bits of the name
with the least weighted hash (0: none), a repeated name counting by its repeats.
Names of the second level (about ten characters) and above have weight 1; those of
the first count for little, but tell short and periodic texts apart.  The likeness of two fingerprints is the share of equal bins
among those that either fills, an estimate of the weighted Jaccard similarity of the
texts' names; it is 1 where both are empty.

Scale: the texts are sorted by id in one shuffle, and each task reads its part as a
stream, parsing ``SPAN`` code points at a time, all documents of a span at once.  Only a
part's last document waits for the first one of the next part; these are rows of a
written table, two per partition, and are joined by key.  Repeated rows are spread
over parts by their place in the input.

Defined cases: a null text is an empty one; rows equal in id and text are one
document, each row returned; rows of one id are ordered by hashes of their texts; a null
id comes first; a lone document is its own next one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chosen_path import mix
from .common import row_key, written

#: Bins of a fingerprint, weight of first-level names, code points and texts (below 2**20) parsed at once.
BINS, SHORT_WEIGHT, SPAN, SPAN_TEXTS = 64, 0.0625, 300_000, 10_000
RUN, PLACE, LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.array([0xA0761D6478BD642F], np.uint64)


def toss_table() -> np.ndarray:
    """The next label of each (left label, label), both below 128; equal labels do not occur."""
    left, own = np.divmod(np.arange(128 * 128), 128)
    low = (left ^ own) & -(left ^ own)
    return np.where(left == own, 0, 2 * np.bitwise_count(np.maximum(low, 1) - 1) + ((own & low) != 0)).astype(np.uint8)


TOSS = toss_table()


def labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 of symbols that differ from their left neighbours; ``first`` marks the first of each text."""
    starts = np.flatnonzero(first)
    differ = symbols.copy()
    differ[1:] ^= symbols[:-1]
    low = differ & (~differ + np.uint64(1))
    own = 2 * np.bitwise_count(low - np.uint64(1)) + ((symbols & low) != 0)
    own[starts] = symbols[starts] & np.uint64(1)
    for _ in range(3):  # below 128, 14, 8, 6
        at = own.astype(np.uint16)
        at[1:] |= at[:-1] << 7
        new = TOSS[at & 0x3FFF]
        new[starts] = own[starts] & 1
        own = new
    return own


def next_level(symbols: np.ndarray, counts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrase names of texts with ``counts`` symbols each, one text after the other, and the phrases per text."""
    starts = np.cumsum(counts) - counts
    first = np.zeros(len(symbols), bool)
    first[starts] = True
    changes = first.copy()
    changes[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(changes)
    if len(at) < len(symbols):
        lengths = np.diff(at, append=len(symbols)).astype(np.uint64)
        symbols, first = symbols[at], first[at]
        long = lengths > 1
        symbols[long] = mix(symbols[long] * RUN + lengths[long])
    own = labels(symbols, first)
    begins = first.copy()
    if len(own) > 2:
        # the last symbol of a text has no right neighbour, so it begins no phrase
        begins[1:-1] |= (own[1:-1] > own[:-2]) & (own[1:-1] > own[2:]) & ~first[2:]
    cuts = np.flatnonzero(begins)
    places = np.arange(len(symbols)) - np.repeat(cuts, np.diff(cuts, append=len(symbols)))
    names = mix(np.add.reduceat(mix(symbols + places.astype(np.uint64) * PLACE), cuts) + np.uint64(level) * LEVEL)
    heads = np.flatnonzero(first)
    return names, np.add.reduceat(begins.astype(np.int64), heads)


def fill(bins: np.ndarray, text: np.ndarray, names: np.ndarray, level: int) -> None:
    """Enter the names of texts (in order) into the bins: the least (weighted hash, 16 bits of the name) wins.

    A name that a text has c times enters once for every power of two up to c, with the weight of the occurrences since
    the last one, so that the whole weight grows with c.
    """
    each = np.sort(text.astype(np.uint64) << np.uint64(44) | mix(names ^ LEVEL) >> np.uint64(20))
    at = np.flatnonzero(np.append(True, each[1:] != each[:-1]))
    times = np.diff(at, append=len(each))
    each, power = each[at], 0
    while len(each):
        h = mix((each & np.uint64(2**44 - 1)) * RUN + np.uint64(power))
        u = (((h >> np.uint64(6)) & np.uint64(0xFFFFFFFF)).astype(np.float64) + 1) / 2.0**32
        weight = (SHORT_WEIGHT if level == 1 else 1.0) * 2.0 ** max(power - 1, 0)
        value = (-np.log(u) / weight).astype(np.float32).view(np.uint32).astype(np.uint64)
        mark = np.maximum(h >> np.uint64(48), np.uint64(1))
        place = (each >> np.uint64(44)) * np.uint64(BINS) + (h & np.uint64(BINS - 1))
        np.minimum.at(bins, place.astype(np.int64), value << np.uint64(16) | mark)
        power += 1
        more = times >= 2**power
        each, times = each[more], times[more]


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of ``BINS`` 16-bit marks per text."""
    none = np.uint64(2**64 - 1)
    bins = np.full(len(texts) * BINS, none, np.uint64)
    counts = np.array([len(t) for t in texts], np.int64)
    symbols = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    text = np.flatnonzero(counts)
    counts, level = counts[text], 0
    while len(text):
        level += 1
        symbols, counts = next_level(symbols, counts, level)
        owner = np.repeat(text, counts)
        fill(bins, owner, symbols, level)
        more = counts > 1
        symbols, text, counts = symbols[np.repeat(more, counts)], text[more], counts[more]
    return np.where(bins == none, 0, bins & np.uint64(0xFFFF)).astype("<u2").reshape(len(texts), BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that either fingerprint of a row fills; 1 where both are empty."""
    used = ((a > 0) | (b > 0)).sum(axis=-1)
    return np.where(used == 0, 1.0, ((a == b) & (a > 0)).sum(axis=-1) / np.maximum(used, 1))


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``after``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + after[:cut]


RESULT = [T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.BinaryType()),
          T.StructField("edited_fingerprint", T.BinaryType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]


def compared(texts: list[str], own: np.ndarray) -> list[tuple]:
    """The result of each text but the last, the next one being its successor."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    new = fingerprints(changed)
    near_edited, near_next = likeness(own[:-1], new), likeness(own[:-1], own[1:])
    return [(len(t), hashlib.sha256(c.encode()).hexdigest(), o.tobytes(), n.tobytes(), float(e), float(x))
            for t, c, o, n, e, x in zip(texts, changed, own, new, near_edited, near_next)]


def streamed_results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted part (id, a, b, text): the result of each row; rows of the last document are open (no edited text yet).
    The first and the last document's first rows carry the text."""
    held: list[list] = []  # documents: key, text, repeats
    known = None  # fingerprint of the first held document
    leading = True
    id_type = None

    def closed(last: bool) -> pa.RecordBatch:
        nonlocal held, known, leading
        texts = [t for _, t, _ in held]
        own = fingerprints(texts if known is None else texts[1:])
        own = own if known is None else np.concatenate([known, own])
        results = compared(texts, own)
        rows = []
        for d, (result, (key, text, times)) in enumerate(zip(results, held)):
            ends = leading and d == 0
            rows += [(*key, *result, ends, False, text if ends and not k else None) for k in range(times)]
        leading = leading and not results
        known, held = own[-1:], held[-1:]
        if last:
            key, text, times = held[0]
            rows += [(*key, len(text), None, known[0].tobytes(), None, None, None, leading, True, None if k else text) for k in range(times)]
        kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_(), pa.string()]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        names = ["id", "a", "b", *(f.name for f in RESULT), "leads", "open", "text"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    size = 0
    for batch in batches:
        id_type = batch.column(0).type
        ids, a, b, texts = (batch.column(c).to_pylist() for c in range(4))
        for key, text in zip(zip(ids, a, b), texts):
            if held and held[-1][0] == key:
                held[-1][2] += 1
                continue
            held.append([key, text, 1])
            size += len(text)
            if (size >= SPAN or len(held) > SPAN_TEXTS) and len(held) > 1:
                yield closed(False)
                size = 0
    if held:
        yield closed(True)


def joined_results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, a, b, text, after): the result of each row."""
    for batch in batches:
        keys = batch.select(["id", "a", "b"]).columns
        rows = [compared([t, n], fingerprints([t, n]))[0] for t, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([*keys, *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names=["id", "a", "b", *(f.name for f in RESULT)])


def joined(left: DataFrame, right: DataFrame, how: str, names: list[str]) -> DataFrame:
    """``left`` joined to ``right`` by id (null equals null), a and b, which ``left`` has under ``names``; without the key of ``right``."""
    own = {c: f"right_{c}" for c in ("id", "a", "b")}
    right = right.withColumnsRenamed(own)
    same = F.col(names[0]).eqNullSafe(F.col(own["id"])) & (F.col(names[1]) == F.col(own["a"])) & (F.col(names[2]) == F.col(own["b"]))
    return left.join(right, same, how).drop(*own.values())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_chars, edited_sha256, fingerprint, edited_fingerprint (lower-case hex), near_edited and near_next.

    The edited text ends in the beginning of the next document by id; the last one's next is the first.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(row_key(id_col, text).alias("k"), text.alias("text"), F.monotonically_increasing_id().alias("spread")).select("k.id", "k.a", "k.b", "text", "spread")
    keys = ["id", "a", "b"]
    parts = rows.repartitionByRange(*keys, "spread").drop("spread").sortWithinPartitions(*keys)
    key_fields = [parts.schema[c] for c in keys]
    ends = [T.StructField("leads", T.BooleanType()), T.StructField("open", T.BooleanType()), T.StructField("text", T.StringType())]
    done = written(parts.mapInArrow(streamed_results, T.StructType([*key_fields, *RESULT, *ends])), "parsed")

    # the documents that wait are at most one for each part; so are the first ones
    results = [f.name for f in RESULT]
    ready = done.where("leads AND NOT open").dropDuplicates(keys).select(*keys, *results)
    at_ends = done.where("text IS NOT NULL").groupBy(*keys).agg(F.first("text").alias("text"), F.max("open").alias("open"))
    circle = Window.orderBy(*keys)
    whole = circle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    key = F.struct(*keys)
    pairs = at_ends.select(*keys, "open", "text", F.coalesce(F.lead(key).over(circle), F.first(key).over(whole)).alias("next")).where("open")
    waiting = joined(pairs, ready.select(*keys), "left_anti", keys)
    waiting = waiting.select(*keys, "text", *(F.col(f"next.{c}").alias(f"next_{c}") for c in keys))
    waiting = joined(waiting, at_ends.select(*keys, F.col("text").alias("after")), "inner", [f"next_{c}" for c in keys]).select(*keys, "text", "after")
    late = waiting.mapInArrow(joined_results, T.StructType([*key_fields, *RESULT]))
    late = written(late.union(ready), "late")
    opened = joined(done.where("open").select(*keys), late, "inner", keys).select("id", *results)
    both = done.where("NOT open").select("id", *results).union(opened)
    return both.select(F.col("id").alias(id_col), *(F.lower(F.hex(c)).alias(c) if "fingerprint" in c else F.col(c) for c in results))
