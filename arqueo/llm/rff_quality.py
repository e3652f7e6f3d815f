"""Quality classifier on document statistics: random Fourier features, ridge, isotonic calibration.

Method: each whole text gives a vector of statistics (``features``).  Random
Fourier features (fixed seed) approximate a Gaussian kernel over the standardised
vectors; ridge scores follow from normal equations whose partial sums every
partition makes and Spark adds up.  Labelled training rows whose second hash is
0 of ``CALIBRATE`` are left out of the fit and give the isotonic map (pool
adjacent violators over ``BINS`` fixed bins of the raw score) to probabilities;
between block centres the map is linear, so that ranks stay apart.

Scale: texts are read once into a narrow written table.  What the driver holds
does not depend on the data: moments, a matrix of ``FEATURES`` squared, ``BINS``
counts.  Partial sums meet in ``SLOTS`` groups.

Defined cases: a null text is the empty one and gets a score; several labels of
one document count by their mean; null labels are none; with no labels at all
every score is the prior 0.5; a null id is never labelled nor held out; rows
equal in id and text get the same score; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, written

FEATURES, WIDTH, RIDGE, SEED = 256, 6.0, 1.0, 20240607
BINS, SLOTS, CALIBRATE, THRESHOLD = 1_000, 8, 4, 0.3
NAMES = ["log_chars", "log_words", "word_length", "space", "newline", "upper", "digit", "full_stop", "comma", "shout", "bar", "symbol",
         "other_ascii", "non_ascii", "distinct_words", "repeated_next", "top_word", "line_length", "distinct_lines", "long_words"]
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def features(text: str) -> list[float]:
    """Statistics of one whole text, shares mostly as square roots."""
    raw = text.encode("utf-8", "replace")
    byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = max(len(raw), 1)
    words = text.split()
    k = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    count: dict[str, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    share = lambda codes: math.sqrt(byte[codes].sum() / n)
    code = lambda chars: [ord(c) for c in chars]
    ascii_letters = byte[65:91].sum() + byte[97:123].sum()
    named = byte[code(" \n.,!?|#*$%&<>")].sum() + byte[48:58].sum() + ascii_letters
    again = sum(map(str.__eq__, words, words[1:])) if len(words) > 1 else 0
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(sum(map(len, words)) / k), share(code(" ")), share(code("\n")),
        math.sqrt(byte[65:91].sum() / max(ascii_letters, 1)), share(slice(48, 58)), share(code(".")), share(code(",")), share(code("!?")), share(code("|")),
        share(code("#*$%&<>")), math.sqrt(max(byte[:128].sum() - named, 0) / n), math.sqrt(byte[128:].sum() / n),
        # the number of distinct words grows more slowly than the text
        math.log1p(len(count)) / math.log1p(k), math.sqrt(again / k), math.sqrt(max(count.values(), default=0) / k),
        math.log1p(len(text) / max(len(lines), 1)), len(set(lines)) / max(len(lines), 1), math.sqrt(sum(1 for w in count if len(w) > 20) / max(len(count), 1))]


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a, b, x): row key and statistics of each document.  Written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = row_key(id_col, text)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "a": pdf["a"], "b": pdf["b"], "x": [features(t) for t in pdf["t"]]})

    # nullable ids go through Arrow as text, so that null stays null
    out = docs.select(key["id"].cast("string").alias("id"), key["a"].alias("a"), key["b"].alias("b"), text.alias("t")).mapInPandas(
        run, "id string, a bigint, b bigint, x array<double>")
    return written(out.withColumn("id", F.col("id").cast(kind)), "features")


class Basis:
    """Standardisation and the random cosines."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.normal(size=(len(mean), FEATURES - 1)) / WIDTH
        self.b = rng.uniform(0, 2 * math.pi, FEATURES - 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -8, 8)
        return np.hstack([np.ones((len(z), 1)), math.sqrt(2 / (FEATURES - 1)) * np.cos(z @ self.w + self.b)])


def remainder(id_col: Column, modulus: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


def isotonic(score: np.ndarray, weight: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (centres, values) of the blocks, in order of the score."""
    blocks: list[list[float]] = []  # weight, positives, weighted sum of scores
    for s, n, p in zip(score, weight, positive):
        blocks.append([n, p, s * n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, p, s = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + p, blocks[-1][2] + s]
    b = np.array(blocks)
    # a block's rate with half a row of either kind added: never quite 0 or 1
    return b[:, 2] / b[:, 0], np.maximum.accumulate((b[:, 1] + 0.5) / (b[:, 0] + 1))


class Model:
    def __init__(self, basis: Basis | None = None, weights=None, centres=None, values=None):
        self.basis, self.weights, self.centres, self.values = basis, weights, centres, values

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.basis(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.basis is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        p = np.interp(raw, self.centres, self.values)
        # beyond the outermost blocks: still in order, by a hair
        return np.clip(p + 1e-6 * np.tanh(raw), 0.0, 1.0)


def fit(rows: DataFrame) -> Model:
    """Model from ``rows`` (x, y, calibrate): moments, normal equations and calibration, one aggregation each."""
    spark, p = rows.sparkSession, len(NAMES)
    train = rows.where("NOT calibrate")
    sums = train.agg(F.count("*"), *(F.sum(F.col("x")[i]) for i in range(p)), *(F.sum(F.col("x")[i] * F.col("x")[i]) for i in range(p))).first()
    if not sums[0]:
        return Model()
    mean = np.array(sums[1:p + 1]) / sums[0]
    shared = spark.sparkContext.broadcast(Basis(mean, np.sqrt(np.maximum(np.array(sums[p + 1:]) / sums[0] - mean**2, 0))))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES, FEATURES + 1))
        for pdf in batches:
            if len(pdf):
                z = shared.value(np.stack(pdf["x"].to_numpy()))
                total += z.T @ np.hstack([z, pdf["y"].to_numpy(dtype=float)[:, None]])
        if total.any():
            from pyspark import TaskContext

            k = TaskContext.get().partitionId()
            yield pd.DataFrame({"slot": [k % SLOTS], "part": [k], "sums": [total.tobytes()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        # in order of partitions, not of arrival: the low bits of a sum are the same in every run
        total = sum(np.frombuffer(x) for x in pdf.sort_values("part")["sums"])
        return pd.DataFrame({"slot": pdf["slot"].iloc[:1], "sums": [total.tobytes()]})

    got = train.select("x", "y").mapInPandas(partial, "slot int, part int, sums binary").groupBy("slot").applyInPandas(added, "slot int, sums binary").collect()
    total = sum(np.frombuffer(r["sums"]) for r in sorted(got, key=lambda r: r["slot"])).reshape(FEATURES, FEATURES + 1)
    weights = np.linalg.solve(total[:, :-1] + RIDGE * np.eye(FEATURES), total[:, -1])
    model = Model(shared.value, weights)
    raw = apply(rows.where("calibrate"), Model(shared.value, weights, np.array([-1.0, 2.0]), np.array([-1.0, 2.0])), raw=True)
    bins = (raw.withColumn("bin", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + 0.5) * (BINS / 2)))))
            .groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("p")).orderBy("bin").collect())
    if not bins:  # too few labels to calibrate: the clipped ridge score
        model.centres, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        model.centres, model.values = isotonic(np.array([(r["bin"] + 0.5) * 2 / BINS - 0.5 for r in bins]),
                                               np.array([float(r["n"]) for r in bins]), np.array([float(r["p"]) for r in bins]))
    return model


def apply(rows: DataFrame, model: Model, raw: bool = False) -> DataFrame:
    """``rows`` with a score instead of x."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [c for c in rows.columns if c != "x"]
    cast = [F.col(c).cast("string").alias(c) if c == "id" else F.col(c) for c in rows.columns]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.empty((0, len(NAMES)))
            yield pdf[names].assign(score=m.raw(x) if raw else m.score(x))

    schema = ", ".join(f"`{c}` {'string' if c == 'id' else kinds[c]}" for c in names)
    out = rows.select(*cast).mapInPandas(run, f"{schema}, score double")
    return out.withColumn("id", F.col("id").cast(kinds["id"])) if "id" in names else out


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                    held_out_modulus: int = 5) -> DataFrame:
    """(id, a, b, held_out, score, predicted) per document; labels of held-out ids (crc32 mod 0) are never read."""
    x = document_features(docs, id_col, text_col)
    known = (labels.where(F.col(label_col).isNotNull() & (remainder(F.col("doc_id"), held_out_modulus) != 0))
             .groupBy(F.col("doc_id").alias("label_id")).agg(F.avg(F.col(label_col).cast("double")).alias("y")))
    rows = written(x.join(known, x["id"] == known["label_id"]).select(
        "x", "y", (F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(CALIBRATE)) == 0).alias("calibrate")), "labelled")
    out = apply(x, fit(rows))
    return out.select("id", "a", "b", F.coalesce(remainder(F.col("id"), held_out_modulus) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
