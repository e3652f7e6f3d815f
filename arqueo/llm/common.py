"""Helpers that the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: White space of the word rules: space and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs start from the files, whatever executor is lost."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str | Column, text_col: str | Column) -> Column:
    """Identity of a document row: its id and two hashes of its text (rows equal in both are one document)."""
    text = F.coalesce(F.col(text_col) if isinstance(text_col, str) else text_col, F.lit(""))
    return F.struct(F.col(id_col).alias("id") if isinstance(id_col, str) else id_col.alias("id"),
                    F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def fresh(taken: list[str], name: str) -> str:
    """``name``, lengthened until it is no column of the caller's table."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def without(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` but for the rows whose :func:`row_key` is among ``keys`` (id, a, b).

    Always a merge join: the keys grow with the documents, so that a broadcast would only hold while both are small.
    """
    names = {c: fresh(docs.columns, f"llm_{c}") for c in ("id", "a", "b")}
    gone = keys.select(*(F.col(c).alias(n) for c, n in names.items()))
    own = row_key(id_col, F.col(text_col).cast("string"))
    same = F.col(id_col).eqNullSafe(F.col(names["id"])) & (own["a"] == F.col(names["a"])) & (own["b"] == F.col(names["b"]))
    return docs.join(gone.hint("merge"), same, "left_anti")


def one_per_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each :func:`row_key`; of rows that differ in other columns any one stays.

    Only the keys are counted over all rows.  Rows of repeated keys are cut to one in each task before they are shuffled, so
    that a row which fills a third of the table is a few rows by then; the others stay where they are.  The repeated keys
    are a written table, which Spark joins by broadcast only while it is below its threshold.
    """
    names = {c: fresh(docs.columns, f"llm_{c}") for c in ("id", "a", "b")}
    own = row_key(id_col, F.col(text_col).cast("string"))
    counts = docs.select(own.alias("k")).groupBy("k.id", "k.a", "k.b").agg(F.count("*").alias("n")).where("n > 1")
    keys = written(counts.select(*(F.col(c).alias(n) for c, n in names.items())), "repeated")
    if keys.isEmpty():
        return docs
    same = F.col(id_col).eqNullSafe(F.col(names["id"])) & (own["a"] == F.col(names["a"])) & (own["b"] == F.col(names["b"]))
    row = fresh(docs.columns, "llm_row")
    key = [own[c].alias(n) for c, n in names.items()]
    first = docs.join(keys, same, "left_semi").groupBy(*key).agg(F.first(F.struct(*docs.columns)).alias(row)).select(f"{row}.*")
    return docs.join(keys, same, "left_anti").unionByName(first)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components: (node, component), component being the smallest node; only nodes of ``edges``.

    Alternating large-star and small-star steps; each round is one aggregation and one join,
    written to the shared folder.  Nothing is gathered on the driver but a count.
    """
    e = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    while not stars(e):
        # large star: the larger neighbours of a node move to its smallest neighbour (or the node itself)
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large, "large")
        # small star: a node and its smaller neighbours move to the smallest of them
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        e = written(small, "edges")
    # every edge now goes from a node to the root of its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) joins a node of one edge to a root: then v is the component's smallest node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up > 1 OR (up = 1 AND root = 1)").isEmpty()


def streamed(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition that is sorted by ``keys``, one at a time, whatever the batch borders."""
    held: list[pd.DataFrame] = []
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(pdf)]):
            if last is not None and tuple(k[a]) != last:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(pdf.iloc[a:b])
            last = tuple(k[a])
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt out by ``keys`` and sorted, for :func:`streamed`."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place in the component of each of ``n`` places, from links a - b (few rounds of label passing)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
