"""The corpus pipeline: documents through filters and dedup to packed token sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of the
documents, but for the last one, which returns a row per packed piece.  A document whose words all went in line dedup
goes with them: all its lines are there in earlier documents.  Rows equal in id and text are one document, of which the
stage of near copies keeps one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arqueo.llm import chosen_path, line_windows, mcd_rules, packing, rff_quality
from arqueo.llm.common import BLANKS, one_per_key, table, without, written


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 0 go."""
    scored = rff_quality.score_documents(docs, table(spark, sf_dir, "labels"))
    return without(docs, scored.where("predicted = 0").select("id", "a", "b").distinct())


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or are robust outliers go."""
    return without(docs, mcd_rules.judge(docs).where("NOT kept").select("key.id", "key.a", "key.b").distinct())


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go, and documents that hold no word without them; n_chars follows the text."""
    out = line_windows.dedup_lines(docs).where((F.col("n_removed") == 0) | (F.btrim("text", F.lit(BLANKS)) != ""))
    return out.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays, once."""
    docs = one_per_key(docs)
    return without(docs, chosen_path.join_documents(docs).where("NOT kept").select("id", "a", "b").distinct())


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: one row per piece of the documents that are left."""
    return packing.pack_documents(docs)


STAGES = [("quality classifier", classifier_stage), ("quality rules", rules_stage), ("line dedup", lines_stage),
          ("n-gram Jaccard join", near_copies_stage), ("best-fit packing", pack_stage)]
#: Fitted models and token ids are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage{k}")
    return docs
