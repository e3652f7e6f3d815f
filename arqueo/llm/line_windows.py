"""Line dedup over overlapping three-line windows, with DataFrame functions only.

Method: the lines of a document that hold a word are hashed (128 bits); each
three that follow one another make a window.  Windows are counted over the whole
corpus; of a window that occurs more than once the first occurrence, by document
and place, stays, and every later one marks its three lines.  The marks of a
document are merged and its marked lines removed.

Counting aggregates before its shuffle, so a window in a third of all documents
is a few rows per task; the join that finds later occurrences has a written
table on one side and can split a hot window's rows.  Only documents with marks
carry an array, as long as the document's own lines.

Defined cases: lines are compared without the blanks around them; lines of blanks
are in no window and stay; a document of fewer than three lines with words stays
whole; a null text stays null; rows equal in id and text are one document and
change alike; a null id sorts before all others; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, row_key, written


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def windows_of(text: Column, width: int) -> Column:
    """Array of (h1, h2, at): the two hashes of each window and the places of its lines."""

    def lines(raw: Column) -> Column:
        each = F.transform(raw, lambda x, i: F.struct(F.btrim(x, F.lit(BLANKS)).alias("x"), i.alias("i")))
        return F.transform(F.filter(each, lambda x: x["x"] != ""),
                           lambda x: F.struct(F.xxhash64(x["x"]).alias("a"), F.xxhash64(F.lit(1), x["x"]).alias("b"), x["i"].alias("i")))

    def windows(own: Column) -> Column:
        starts = F.slice(own, F.lit(1), F.greatest(F.size(own) - (width - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.struct(
            F.xxhash64(*(F.get(own, i + k)["a"] for k in range(width))).alias("h1"),
            F.xxhash64(*(F.get(own, i + k)["b"] for k in range(width))).alias("h2"),
            F.array(*(F.get(own, i + k)["i"] for k in range(width))).alias("at")))

    return let(F.split(text, "\n", -1), lambda raw: let(lines(raw), windows))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, a, b, gone): for documents with later occurrences, the places of the lines to remove.  Written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    w = (docs.select(row_key(id_col, text).alias("k"), F.explode(windows_of(text, width)).alias("w"))
         .select("k.id", "k.a", "k.b", "w.h1", "w.h2", "w.at"))
    place = F.struct("id", "a", "b", F.get("at", F.lit(0)).alias("p"))
    first = w.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = w.join(written(first, "windows"), ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    gone = later.groupBy("id", "a", "b").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("gone"))
    return written(gone, "lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``docs`` with later occurrences removed from the text, and n_lines, n_removed (long) behind its columns (instead
    of columns of these names)."""
    name = {c: fresh(docs.columns, f"llm_{c}") for c in ("id", "a", "b", "gone")}
    marks = repeated_lines(docs, id_col, text_col, width).select(*(F.col(c).alias(n) for c, n in name.items()))
    text, gone = F.col(text_col).cast("string"), F.col(name["gone"])
    key = row_key(id_col, text)
    lines = F.split(text, "\n", -1)
    count = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long")

    def kept(own: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.get(own, i)), "\n")

    same = F.col(id_col).eqNullSafe(F.col(name["id"])) & (key["a"] == F.col(name["a"])) & (key["b"] == F.col(name["b"]))
    # a merge join at every size: the marks grow with the documents
    out = docs.join(marks.hint("merge"), same, "left")
    return out.select(*[F.when(gone.isNull(), F.col(c)).otherwise(let(lines, kept)).alias(c) if c == text_col else F.col(c)
                        for c in docs.columns if c not in ("n_lines", "n_removed")],
                      count.alias("n_lines"), F.coalesce(F.size(gone).cast("long"), F.lit(0)).alias("n_removed"))
