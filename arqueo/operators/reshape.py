"""Set and reshape operators (U-01..U-05)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import dedupe


def union_all(*dfs: DataFrame) -> DataFrame:
    """U-01: union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedupe_subset(df: DataFrame, cond: Column, subset: Sequence[str], order: Sequence[str] = (),
                  keep: str = "first") -> DataFrame:
    """U-02: dedupe only the rows where ``cond`` holds; the rest pass unchanged."""
    hit = F.coalesce(cond, F.lit(False))
    return dedupe(df.filter(hit), subset, order, keep).unionByName(df.filter(~hit))


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], key: str = "concepto",
            value: str = "importe", cast: str | None = None) -> DataFrame:
    """U-05: wide to long (``cols`` must share a type, or give ``cast``)."""
    d = df.withColumns({c: F.col(c).cast(cast) for c in cols}) if cast else df
    return d.unpivot(list(ids), list(cols), key, value)
