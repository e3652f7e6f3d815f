"""Sort, limit and top-k (T-01..T-04).

The side with the top N keys has at most N rows; joins leave the choice of a
broadcast to the byte threshold and run-time statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import drop_null_keys, sum0


def sort_out(df: DataFrame, cols: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """T-01: multi-key sort with mixed directions (only at the output edge)."""
    asc = [ascending] * len(cols) if isinstance(ascending, bool) else list(ascending)
    return df.orderBy(*[F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(cols, asc)])


def top_n(df: DataFrame, n: int, by: Sequence[str], ascending: bool | Sequence[bool] = False) -> DataFrame:
    """T-02: first ``n`` rows in order (TakeOrdered: per-partition top-n, then merge)."""
    return sort_out(df, by, ascending).limit(int(n))


def _check_n(n: int) -> int:
    if int(n) <= 0:
        raise ValueError("top-n size must be positive")
    return int(n)


def top_keys(df: DataFrame, n: int, key: str, by: str, absolute: bool = True) -> DataFrame:
    """The ``n`` keys with the largest (absolute) summed ``by`` (ties by key)."""
    n = _check_n(n)
    v = F.abs(F.col(by)) if absolute else F.col(by)
    g = drop_null_keys(df, [key]).groupBy(key).agg(F.sum(v).alias("_v"))
    return g.orderBy(F.col("_v").desc_nulls_last(), F.col(key)).limit(n).select(key)


def top_n_other(df: DataFrame, n: int, key: str, value: str, part: Sequence[str] = (),
                base: DataFrame | None = None, other_label: str = "OT", label_cols: dict | None = None,
                absolute: bool = True) -> DataFrame:
    """T-03: keep the top-``n`` keys (chosen on ``base``, default ``df``) and fold
    every other key into one ``other_label`` row per ``part``.

    ``label_cols`` sets extra columns of the folded row (e.g. a description).
    """
    part = list(part)
    keys = top_keys(base if base is not None else df, n, key, value, absolute).withColumn("_top", F.lit(True))
    d = df.join(keys, on=key, how="left")
    in_top = F.coalesce(F.col("_top"), F.lit(False))
    d = d.withColumn(key, F.when(in_top, F.col(key)).otherwise(F.lit(other_label)))
    extra = {}
    for c, lbl in (label_cols or {}).items():
        extra[c] = F.when(in_top, F.col(c)).otherwise(F.lit(lbl))
    d = d.withColumns(extra) if extra else d
    by = part + [key] + list((label_cols or {}).keys())
    return drop_null_keys(d, part).groupBy(*by).agg(sum0(value).alias(value))


def recent_years(df: DataFrame, n: int, year_col: str = "ejercicio") -> DataFrame:
    """T-04: rows of the ``n`` most recent years present in the data."""
    n = _check_n(n)
    ys = (df.select(F.col(year_col)).filter(F.col(year_col).isNotNull()).distinct()
          .orderBy(F.col(year_col).cast("int").desc()).limit(n))
    return df.join(ys, on=year_col, how="left_semi")
