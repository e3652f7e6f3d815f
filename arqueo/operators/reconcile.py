"""Reconciliation of two systems (J-06, J-07, J-10, J-11, J-13).

Both sides are aggregated to one row per key **before** they meet, so the
join is key-unique on both sides: no fan-out, no hot key, and the full outer
join moves only aggregated rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .agg import group_sum
from .filters import numeric_cols

HOW = {"union": "full", "left": "left", "inner": "inner", "right": "right"}


def _join_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    keys = list(keys)
    if not null_safe:
        return a.join(b, on=keys, how=HOW.get(how, how))
    bb = b.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(bb[f"_r_{k}"]) for k in keys])
    j = a.join(bb, cond, HOW.get(how, how))
    merged = [F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) if how == "union" else F.col(k) for k in keys]
    rest = [c for c in j.columns if c not in keys and not c.startswith("_r_")]
    return j.select(*merged, *rest)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], a_measures: Mapping[str, str | Column],
              b_measures: Mapping[str, str | Column], how: str = "union", diff: str | None = "diferencia",
              diff_expr: Column | None = None, fill: bool = True, null_safe: bool = False,
              aggregate: bool = True) -> DataFrame:
    """J-06 / J-10 / J-11 (and U-03, the key difference/union the original
    computed by hand): align two systems on their keys and difference them.

    ``a_measures`` / ``b_measures`` map output names to source columns; each side
    is summed by ``keys`` (NULL keys dropped).  ``how='union'`` keeps keys of
    either side, ``'left'`` only the left keys.  With ``fill`` the measures of a
    missing side are 0.  ``diff`` is (sum of left outputs) - (sum of right
    outputs) unless ``diff_expr`` is given; ``None`` means side by side only.
    """
    keys = list(keys)
    sa = group_sum(a, keys, a_measures) if aggregate else a
    sb = group_sum(b, keys, b_measures) if aggregate else b
    out = _join_keys(sa, sb, keys, how, null_safe)
    meas = list(a_measures) + list(b_measures)
    if fill:
        out = out.fillna(0, subset=meas)
    if diff:
        if diff_expr is None:
            left = reduce(lambda x, y: x + y, [F.col(c) for c in a_measures])
            right = reduce(lambda x, y: x + y, [F.col(c) for c in b_measures])
            diff_expr = left - right
        out = out.withColumn(diff, diff_expr)
    return out


def subtract(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "union", left_only: str = "zero",
             null_safe: bool = False) -> DataFrame:
    """J-13: aligned subtraction of every common numeric column (left order).

    ``a`` and ``b`` are already one row per key.  Missing rows count as 0.
    A numeric column present on one side only is shown as 0 (``'zero'``, the
    original's result), NULL (``'null'``) or its own signed value (``'keep'``).
    """
    keys = list(keys)
    na = [c for c in numeric_cols(a) if c not in keys]
    nb = [c for c in numeric_cols(b) if c not in keys]
    ra = a.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in na])
    rb = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in nb])
    j = _join_keys(ra, rb, keys, how, null_safe)
    cols = []
    for c in na + [c for c in nb if c not in na]:
        va = F.coalesce(F.col(f"_a_{c}"), F.lit(0)) if c in na else None
        vb = F.coalesce(F.col(f"_b_{c}"), F.lit(0)) if c in nb else None
        if va is not None and vb is not None:
            e = va - vb
        elif left_only == "zero":
            e = F.lit(0).cast(a.schema[c].dataType if c in na else b.schema[c].dataType)
        elif left_only == "null":
            e = F.lit(None).cast(a.schema[c].dataType if c in na else b.schema[c].dataType)
        else:
            e = va if va is not None else -vb
        cols.append(e.alias(c))
    return j.select(*keys, *cols)


def match_vouchers(a: DataFrame, b: DataFrame, on: Sequence[tuple[str, str]], how: str = "full",
                   null_safe: bool = False, coalesce: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """J-07: join two systems whose key columns have different names (both kept).

    ``coalesce`` builds one column from a pair (e.g. the year seen by either
    side).  Sides should already be one row per voucher (aggregate first).
    """
    cond = reduce(lambda x, y: x & y,
                  [(a[x].eqNullSafe(b[y]) if null_safe else a[x] == b[y]) for x, y in on])
    j = a.join(b, cond, how)
    for out, (x, y) in (coalesce or {}).items():
        j = j.withColumn(out, F.coalesce(F.col(x), F.col(y)))
    return j
