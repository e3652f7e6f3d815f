"""Projections, filters and predicates (P-01..P-18).

All are narrow transformations: no shuffle.  A filter on a source column is
pushed into the Parquet scan by Catalyst; one on a year that is derived from a
date is not, unless ``date_col`` names that date: then its range goes along.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import col, contains_any, differs, differs_null_equal, not_in_keep_null


def _as_list(v) -> list:
    if v is None:
        return []
    if isinstance(v, (str, int, float)):
        return [v]
    return list(v)


def _in_years(date_col: str, first: int | None, last: int | None) -> Column:
    """Date range of the calendar years ``first`` to ``last``."""
    cond = F.lit(True)
    if first is not None:
        cond = cond & (F.col(date_col) >= F.lit(dt.date(first, 1, 1)))
    if last is not None:
        cond = cond & (F.col(date_col) < F.lit(dt.date(last + 1, 1, 1)))
    return cond


def years(df: DataFrame, y: str | Sequence[str] | None, c: str = "ejercicio", date_col: str | None = None) -> DataFrame:
    """P-01: fiscal-year filter, one year or a list (``isin``).

    ``date_col``: the date that ``c`` is the calendar year of; the range of the
    years is then tested on it as well and reaches the scan.
    """
    if y is None:
        return df
    ys = [str(v) for v in _as_list(y)]
    if date_col and ys:
        df = df.filter(_in_years(date_col, min(map(int, ys)), max(map(int, ys))))
    return df.filter(F.col(c).isin(ys))


def up_to(df: DataFrame, y: str | int, c: str = "ejercicio", op: str = "<=", date_col: str | None = None) -> DataFrame:
    """P-02: compare the year as an integer (``<=``, ``<``, ``>``, ``>=``); ``date_col`` as in :func:`years`."""
    lhs, rhs, n = F.col(c).cast("int"), F.lit(int(y)), int(y)
    cond = {"<=": lhs <= rhs, "<": lhs < rhs, ">": lhs > rhs, ">=": lhs >= rhs}[op]
    if date_col:
        df = df.filter(_in_years(date_col, *{"<=": (None, n), "<": (None, n - 1), ">": (n + 1, None), ">=": (n, None)}[op]))
    return df.filter(cond)


def codes(df: DataFrame, c: str, include: Iterable | None = None, exclude: Iterable | None = None) -> DataFrame:
    """P-03: keep codes in ``include``; drop codes in ``exclude`` but keep NULL codes."""
    if include is not None:
        df = df.filter(F.col(c).isin(list(include)))
    if exclude is not None:
        df = df.filter(not_in_keep_null(c, exclude))
    return df


def matches(df: DataFrame, c: str, words: Sequence[str], keep: bool = True) -> DataFrame:
    """P-04: keep (or drop) rows whose text matches any of ``words`` (regex OR).

    NULL text never matches, so it is dropped by ``keep=True`` and kept by
    ``keep=False``.
    """
    hit = contains_any(c, words)
    return df.filter(hit if keep else ~hit)


def prefix_filter(df: DataFrame, c: str, prefix: str | None = None, suffix: str | None = None,
                  keep: bool = True) -> DataFrame:
    """P-05: ``startswith`` / ``endswith`` (NULL text never matches)."""
    cond = F.lit(True)
    if prefix is not None:
        cond = cond & F.col(c).startswith(prefix)
    if suffix is not None:
        cond = cond & F.col(c).endswith(suffix)
    cond = F.coalesce(cond, F.lit(False))
    return df.filter(cond if keep else ~cond)


def classify_expr(c: str | Column, classes: Mapping[str, Iterable], default: str | None = None) -> Column:
    """Label of the first class whose code list contains the value."""
    expr = None
    for label, members in classes.items():
        cond = col(c).isin(list(members))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def classify(df: DataFrame, c: str, classes: Mapping[str, Iterable], default: str | None = None,
             out: str = "clase") -> DataFrame:
    """P-06: classify by code lists, first match wins (JVM ``CASE WHEN ... IN``)."""
    return df.withColumn(out, classify_expr(c, classes, default))


def overwrite(df: DataFrame, cond: Column, c: str, value) -> DataFrame:
    """P-07: set ``c`` to ``value`` where ``cond`` holds (NULL cond leaves it)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(c, F.when(F.coalesce(cond, F.lit(False)), v).otherwise(F.col(c)))


def negate(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """P-08: sign flip of money columns."""
    return df.withColumns({c: -F.col(c) for c in _as_list(cols)})


def prefix_columns(df: DataFrame, p: str, keep: Sequence[str] = ()) -> DataFrame:
    """P-09: prefix every column name but the keys."""
    return df.withColumnsRenamed({c: f"{p}{c}" for c in df.columns if c not in set(keep)})


def front(df: DataFrame, cols: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """P-10: move ``cols`` to the front, drop ``drop``, keep the rest in order."""
    rest = [c for c in df.columns if c not in set(cols) and c not in set(drop)]
    return df.select(*[c for c in cols if c in df.columns], *rest)


def numeric_cols(df: DataFrame, bools: bool = False, exclude: Sequence[str] = ()) -> list[str]:
    """P-18: numeric columns chosen from the schema (never from the data)."""
    out = []
    for f in df.schema.fields:
        if f.name in set(exclude):
            continue
        if isinstance(f.dataType, T.NumericType) or (bools and isinstance(f.dataType, T.BooleanType)):
            out.append(f.name)
    return out


def fill0(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P-11: missing numbers become 0 (text columns are left NULL)."""
    cols = numeric_cols(df) if cols is None else list(cols)
    if not cols:
        return df
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def dropna(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """P-12: drop rows with any (or all) NULL values in ``subset``."""
    return df.dropna(how=how, subset=list(subset) if subset is not None else None)


def row_total_expr(cols: Sequence[str]) -> Column:
    total = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0))
        total = term if total is None else total + term
    return total if total is not None else F.lit(0)


def only_diff(df: DataFrame, cols: Sequence[str] | None = None, tol: float = 0.0, mode: str = "row_total") -> DataFrame:
    """P-13: keep rows with a difference.

    ``mode='row_total'`` (parity) keeps rows whose signed total of the numeric
    columns is not 0 (beyond ``tol``); cancelling values (+5, -5) are hidden.
    ``mode='any'`` keeps rows where any listed column is beyond ``tol``.
    """
    cols = numeric_cols(df) if cols is None else list(cols)
    if mode == "any":
        cond = F.lit(False)
        for c in cols:
            cond = cond | (F.abs(F.coalesce(F.col(c), F.lit(0))) > F.lit(tol))
        return df.filter(cond)
    total = row_total_expr(cols)
    if tol:
        return df.filter(F.abs(total) > F.lit(tol))
    return df.filter(total != 0)


def beyond(df: DataFrame, c: str, tol: float, strict: bool = True, keep: bool = True) -> DataFrame:
    """P-14: ``|c| > tol`` (or ``>=`` when not strict)."""
    a = F.abs(F.col(c))
    cond = a > F.lit(tol) if strict else a >= F.lit(tol)
    return df.filter(cond if keep else ~cond)


def mismatch_flags(pairs: Mapping[str, tuple], null_policy: str = "differ") -> dict[str, Column]:
    """Build flag columns from ``{flag: (a, b)}`` or ``{flag: (a, b, tol)}``.

    ``null_policy='differ'``: a NULL on either side is a mismatch.
    ``null_policy='equal'``: two NULLs are equal (comparison after a 0 fill).
    With a tolerance the flag is ``|a - b| > tol`` and NULL counts as a mismatch.
    """
    out = {}
    for name, spec in pairs.items():
        a, b = col(spec[0]), col(spec[1])
        tol = spec[2] if len(spec) > 2 else None
        if tol is not None:
            out[name] = F.coalesce(F.abs(a - b) > F.lit(tol), F.lit(True))
        elif null_policy == "equal":
            out[name] = differs_null_equal(a, b)
        else:
            out[name] = differs(a, b)
    return out


def flag_mismatch(df: DataFrame, pairs: Mapping[str, tuple], null_policy: str = "differ",
                  only_flagged: bool = True, any_col: str | None = None) -> DataFrame:
    """P-15: add mismatch flags, then keep rows with any flag set."""
    flags = mismatch_flags(pairs, null_policy)
    df = df.withColumns(flags)
    anyf = F.lit(False)
    for name in flags:
        anyf = anyf | F.col(name)
    if any_col:
        df = df.withColumn(any_col, anyf)
    return df.filter(anyf) if only_flagged else df


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P-16: constant columns (synthetic vouchers)."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()})


def date_bound(df: DataFrame, c: str, d: dt.date | str, inclusive: bool = True) -> DataFrame:
    """P-17: upper date bound (pushed down to the scan)."""
    bound = F.lit(d).cast("date")
    return df.filter(F.col(c) <= bound if inclusive else F.col(c) < bound)
