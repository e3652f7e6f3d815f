"""Null-handling helpers.

The reconciliation rules were written against a dataframe library whose
missing-value semantics differ from SQL NULL.  Each helper below states the
rule it reproduces so that an operator can opt into it explicitly:

* group keys that are missing are dropped before grouping;
* ``x != c`` and "not in list" keep rows where ``x`` is missing;
* ``x != y`` is true when either side (or both) is missing;
* after filling measures with 0, two missing values compare equal;
* the sum of an all-missing group is 0;
* a text test on a missing value is false (never drops the row silently).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_equal_keep_null(c: str | Column, value) -> Column:
    """``c != value`` that keeps NULL rows (dataframe-library semantics)."""
    return ~col(c).eqNullSafe(F.lit(value))


def not_in_keep_null(c: str | Column, values: Iterable) -> Column:
    """``~c.isin(values)`` that keeps NULL rows."""
    values = list(values)
    if not values:
        return F.lit(True)
    return F.coalesce(~col(c).isin(values), F.lit(True))


def differs(a: str | Column, b: str | Column) -> Column:
    """Mismatch flag where a NULL on either side counts as a difference."""
    return F.coalesce(col(a) != col(b), F.lit(True))


def differs_null_equal(a: str | Column, b: str | Column) -> Column:
    """Mismatch flag where two NULLs are equal (comparison after a 0 fill)."""
    return ~col(a).eqNullSafe(col(b))


def sum0(c: str | Column) -> Column:
    """Sum whose all-NULL (or empty) result is 0, not NULL."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def contains_any(c: str | Column, patterns: Sequence[str]) -> Column:
    """Regex test of any pattern; NULL text gives False instead of NULL."""
    if not patterns:
        return F.lit(False)
    return F.coalesce(col(c).rlike("|".join(patterns)), F.lit(False))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group keys that are NULL are dropped before grouping (parity rule)."""
    if not keys:
        return df
    cond = None
    for k in keys:
        term = F.col(k).isNotNull()
        cond = term if cond is None else cond & term
    return df.filter(cond)
