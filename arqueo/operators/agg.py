"""Aggregations (A-01..A-12).

Every aggregation has a partial (map-side) step, so a hot key is reduced inside
each map task before the shuffle.  Sums are hash aggregates; minima of structs
and texts plan as sort aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import drop_null_keys as _drop_null_keys, sum0
from ..functions.scalars import month_start, safe_percent
from .filters import classify_expr, numeric_cols, row_total_expr


def _measures(measures: Sequence[str] | Mapping[str, str | Column]) -> dict[str, str | Column]:
    if isinstance(measures, Mapping):
        return dict(measures)
    return {m: m for m in measures}


def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str | Column],
              drop_null_keys: bool = True) -> DataFrame:
    """A-01: sum named measures by keys; NULL keys dropped; all-NULL sums are 0.

    ``measures`` is a list of columns or ``{output: column}``.
    """
    keys = list(keys)
    src = _drop(df, keys) if drop_null_keys else df
    aggs = [sum0(c).alias(out) for out, c in _measures(measures).items()]
    if not keys:
        return src.agg(*aggs)
    return src.groupBy(*keys).agg(*aggs)


def _drop(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _drop_null_keys(df, keys)


def sum_numeric(df: DataFrame, keys: Sequence[str], bools: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """A-02: sum every numeric column (booleans only when asked), keys chosen by the caller."""
    keys = list(keys)
    cols = [c for c in numeric_cols(df, bools=bools, exclude=exclude) if c not in keys]
    meas = {c: (F.col(c).cast("long") if str(df.schema[c].dataType) == "BooleanType()" else c) for c in cols}
    return group_sum(df, keys, meas)


def group_min_max(df: DataFrame, keys: Sequence[str], mins: Mapping[str, str] | None = None,
                  maxs: Mapping[str, str] | None = None) -> DataFrame:
    """A-03: min / max per group (``{output: column}``)."""
    aggs = [F.min(c).alias(o) for o, c in (mins or {}).items()] + [F.max(c).alias(o) for o, c in (maxs or {}).items()]
    return _drop(df, keys).groupBy(*keys).agg(*aggs)


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, value: str, values: Sequence | None = None,
              fill: bool = True, total: str | None = None) -> DataFrame:
    """A-04 (+A-05): pivot-sum with 0 fill and an optional row total.

    ``values`` names the columns of the wide form, written as conditional sums,
    so it is one hash aggregate.  Without them the result is the long form
    (keys, pivot column, value): a header is never read from the data.
    """
    keys = list(keys)
    src = _drop(df, keys)
    if values is None:
        out = group_sum(src.filter(F.col(pivot_col).isNotNull()), [*keys, pivot_col], [value])
        return out.withColumn(total, F.sum(value).over(Window.partitionBy(*keys))) if total else out
    values = list(values)
    aggs = []
    for v in values:
        s = F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(value)))
        aggs.append((F.coalesce(s, F.lit(0)) if fill else s).alias(str(v)))
    out = src.groupBy(*keys).agg(*aggs)
    if total:
        out = out.withColumn(total, row_total_expr([str(v) for v in values]))
    return out


def row_total(df: DataFrame, cols: Sequence[str] | None = None, out: str = "total") -> DataFrame:
    """A-05: total across numeric columns of each row (NULL counts as 0)."""
    cols = numeric_cols(df) if cols is None else list(cols)
    return df.withColumn(out, row_total_expr(cols))


def totals(df: DataFrame, measures: Sequence[str] | Mapping[str, str | Column], count: str | None = None) -> DataFrame:
    """A-06: grand totals (and optional row count) as a one-row frame."""
    aggs = [sum0(c).alias(o) for o, c in _measures(measures).items()]
    if count:
        aggs.append(F.count(F.lit(1)).alias(count))
    return df.agg(*aggs)


def percent(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """A-12: ``num / den * 100`` (NULL when ``den`` is 0)."""
    return df.withColumn(out, safe_percent(num, den))


def conditional_rows(df: DataFrame, cond_col: str, rows: Mapping[str, Sequence], measures: Mapping[str, str],
                     label: str = "concepto", keys: Sequence[str] = ()) -> DataFrame:
    """A-07: sums into a fixed list of labelled rows; labels without data give 0.

    The label list is a parameter, so the spine is a literal array exploded
    per key group (no join with driver-made data).
    """
    keys = list(keys)
    labelled = df.withColumn(label, classify_expr(cond_col, rows)).filter(F.col(label).isNotNull())
    agg = group_sum(labelled, keys + [label], measures)
    labels = F.array(*[F.lit(x) for x in rows])
    if keys:
        spine = _drop(df, keys).select(*keys).distinct()
    else:
        spine = df.sparkSession.range(1).select()
    spine = spine.withColumn(label, F.explode(labels))
    out = spine.join(agg, on=keys + [label], how="left")
    return out.fillna(0, subset=list(measures))


def period_end(df: DataFrame, keys: Sequence[str], value: str, order: str, out: str | None = None) -> DataFrame:
    """A-08: last non-NULL ``value`` per group in ``order`` (max of a struct, partial-aggregated)."""
    s = F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return _drop(df, keys).groupBy(*keys).agg(s.getField("v").alias(out or value))


def group_having(df: DataFrame, keys: Sequence[str], measure: str, cond: Callable[[Column], Column],
                 out: str | None = None) -> DataFrame:
    """A-09: group sum, then a condition on the result (HAVING)."""
    out = out or measure
    return group_sum(df, keys, {out: measure}).filter(cond(F.col(out)))


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A-10: distinct rows of ``cols`` (all columns when omitted)."""
    return (df.select(*cols) if cols else df).distinct()


def latest_period(df: DataFrame, mes_col: str = "mes", keys: Sequence[str] = ()) -> DataFrame:
    """A-11: keep the rows of the latest 'MM/YYYY' month (overall or per key).

    The maximum is one global (or per-key) aggregate joined back on equality;
    the one-row case is broadcast because a keyless aggregate has one row.
    """
    keys = list(keys)
    d = df.withColumn("_m", month_start(mes_col))
    if not keys:
        mx = d.agg(F.max("_m").alias("_m"))
        return d.join(mx, on="_m", how="inner").drop("_m")
    mx = d.groupBy(*keys).agg(F.max("_m").alias("_m"))
    return d.join(mx, on=keys + ["_m"], how="inner").select(*df.columns)
