"""Joins (J-01..J-16).

No join carries a broadcast hint: Spark broadcasts a side by its size in bytes,
known from files or measured at run time, and shuffles otherwise.  That lookup
keys are unique is asserted inside the plan, without a job of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .agg import group_sum

def _eq(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def unique_map(map_df: DataFrame, map_key: str, map_val: str, key: str = "_lk_key", val: str = "_lk_val") -> DataFrame:
    """(key, val) with one row per non-NULL key; a key that repeats fails the job that reads it."""
    m = (map_df.filter(F.col(map_key).isNotNull()).groupBy(F.col(map_key).alias(key))
         .agg(F.min(map_val).alias(val), F.count(F.lit(1)).alias("_n")))
    message = F.concat(F.lit(f"lookup key {map_key} is not unique: "), F.col(key).cast("string"), F.lit(" repeats "),
                       F.col("_n").cast("string"), F.lit(" times; a join against it would multiply rows"))
    return m.select(key, F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(val)).alias(val))


def lookup(df: DataFrame, map_df: DataFrame, left_col: str, map_key: str, map_val: str, out: str | None = None,
           replace: bool = True, check_unique: bool = True) -> DataFrame:
    """J-01: map a code through a lookup; unmatched codes become NULL.

    Map rows with a NULL key are ignored (a NULL code is never looked up) and
    map keys must be unique, so the join can never multiply rows.
    """
    if check_unique:
        m = unique_map(map_df, map_key, map_val)
    else:
        m = (map_df.select(F.col(map_key).alias("_lk_key"), F.col(map_val).alias("_lk_val"))
             .filter(F.col("_lk_key").isNotNull()))
    j = df.join(m, df[left_col] == m["_lk_key"], "left")
    target = left_col if replace else (out or map_val)
    if replace:
        return j.select(*[F.col("_lk_val").alias(c) if c == left_col else F.col(c) for c in df.columns])
    return j.select(*df.columns, F.col("_lk_val").alias(target))


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str] | None = None,
           how: str = "left") -> DataFrame:
    """J-02: left enrichment by key."""
    on = [on] if isinstance(on, str) else list(on)
    if cols is not None:
        dim = dim.select(*on, *[c for c in cols if c not in on])
    return df.join(dim, on=on, how=how)


def hierarchy(levels: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """J-03: chain level n -> n-1 -> ... by successive left joins.

    ``levels[0]`` is the leaf frame; each further item is ``(parent, keys)``.
    """
    out = levels[0][0]
    for parent, keys in levels[1:]:
        out = enrich(out, parent, keys)
    return out


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    bs = set(b.columns)
    return [c for c in a.columns if c in bs]


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """J-04: join on every shared column (resolved from the schemas)."""
    on = shared_columns(a, b)
    if not on:
        raise ValueError("natural join without shared columns would be a cross join")
    return a.join(b, on=on, how=how)


def inner(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """J-05: inner join by key."""
    return a.join(b, on=[on] if isinstance(on, str) else list(on), how="inner")


def _key_cond(df: DataFrame, keys_df: DataFrame, on: Sequence[str], null_safe: bool) -> Column:
    return reduce(lambda x, y: x & y, [_eq(df[c], keys_df[c], null_safe) for c in on])


def semi(df: DataFrame, keys_df: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """J-08: rows whose key occurs in ``keys_df`` (never a collected list)."""
    on = [on] if isinstance(on, str) else list(on)
    k = keys_df.select(*on)
    return df.join(k, _key_cond(df, k, on, null_safe), "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """J-08: rows whose key does not occur in ``keys_df``."""
    on = [on] if isinstance(on, str) else list(on)
    k = keys_df.select(*on)
    return df.join(k, _key_cond(df, k, on, null_safe), "left_anti")


def having_semi(df: DataFrame, keys: Sequence[str], measure: str, cond) -> DataFrame:
    """J-09: keep rows of groups whose summed ``measure`` satisfies ``cond(Column)``."""
    g = group_sum(df, keys, {"_having": measure}, drop_null_keys=True)
    return semi(df, g.filter(cond(F.col("_having"))), keys)


def as_of_years(df: DataFrame, years: Sequence[str] | Column, year_col: str = "ejercicio", out: str = "hasta",
                strict: bool = False) -> DataFrame:
    """J-12 (and U-04, the union of per-year results): repeat each row for every
    requested year Y with ``year <= Y``.

    The years are a list, or an array column such as :func:`years_present`, so
    the expansion is a narrow ``explode``: no join and no shuffle.  Aggregate
    the input to (group, year) first so the expansion multiplies few rows.
    """
    arr = years if isinstance(years, Column) else F.array(*[F.lit(y) for y in sorted({int(y) for y in years})])
    y = F.col(year_col).cast("int")
    df = df.withColumn("_ys", arr)
    keep = F.filter(F.col("_ys"), (lambda v: v > y) if strict else (lambda v: v >= y))
    return df.withColumn(out, F.explode(keep)).withColumn(out, F.col(out).cast("string")).drop("_ys")


def years_present(df: DataFrame, last_n: int | None = None, year_col: str = "ejercicio") -> Column:
    """The distinct years of ``df`` (the ``last_n`` most recent), newest first, as a scalar subquery: no job of its own."""
    ys = F.sort_array(F.collect_set(F.col(year_col).cast("int")), asc=False)
    return df.agg((F.slice(ys, 1, int(last_n)) if last_n else ys).alias("_ys")).scalar()


def concat_columns(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """J-14: side-by-side series by key (chained full outer joins, NULL gaps kept)."""
    items = list(frames.items())
    out = items[0][1]
    for _, f in items[1:]:
        out = out.join(f, on=list(keys), how="full")
    return out


def star(spine: DataFrame, frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """J-15: left-join several per-key totals onto a spine (gaps stay NULL)."""
    out = spine
    for _, f in frames.items():
        out = out.join(f, on=list(keys), how="left")
    return out


def full_detail(a: DataFrame, b: DataFrame, keys: Sequence[str], a_measure: str, b_measure: str,
                a_prefix: str = "a_", b_prefix: str = "b_", diff: str = "diferencia") -> DataFrame:
    """J-16 (re-aimed): both systems' line detail in one table, no line pairs.

    The original put every line of one side next to every line of the other
    side with the same key (all pairs per group).  Here each line is kept once,
    tagged with its side, and carries its group's totals from both sides and
    their difference.  Totals are aggregated before the join (partial
    aggregation) and joined many-to-one, so the output is linear in the input.
    """
    keys = list(keys)
    ta = group_sum(a, keys, {f"{a_prefix}total": a_measure})
    tb = group_sum(b, keys, {f"{b_prefix}total": b_measure})
    tot = ta.join(tb, on=keys, how="full").fillna(0, subset=[f"{a_prefix}total", f"{b_prefix}total"])
    tot = tot.withColumn(diff, F.col(f"{a_prefix}total") - F.col(f"{b_prefix}total"))
    da = a.select(*keys, *[F.col(c).alias(a_prefix + c) for c in a.columns if c not in keys]) \
        .withColumn("lado", F.lit(a_prefix.rstrip("_")))
    db = b.select(*keys, *[F.col(c).alias(b_prefix + c) for c in b.columns if c not in keys]) \
        .withColumn("lado", F.lit(b_prefix.rstrip("_")))
    detail = da.unionByName(db, allowMissingColumns=True)
    return detail.join(tot, on=keys, how="left")
