"""Window and order-dependent operators (W-01..W-07).

No operator here sorts a whole raw group inside one task:

* running balances are computed on (account, date) sums, so a window holds
  at most one row per calendar day of an account;
* dedupe and "latest" use aggregates (partial, map-side) instead of
  ``row_number`` over a possibly hot key;
* forward fill is a blocked prefix scan: a window per (group, block of rows),
  then a window over the per-block summaries, then a join back;
* shares divide by a group total computed by aggregation and joined back;
* ranks range-partition the rows, and running totals the sums per (group,
  order key), once, write them with their partition number and work from the
  written table: a range exchange samples its boundaries anew each time it
  runs, so rows and per-partition totals must come from one run of it.  The
  number of ranges follows the size of the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import drop_null_keys, sum0
from ..session import materialize

FILL_BLOCK_ROWS = 1 << 16
#: Scanned bytes per range partition; sizes from here on only say that Spark does not know the size.
RANGE_BYTES, UNKNOWN_BYTES = 64 << 20, 1 << 60


def _null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; key columns come from ``a``."""
    bb = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [a[k].eqNullSafe(bb[f"_r_{k}"]) for k in keys])
    return a.join(bb, cond, "left").drop(*[f"_r_{k}" for k in keys])


def running_balance(df: DataFrame, keys: Sequence[str], part: str = "cta_cte", order: str = "fecha",
                    value: str = "importe", out: str = "saldo") -> DataFrame:
    """W-01 + A-08: running balance of ``value`` per ``part`` in ``order``, read at
    the last ``order`` of each ``keys`` group (e.g. year, month, account).

    The balance at a group's last date is the account's sum of all movements up
    to and including that date (movements on the same date are taken together).
    Steps: sum by (part, date); cumulative sum over the dates of each account;
    last date of each group; join.  Every window partition holds dates, not
    movements, so one busy account does not pile up in one task.
    """
    keys = list(keys)
    if part not in keys:
        raise ValueError("the running-balance part column must be one of the keys")
    src = df.filter(F.col(part).isNotNull() & F.col(order).isNotNull())
    daily = src.groupBy(part, order).agg(sum0(value).alias("_v"))
    w = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = daily.select(part, order, F.sum("_v").over(w).alias(out))
    last = drop_null_keys(src, keys).groupBy(*keys).agg(F.max(order).alias(order))
    return last.join(cum, on=[part, order], how="inner").select(*keys, out)


def cumulative(df: DataFrame, order: Sequence[str], value: str, part: Sequence[str] = (), out: str = "acum",
               order_expr=None, presummed: bool = False, partitions: int | None = None) -> DataFrame:
    """W-02: running total in ``order`` within ``part``; rows with equal order
    keys share one running value (their sum is taken together).

    Default: the rows are summed by (part, order) first (before any shuffle), so
    that a busy day is one row; these sums are range-partitioned on (part, order)
    and written (a job of its own), run inside each range partition (equal keys
    never straddle two partitions), are moved up by each part's total of the
    earlier partitions and joined back to the rows.
    ``presummed=True`` is for small results with one row per (part, order),
    such as a monthly reconciliation: one window, no extra job.
    ``order_expr`` orders the keys when their text order is not the right one.
    """
    order, part = list(order), list(part)
    ok = order_expr if order_expr is not None else [F.col(c) for c in order]
    ok = ok if isinstance(ok, list) else [ok]
    v = F.coalesce(F.col(value), F.lit(0))
    if presummed:
        w = Window.partitionBy(*part).orderBy(*ok)  # default frame: RANGE unbounded preceding .. current row
        return df.withColumn(out, F.sum(v).over(w))
    n = partitions or range_count(df)
    keys = [*part, *(c for c in order if c not in part)]
    r = df.groupBy(*keys).agg(F.sum(v).alias("_v"))
    r = materialize(r.repartitionByRange(n, *[F.col(c) for c in part], *ok).withColumn("_pid", F.spark_partition_id()), "ranges")
    r = r.withColumn("_lc", F.sum("_v").over(Window.partitionBy("_pid", *part).orderBy(*ok)))
    tot = r.groupBy("_pid", *part).agg(F.sum("_v").alias("_t"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *part, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    run = _null_safe_join(r, off, ["_pid", *part]).select(*keys, (F.col("_lc") + F.col("_off")).alias(out))
    return _null_safe_join(df.drop(out), run, keys).select(*(c for c in df.columns if c != out), out)


def range_count(df: DataFrame) -> int:
    """Range partitions for ``df``: one for each ``RANGE_BYTES`` of what its plan scans, at least the session's shuffle
    partitions (which also stand where the size is not known)."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(least, -(-sum(x for x in sizes if x < UNKNOWN_BYTES) // RANGE_BYTES))


def share(df: DataFrame, value: str, part: Sequence[str] = (), out: str = "participacion",
          absolute: bool = False) -> DataFrame:
    """W-03: ``value / group total * 100`` (total by aggregation, joined back)."""
    part = list(part)
    v = F.abs(F.col(value)) if absolute else F.col(value)
    d = df.withColumn(value, v) if absolute else df
    if part:
        tot = d.groupBy(*part).agg(F.sum(value).alias("_tot"))
        j = _null_safe_join(d, tot, part)
    else:
        # keyless total: a scalar subquery (one aggregate, no join)
        j = d.withColumn("_tot", d.agg(F.sum(value)).scalar())
    return j.withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("_tot").cast("double"))
                        * F.lit(100.0)).drop("_tot")


def forward_fill(df: DataFrame, cols: Sequence[str], order: str, part: Sequence[str] = (),
                 block_rows: int = FILL_BLOCK_ROWS) -> DataFrame:
    """W-04: fill NULLs with the last non-NULL value above, per ``part`` in ``order``.

    ``order`` is a numeric row number, unique within a part.  Blocked scan:
    (1) fill inside each (part, block of ``block_rows`` row numbers);
    (2) last non-NULL value of each block (aggregate);
    (3) carry it over the following blocks (window over block summaries);
    (4) join the carry back and use it where the block had no value yet.
    """
    part, cols = list(part), list(cols)
    d = df.withColumn("_blk", F.floor(F.col(order) / F.lit(block_rows)).cast("long"))
    wl = Window.partitionBy(*part, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({f"_loc_{c}": F.last(c, ignorenulls=True).over(wl) for c in cols})
    last = d.groupBy(*part, "_blk").agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))
        .getField("v").alias(f"_end_{c}") for c in cols])
    wb = Window.partitionBy(*part).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*part, "_blk", *[F.last(f"_end_{c}", ignorenulls=True).over(wb).alias(f"_car_{c}")
                                         for c in cols])
    j = _null_safe_join(d, carry, part + ["_blk"])
    filled = {c: F.coalesce(F.col(f"_loc_{c}"), F.col(f"_car_{c}")) for c in cols}
    return j.withColumns(filled).select(*df.columns)


def _order_fields(order: Sequence[str], tie_break: Sequence[str]) -> tuple[list, dict]:
    """Fields whose struct ordering is ``order`` then ``tie_break``, each
    ascending with NULLs last; also where each column's value sits."""
    fields, where = [], {}
    for i, c in enumerate(list(order) + list(tie_break)):
        fields.append(F.col(c).isNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(f"_v{i}"))
        where.setdefault(c, f"_v{i}")
    return fields, where


def dedupe(df: DataFrame, subset: Sequence[str], order: Sequence[str] = (), keep: str = "first",
           tie_break: Sequence[str] | None = None) -> DataFrame:
    """W-05: one row per ``subset``, the first (or last) in ``order``.

    Ascending order with NULLs last, as the original sort did; ``tie_break``
    (default: every other column) makes the choice deterministic.  Written as
    ``min``/``max`` of a struct per key, so it aggregates map-side and a hot
    key never lands whole in one task.  Columns already in the ordering are
    read back from it, so the struct carries each value once.
    """
    subset, order = list(subset), list(order)
    rest = [c for c in df.columns if c not in subset]
    tie = [c for c in (rest if tie_break is None else tie_break) if c not in order]
    fields, where = _order_fields(order, tie)
    payload = [c for c in rest if c not in where]
    key = F.struct(*fields, F.struct(*payload).alias("_p")) if payload else F.struct(*fields)
    agg = F.min(key) if keep == "first" else F.max(key)
    out = df.groupBy(*subset).agg(agg.alias("_d"))
    cols = [F.col(f"_d.{where[c]}").alias(c) if c in where else F.col("_d._p").getField(c).alias(c) for c in rest]
    return out.select(*subset, *cols).select(*df.columns)


def latest_snapshot(df: DataFrame, part: Sequence[str], order: str) -> DataFrame:
    """W-06: rows at the latest ``order`` per ``part`` (ties all kept, as ``rank() == 1``)."""
    part = list(part)
    mx = df.groupBy(*part).agg(F.max(order).alias(order))
    return df.join(mx, on=part + [order], how="left_semi")


def rank_by(df: DataFrame, value: str, part: Sequence[str] = (), absolute: bool = True, out: str = "ranking",
            tie_break: Sequence[str] = (), method: str = "range", partitions: int | None = None) -> DataFrame:
    """W-07: row number (long) by (absolute) ``value`` descending within ``part``
    (ties ordered by ``tie_break``).

    ``method='range'`` (default) never holds a whole group in one task: rows
    are range-partitioned on (part, value, tie-break) and written (a job of its
    own), numbered inside each (range partition, part), and shifted by the
    count of the same part in the earlier range partitions (a prefix sum over
    per-partition counts, at most partitions x parts rows).
    ``method='window'`` is one window per part, for results that are small by
    their nature, such as one row per reason.
    """
    part, tie = list(part), list(tie_break)
    if method not in ("range", "window"):
        raise ValueError(f"method must be 'range' or 'window', not {method!r}")
    d = df.withColumn("_rv", F.abs(F.col(value)) if absolute else F.col(value))
    order = [F.col(c).asc_nulls_first() for c in part] + [F.col("_rv").desc_nulls_last()] + \
            [F.col(c).asc_nulls_first() for c in tie]
    local_order = order[len(part):]
    if method == "window":
        w = Window.partitionBy(*part).orderBy(*local_order)
        return d.withColumn(out, F.row_number().over(w).cast("long")).drop("_rv")
    n = partitions or range_count(df)
    r = materialize(d.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "ranges")
    r = r.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid", *part).orderBy(*local_order)))
    counts = r.groupBy("_pid", *part).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *part, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    j = _null_safe_join(r, offsets, ["_pid", *part])
    return j.withColumn(out, F.col("_lrn") + F.col("_off")).select(*df.columns, out)


def severity_rank(df: DataFrame, flags: Sequence[str], out: str = "orden") -> DataFrame:
    """Place of each row (1 + rows before it, long) when sorted by boolean ``flags`` descending, the first one weighing most.

    Rows are counted by their combination of flags first, so the running count is over at most ``2 ** len(flags)`` rows
    however many rows there are.
    """
    if len(flags) > 20:
        raise ValueError("at most 20 flags")
    weight = sum((F.coalesce(F.col(c), F.lit(False)).cast("long") * F.lit(2 ** (len(flags) - 1 - i)) for i, c in enumerate(flags)), F.lit(0).cast("long"))
    df = df.withColumn("_severity", weight)
    n = df.groupBy("_severity").agg(F.count("*").alias("_n"))
    before = Window.orderBy(F.desc("_severity")).rowsBetween(Window.unboundedPreceding, -1)
    n = n.select("_severity", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias(out))
    return df.join(n, "_severity").drop("_severity")
