"""Netting of accrued-but-unpaid vouchers ("floating debt", D-NET1 / D-NET3).

An expense voucher that was accrued in one month but paid later appears in
the monthly unpaid-voucher snapshots.  Netting moves it from accrual to cash
timing: a negative row in each month it is reported unpaid, and a positive row
one month after its last snapshot (when it was paid).

The snapshots are aggregated once and written; the joins of that table with the
loads therefore have an exchange of their own on either side, so that AQE can
split the loads of a hot voucher.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.nulls import not_in_keep_null
from ..functions.scalars import add_one_month, month_of, year_from_month
from ..session import materialize
from .filters import years as year_filter
from .reshape import union_all
from .windows import dedupe


def monthly_snapshots(snapshots: DataFrame, voucher: str = "nro_comprobante", month: str = "mes",
                      date: str = "fecha_hasta", balance: str = "saldo", cols: Sequence[str] = ()) -> DataFrame:
    """(voucher, month, first, last): the earliest and the latest snapshot of each voucher and month.

    Earliest: by date, then balance and ``cols`` (ascending, NULLs last); latest: the same order's last.  One
    aggregation over the snapshots, reduced inside each map task, written once: both netting rows start from it.
    """
    keep = [c for c in cols if c in snapshots.columns and c not in (voucher, month, date, balance)]

    def order(columns: Sequence[str]):
        return F.struct(*[e for c in columns for e in (F.col(c).isNull().alias(f"n_{c}"), F.col(c).alias(c))])

    s = snapshots.groupBy(voucher, month).agg(F.min(order([date, balance, *keep])).alias("first"),
                                              F.max(order([date, balance, *keep])).alias("last"))
    return materialize(s, "snapshots")


def paid_after_last_snapshot(monthly: DataFrame, voucher: str = "nro_comprobante", date: str = "fecha_hasta",
                             balance: str = "saldo", cols: Sequence[str] = ()) -> DataFrame:
    """Last snapshot of each voucher moved one month later: the month it was paid.

    ``monthly`` is :func:`monthly_snapshots`.  Returns voucher, ``cols``,
    balance, ``fecha`` / ``mes`` / ``ejercicio`` of the payment month.
    """
    last = monthly.groupBy(voucher).agg(F.max("last").alias("_l"))
    keep = [c for c in cols if c in [f.name for f in monthly.schema["last"].dataType]]
    paid = add_one_month(date)
    out = last.select(voucher, *[F.col("_l").getField(c).alias(c) for c in (date, balance, *keep)])
    return out.select(voucher, *keep, balance, paid.alias("fecha")) \
        .withColumn("mes", month_of("fecha")).withColumn("ejercicio", year_from_month("mes"))


def net_pending(loads: DataFrame, snapshots: DataFrame, years: str | Sequence[str] | None = None,
                voucher: str = "nro_comprobante", month: str = "mes", balance: str = "saldo",
                date: str = "fecha_hasta", snap_cols: Sequence[str] = ("fuente", "cuit", "cta_cte"),
                load_cols: Sequence[str] = ("actividad", "partida", "fondo_reparo", "certificado", "avance",
                                            "origen", "obra"),
                require: str | None = "actividad", allocate: str = "each",
                advance: str = codes.WORKS_ADVANCE_TYPE, regularisation: str = codes.WORKS_REGULARISATION_TYPE,
                debt: str = codes.FLOATING_DEBT_TYPE, amount: str = "importe",
                monthly: DataFrame | None = None) -> DataFrame:
    """D-NET1: works loads net of floating debt.

    1. loads that are neither advances nor regularisations;
    2. for the earliest snapshot of each (voucher, month) that matches a load of
       that voucher and month, a row of ``-balance`` typed ``debt`` (the load's
       other columns kept);
    3. the advance loads;
    4. for the last snapshot of each voucher, ``+balance`` dated one month later
       (id = voucher + 'C'), joined to the voucher's loads for ``load_cols``
       (one row per load line: ``allocate='each'``, the original result; or
       only one: ``allocate='first'``); only for the requested years;
    5. the year filter on the union.

    ``monthly``: :func:`monthly_snapshots` of the same snapshots whose columns
    start with ``snap_cols``, where a caller has it already.
    """
    base = loads.filter(not_in_keep_null("tipo", [advance, regularisation]))
    # steps 1 and 3 together are "every load but regularisations": one scan
    kept = loads.filter(not_in_keep_null("tipo", [regularisation]))

    if monthly is None:
        monthly = monthly_snapshots(snapshots, voucher, month, date, balance, snap_cols)
    first = monthly.select(voucher, month, F.col("first").getField(balance).alias(balance))
    neg = (first.join(base, on=[voucher, month], how="inner")
           .withColumn(amount, -F.col(balance)).withColumn("tipo", F.lit(debt)).drop(balance))

    lc = [c for c in load_cols if c in loads.columns and c != voucher]
    paid = paid_after_last_snapshot(monthly, voucher, date, balance, snap_cols)
    paid = year_filter(paid, years)
    attrs = base.select(voucher, *lc)
    if allocate == "first":
        attrs = dedupe(attrs, [voucher], lc[:1], "first")
    pos = paid.join(attrs, on=voucher, how="inner")
    if require and require in pos.columns:
        pos = pos.filter(F.col(require).isNotNull())
    pos = (pos.withColumn(amount, F.col(balance)).withColumn("tipo", F.lit(debt))
           .withColumn("id", F.concat(F.col(voucher), F.lit("C"))).drop(balance))

    out = union_all(pos, neg, kept)
    return year_filter(out, years)


def net_pending_semi(vouchers: DataFrame, snapshots: DataFrame, years: str | Sequence[str] | None,
                     voucher: str = "nro_comprobante", month: str = "mes", balance: str = "saldo",
                     date: str = "fecha_hasta", amount: str = "importe",
                     flags: dict | None = None, monthly: DataFrame | None = None) -> DataFrame:
    """D-NET3: ledger vouchers net of floating debt, matched on the voucher only.

    Negative rows: earliest snapshot per (voucher, month) of vouchers present in
    ``vouchers`` (semi-join), not filtered by year.  Positive rows: last
    snapshot per voucher one month later, in the requested years, same
    semi-join.  ``flags`` are literal columns
    written on the synthetic rows.  ``monthly``: :func:`monthly_snapshots` of
    the same snapshots with all their columns, where a caller has it already.
    """
    flags = flags if flags is not None else {
        "clase_reg": "CYO", "clase_mod": "NOR", "clase_gto": codes.FLOATING_DEBT_TYPE,
        "es_comprometido": True, "es_verificado": True, "es_aprobado": True, "es_pagado": True}
    keys = vouchers.select(voucher)
    snap_rest = [c for c in snapshots.columns if c not in (voucher, month, date, balance)]

    if monthly is None:
        monthly = monthly_snapshots(snapshots, voucher, month, date, balance, snap_rest)
    first = monthly.select(voucher, month, *[F.col("first").getField(c).alias(c) for c in (balance, *snap_rest)])
    # the original also dropped repeats of (voucher, month, balance); these rows
    # are already one per (voucher, month), so that step is a no-op and skipped
    neg = first.join(keys, on=voucher, how="left_semi")
    neg = neg.withColumn(amount, -F.col(balance)).drop(balance)

    paid = paid_after_last_snapshot(monthly, voucher, date, balance, snap_rest)
    paid = year_filter(paid, years).join(keys, on=voucher, how="left_semi")  # one row per voucher already
    pos = paid.withColumn(amount, F.col(balance)).drop(balance)

    synth = union_all(neg, pos).withColumns({k: F.lit(v) for k, v in flags.items()})
    return union_all(vouchers, synth)
