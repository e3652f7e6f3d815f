"""Floating debt against the accounting ledger (D-NET2, D-NET6..D-NET8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.nulls import not_in_keep_null
from ..functions.scalars import voucher_int_text, zfill

# FIXED VALUES: voucher types of the liabilities ledger; the adjustments that
# are not floating debt (account prefix, account, eight vouchers) plus the one
# adjustment kept whatever its balance; the voucher that must not be in the
# debt; the payroll lines, account, codes and texts of the synthetic vouchers.
KNOWN_BAD_DEBT_VOUCHERS = ["02749/11"]
LIABILITY_TYPES = ["CAO", "CAP", "CAM", "CAD", "ANP"]
ADJUSTMENT_TYPE = "AJU"
ADJUSTMENT_SKIP_PREFIX = "2241"
ADJUSTMENT_SKIP_ACCOUNT = "2113-2-9"
ADJUSTMENT_SKIP_VOUCHERS = ["16535/11", "15793/12", "17773/16", "17096/13", "17097/13", "19897/17", "15142/21",
                            "16986/24"]
ADJUSTMENT_KEEP_VOUCHER = "16536/11"
PAYROLL_SKIP_LINES = ["150", "151"]
PAYROLL_NET_ACCOUNT = "2122-1-2"
PAYROLL_NET_CODES = ["245", "310"]
PAYROLL_NET_TEXTS = {"245": "RET. GCIAS. 4TA CATEGORÍA", "310": "HABERES ERRONEOS COD 310"}
PAYROLL_NET_EXPTE_PREFIX = "90000000"


def payroll_vouchers(vouchers: DataFrame, ledger: DataFrame | None = None, skip_art: bool = False,
                     net_codes: bool = False, account: str = K.PAYROLL_ACCOUNT,
                     own_name: str | None = None) -> DataFrame:
    """D-NET2: payroll vouchers (one account); optionally without lines
    150/151; optionally plus the ledger credits of withholding codes 245/310
    (account 2122-1-2, no opening entries) as negative synthetic vouchers.
    ``own_name`` is the payee written on them (the institution's name)."""
    v = vouchers.filter(F.col("cta_cte") == account)
    if skip_art:
        v = v.filter(not_in_keep_null("partida", PAYROLL_SKIP_LINES))
    if net_codes and ledger is not None:
        g = ledger.filter(F.col("cta_contable") == PAYROLL_NET_ACCOUNT)
        g = g.filter(not_in_keep_null("tipo_comprobante", ["APE"])).filter(F.col("auxiliar_1").isin(PAYROLL_NET_CODES))
        g = g.select(
            "ejercicio", "mes", "fecha",
            F.concat(zfill(F.col("nro_entrada"), 5), F.lit("/"), F.substring("ejercicio", -2, 2), F.lit("A"))
            .alias("nro_comprobante"),
            (-F.col("creditos")).alias("importe"), F.lit("100").alias("grupo"), F.col("auxiliar_1").alias("partida"),
            "nro_entrada", F.col("nro_entrada").alias("nro_origen"),
            F.concat(F.lit(PAYROLL_NET_EXPTE_PREFIX), F.col("ejercicio")).alias("nro_expte"),
            F.when(F.col("auxiliar_1") == "245", F.lit(PAYROLL_NET_TEXTS["245"]))
            .otherwise(F.lit(PAYROLL_NET_TEXTS["310"])).alias("glosa"),
            F.lit(own_name).cast("string").alias("beneficiario"), F.lit(None).cast("string").alias("nro_fondo"),
            F.lit("11").alias("fuente"), F.lit(account).alias("cta_cte"), F.lit(K.OWN_CUIT).alias("cuit"),
            F.lit("CYO").alias("clase_reg"), F.lit("NOR").alias("clase_mod"), F.lit("REM").alias("clase_gto"),
            *[F.lit(True).alias(c) for c in ("es_comprometido", "es_verificado", "es_aprobado", "es_pagado")])
        v = op.union_all(v, g)
    return v


def liabilities(ledger: DataFrame, year: str | None = None, with_adjustments: bool = True) -> DataFrame:
    """D-NET6: liabilities ledger: account starting with 2 and payment voucher types."""
    d = op.years(ledger, year) if year is not None else ledger
    types = LIABILITY_TYPES + ([ADJUSTMENT_TYPE] if with_adjustments else [])
    d = op.prefix_filter(d, "cta_contable", prefix="2")
    return op.codes(d, "tipo_comprobante", include=types).withColumnRenamed("saldo", "saldo_contable")


DEBT_COLS = ["ejercicio", "fuente", "cta_cte", "nro_original", "saldo_rdeu", "cuit", "glosa", "nro_expte"]


def latest_debt_by_year(snapshots: DataFrame, years: Sequence[str],
                        drop_vouchers: Sequence[str] = ()) -> DataFrame:
    """D-NET4 for several report years at once: for each year Y, the debt at
    the latest snapshot month of Y (``ejercicio_contable`` = Y), origin number
    as ``nro_original`` and balance as ``saldo_rdeu``."""
    d = snapshots.withColumn("ejercicio_contable", F.substring("mes_hasta", -4, 4))
    d = op.years(d, list(years), "ejercicio_contable")
    d = op.latest_period(d, "mes_hasta", keys=["ejercicio_contable"])
    if drop_vouchers:
        d = d.filter(not_in_keep_null("nro_comprobante", list(drop_vouchers)))
    return d.withColumnsRenamed({"nro_origen": "nro_original", "saldo": "saldo_rdeu"})


def ledger_of_debt(debt_by_year: DataFrame, liab: DataFrame, years: Sequence[str],
                   with_adjustments: bool) -> DataFrame:
    """D-NET7 / D-NET8: for every report year Y, the liabilities of Y whose
    original number is one of Y's own unpaid vouchers (number part of the
    voucher), plus (optionally) the adjustments of Y.  One semi-join on
    (year, number) replaces the per-year loop."""
    l = op.years(liab, list(years))
    own = debt_by_year.filter(F.col("ejercicio") == F.col("ejercicio_contable")).select(
        F.col("ejercicio_contable").alias("ejercicio"), voucher_int_text("nro_comprobante").alias("nro_original"))
    hit = l.join(own, on=["ejercicio", "nro_original"], how="left_semi")
    if with_adjustments:
        hit = op.union_all(hit, l.filter(F.col("tipo_comprobante") == ADJUSTMENT_TYPE))
    return hit


def _one_row_per_origin(debt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Debt lines of one origin number summed into one row (first attributes),
    so the join with the ledger is one-to-many.  Lines without an origin number
    match nothing and stay as they are."""
    attrs = [c for c in DEBT_COLS if c not in keys and c != "saldo_rdeu"]
    first = F.struct(*[e for i, c in enumerate(attrs) for e in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(c))])
    g = debt.filter(F.col("nro_original").isNotNull()).groupBy(*keys).agg(F.sum("saldo_rdeu").alias("saldo_rdeu"), F.min(first).alias("_a"))
    g = g.select(*keys, *[F.col("_a").getField(c).alias(c) for c in attrs], "saldo_rdeu")
    return g.unionByName(debt.filter(F.col("nro_original").isNull()).select(*g.columns))


def debt_with_accounting_class(snapshots: DataFrame, ledger: DataFrame, years: Sequence[str]) -> DataFrame:
    """D-NET7: ledger rows of every year's own unpaid vouchers, matched to the
    debt of the last year on (year, original number)."""
    years = sorted({str(y) for y in years}, key=int)
    debt = latest_debt_by_year(snapshots, years)
    filt = ledger_of_debt(debt, liabilities(ledger, with_adjustments=False), years, with_adjustments=False)
    last = _one_row_per_origin(op.years(debt, years[-1], "ejercicio_contable"), ["ejercicio", "nro_original"])
    return last.join(filt, on=["ejercicio", "nro_original"], how="left")


def adjustments_not_in_debt(acc_ledger: DataFrame, tol: float = 0.1) -> DataFrame:
    """D-NET8: adjustments that count as floating debt, per report year
    (``ejercicio_contable``): known exceptions dropped, groups of original
    number with |sum| > tol kept (semi-join on the HAVING result), plus one
    voucher always kept; fund 11, sign flipped."""
    aju = acc_ledger.filter(F.col("tipo_comprobante") == ADJUSTMENT_TYPE)
    aju = aju.withColumn("nro_comprobante", F.concat(F.col("nro_entrada"), F.lit("/"), F.substring("ejercicio", 3, 2)))
    aju = aju.filter(~F.coalesce(F.col("cta_contable").startswith(ADJUSTMENT_SKIP_PREFIX), F.lit(False)))
    aju = aju.filter(not_in_keep_null("cta_contable", [ADJUSTMENT_SKIP_ACCOUNT]))
    aju = aju.filter(not_in_keep_null("nro_comprobante", ADJUSTMENT_SKIP_VOUCHERS))
    keep = aju.filter(F.col("nro_comprobante") == ADJUSTMENT_KEEP_VOUCHER).drop("nro_comprobante")
    kept = op.having_semi(aju, ["ejercicio_contable", "nro_original"], "saldo_contable",
                          lambda s: F.abs(s) > F.lit(tol))
    out = op.union_all(kept, keep)
    return out.withColumns({"fuente": F.lit("11"), "saldo_rdeu": -F.col("saldo_contable")})


def debt_with_accounting(snapshots: DataFrame, ledger: DataFrame, years: Sequence[str]) -> dict[str, DataFrame]:
    """D-NET8 (functional version): for every report year Y (ascending):

    * ``rdeu012``: the debt at Y's latest month (a known bad voucher dropped);
    * ``rcocc31``: Y's liabilities of Y's own unpaid vouchers plus Y's adjustments;
    * ``rdeu_cta_contable``: Y's debt left-joined on (year, original number) to
      the ledger rows filtered in every year up to Y (the original accumulated
      them, so earlier adjustments repeat in later years), plus the
      adjustments that count as debt.

    The accumulation is the bounded year expansion (J-12) of the filtered
    ledger, so all years run in one plan.
    """
    years = sorted({str(y) for y in years}, key=int)
    debt = latest_debt_by_year(snapshots, years, KNOWN_BAD_DEBT_VOUCHERS)
    filt = ledger_of_debt(debt, liabilities(ledger, with_adjustments=True), years, with_adjustments=True)
    acc = op.as_of_years(filt, years, "ejercicio", out="ejercicio_contable")
    deb = _one_row_per_origin(debt, ["ejercicio_contable", "ejercicio", "nro_original"])
    joined = deb.join(acc, on=["ejercicio_contable", "ejercicio", "nro_original"], how="left")
    aju = adjustments_not_in_debt(acc)
    return {"rdeu012": debt, "rcocc31": filt, "rdeu_cta_contable": op.union_all(joined, aju)}


def account_summary(matched: DataFrame, keys: Sequence[str] = ("ejercicio_contable", "cta_contable")) -> DataFrame:
    """D-NET8: accounting balance and debt balance by account."""
    return op.group_sum(matched, keys, ["saldo_contable", "saldo_rdeu"])
