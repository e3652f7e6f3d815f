"""Bank, cash flow and ledger-vs-bank balances (D-FC1, D-CB1..D-CB5, D-SRC15)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.nulls import not_in_keep_null

KEYS3 = ("ejercicio", "mes", "cta_cte")


def cash_flow(bank: DataFrame, classes: Mapping[str, Sequence[str]] | None = None, other: str = K.CASH_FLOW_OTHER,
              parity: bool = False) -> DataFrame:
    """D-FC1: bank movements by cash-flow class (first matching code list)."""
    return op.classify(bank, "cod_imputacion", classes or K.cash_flow_classes(parity), other)


def yearly_cash_flow(bank: DataFrame, classes: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """D-FC1: yearly cash flow by class."""
    return op.group_sum(cash_flow(bank, classes), ["ejercicio", "clase"], ["importe"])


def ledger_bank_book(ledger: DataFrame, account_map: DataFrame | None = None, account: str = "1112-2-6") -> DataFrame:
    """S-30: the ledger's bank account, ``auxiliar_1`` as bank account, mapped."""
    d = ledger.filter(F.col("cta_contable") == account).withColumn("cta_cte", F.col("auxiliar_1"))
    if account_map is not None:
        d = op.lookup(d, account_map, "cta_cte", "siif_contabilidad_cta_cte", "map_to")
    return d


def ledger_bank_summary(book: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-CB1: ledger bank book summed by free keys."""
    return op.sum_numeric(book, keys)


def running_balance_at_period_end(bank: DataFrame, up_to_year: str | None = None,
                                  keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-CB2: running bank balance per account at the end of each period, over
    all years up to the last requested one."""
    b = op.up_to(bank, up_to_year) if up_to_year is not None else bank
    return op.running_balance(b, keys, part="cta_cte", order="fecha", value="importe", out="saldo")


def final_vs_running(final_balance: DataFrame, running: DataFrame, keys: Sequence[str] = ("ejercicio", "cta_cte"),
                     only_diff: bool = False) -> DataFrame:
    """D-CB3: official year-end balance vs running balance, union-aligned, ``dif``."""
    r = op.reconcile(final_balance, running, keys, {"sldo_final": "saldo"}, {"sldo_acum": "saldo"}, diff="dif")
    return op.only_diff(r) if only_diff else r


def ledger_vs_bank_final(ledger_summary: DataFrame, final_balance: DataFrame,
                         keys: Sequence[str] = ("ejercicio", "cta_cte"), only_diff: bool = False,
                         ledger_measure: str = "saldo") -> DataFrame:
    """D-CB4: ledger vs bank year-end balance, union-aligned, ``dif_sldo``.

    Every numeric column of the ledger bank summary is carried (debits,
    credits), its balance as ``sldo_siif``.
    """
    keys = list(keys)
    meas = {("sldo_siif" if c == ledger_measure else c): c
            for c in op.numeric_cols(ledger_summary) if c not in keys}
    r = op.reconcile(ledger_summary, final_balance, keys, meas, {"sldo_banco": "saldo"}, diff="dif_sldo",
                     diff_expr=F.col("sldo_siif") - F.col("sldo_banco"))
    return op.only_diff(r) if only_diff else r


def gap_explained(ledger_vs_bank: DataFrame, controls: Mapping[str, tuple[DataFrame, str, int]]) -> DataFrame:
    """D-CB5: yearly ledger-bank gap and the controls that explain it, long format.

    ``controls`` maps an output name to (control frame, its measure, sign).
    Each control is summed by year and left-joined to the yearly gap; a year
    without a row in a control stays NULL, so the adjusted gap is NULL too
    (as in the original, no fill).
    """
    base = op.group_sum(ledger_vs_bank, ["ejercicio"], ["sldo_siif", "sldo_banco", "dif_sldo"])
    frames = {}
    for name, (df, measure, sign) in controls.items():
        frames[name] = op.group_sum(df, ["ejercicio"], {name: F.col(measure) * F.lit(sign)})
    out = op.star(base, frames, ["ejercicio"])
    adj = F.col("dif_sldo")
    for name in controls:
        adj = adj + F.col(name)
    out = out.withColumn("dif_sldo_ajustado", adj)
    cols = [c for c in out.columns if c != "ejercicio"]
    return op.unpivot(out, ["ejercicio"], cols, "concepto", "importe", cast="decimal(38,2)")


def bank_with_imputation_type(bank: DataFrame, codes: DataFrame) -> DataFrame:
    """D-SRC15: bank movements with the type of their imputation code."""
    return op.enrich(bank, codes.select("cod_imputacion", "tipo"), "cod_imputacion")


def ledger_bank_without_advances(book: DataFrame, advance_type: str = "PAP") -> DataFrame:
    """D-SRC15: ledger bank book without contractor-advance rows."""
    return book.filter(not_in_keep_null("tipo_comprobante", [advance_type]))


def ledger_bank_gap(ledger_vs_bank: DataFrame, revenue_ctrl: DataFrame, works_ctrl: DataFrame,
                    payroll_ctrl: DataFrame, debits_ctrl: DataFrame, advances: DataFrame | None = None,
                    fees_ctrl: DataFrame | None = None, notary_ctrl: DataFrame | None = None) -> DataFrame:
    """D-CB5 with its usual controls: the ledger-bank gap (D-CB4) explained by
    revenue (D-CR1, sign flipped), works (D-CO1), payroll (D-HB1) and bank
    debits (D-DB1), and optionally contractor advances (S-20 outflows), fees
    (D-CH4 gross) and notaries (D-CE3)."""
    ctrls = {"recursos_dif": (revenue_ctrl, "diferencia", -1), "obras_dif": (works_ctrl, "diferencia", 1),
             "haberes_dif": (payroll_ctrl, "diferencia", 1), "debitos_banca_dif": (debits_ctrl, "diferencia", 1)}
    if advances is not None:
        ctrls["pa6_reg"] = (advances, "egresos", 1)
    if fees_ctrl is not None:
        ctrls["honorarios_dif"] = (fees_ctrl, "importe_bruto", 1)
    if notary_ctrl is not None:
        ctrls["escribanos_dif"] = (notary_ctrl, "dif_pagos", 1)
    return gap_explained(ledger_vs_bank, ctrls)
