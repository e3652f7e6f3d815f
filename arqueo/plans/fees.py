"""Fees, notaries, bank debits and the employer contribution (D-CH*, D-CE*, D-DB1, D-AE*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.nulls import not_in_keep_null

# FIXED VALUES: withholding columns folded into "otras" by the fee summaries,
# the notary, bank-debit and employer-contribution accounts, lines and codes,
# and the text fragments of fee vouchers.
FEE_OTHER_COLS = ["otras_retenciones", "anticipo", "descuento", "embargo", "mutual"]
RENDITION_OTHER_COLS = ["gcias", "suss", "propia", "salud", "mutual"]
NOTARY_LEDGER_ACCOUNT = "2113-2-9"
OPENING_VOUCHER_TYPE = "APE"
BANK_DEBITS_LINE = "355"
BANK_DEBITS_CODE = "031"
CONTRIBUTION_CODE = "337"
FEE_VOUCHER_WORDS = ["HONOR", "RECON", "LOC"]
CONTRIBUTION_ACCOUNT = "2122-1-2"
NOTARY_BANK_SKIP_CODES = ["004", "034", "213", "102"]


def fees_with_account(fees: DataFrame, vouchers: DataFrame, skip_words: Sequence[str] = ("SIIF",)) -> DataFrame:
    """D-SRC14: professional fees without vouchers containing 'SIIF', with the
    ledger account of their voucher (one per year and voucher), numbers filled
    with 0, the payee as ``beneficiario``."""
    f = op.matches(fees, "nro_comprobante", list(skip_words), keep=False)
    acct = op.dedupe(vouchers.select("ejercicio", "nro_comprobante", "cta_cte"), ["ejercicio", "nro_comprobante"],
                     ["cta_cte"], "first")
    out = op.fill0(f.join(acct, on=["ejercicio", "nro_comprobante"], how="left"))
    out = out.withColumnRenamed("razon_social", "beneficiario")
    return out.drop("id") if "id" in out.columns else out


def fees_summary(fees: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "nro_comprobante", "cta_cte"),
                 only_gross: bool = False) -> DataFrame:
    """D-CH1: fees by free keys: 'otras' folds five columns, stamps include
    'lp', withholdings = iibb + stamps + insurance + otras, net = gross -
    withholdings."""
    keys = list(keys)
    d = fees.withColumn("otras", op.filters.row_total_expr([c for c in FEE_OTHER_COLS if c in fees.columns]))
    d = d.withColumn("sellos", F.coalesce(F.col("sellos"), F.lit(0)) + F.coalesce(F.col("lp"), F.lit(0)))
    d = d.withColumn("retenciones", op.filters.row_total_expr(["iibb", "sellos", "seguro", "otras"]))
    d = d.withColumn("importe_neto", F.col("importe_bruto") - F.col("retenciones"))
    if only_gross:
        return op.group_sum(d, keys, ["importe_bruto"])
    return op.group_sum(d, keys, ["importe_bruto", "iibb", "sellos", "seguro", "otras", "retenciones",
                                  "importe_neto"])


def fee_vouchers(vouchers: DataFrame, own_cuit: str = K.OWN_CUIT, accounts: Sequence[str] = ("130832-05", "130832-07"),
                 group: str = "300", skip_line: str = "384", words: Sequence[str] = FEE_VOUCHER_WORDS) -> DataFrame:
    """D-SRC9: fee vouchers: own tax id, group 300, not line 384, two accounts, text patterns."""
    v = vouchers.filter((F.col("cuit") == own_cuit) & (F.col("grupo") == group))
    v = v.filter(not_in_keep_null("partida", [skip_line])).filter(F.col("cta_cte").isin(list(accounts)))
    return op.matches(v, "glosa", list(words), keep=True)


def fee_vouchers_summary(vouchers: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "nro_comprobante", "cta_cte"),
                         count_flags: bool = True) -> DataFrame:
    """D-CH2: fee vouchers summed by free keys.  The original summed every
    numeric column including the boolean flags (a count of True per group);
    ``count_flags=False`` sums amounts only."""
    return op.sum_numeric(vouchers, keys, bools=count_flags)


def fee_renditions_summary(renditions: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "cuit", "beneficiario"),
                           only_gross: bool = False) -> DataFrame:
    """D-CH2: fee renditions by free keys, five withholding columns folded into 'otras'."""
    fold = [c for c in RENDITION_OTHER_COLS if c in renditions.columns]
    d = renditions.withColumn("otras", op.filters.row_total_expr(["otras"] + fold)).drop(*fold)
    if only_gross:
        d = d.select(*keys, "importe_bruto")
    return op.sum_numeric(d, keys)


def _one_per_voucher(df: DataFrame, amount: str, prefix: str) -> DataFrame:
    first = F.struct(F.col("mes").isNull().alias("n0"), F.col("mes").alias("mes"),
                     F.col("cta_cte").isNull().alias("n1"), F.col("cta_cte").alias("cta_cte"))
    g = df.groupBy("ejercicio", "nro_comprobante").agg(F.sum(amount).alias("_imp"), F.min(first).alias("_a"))
    return g.select(F.col("ejercicio").alias(f"{prefix}ejercicio"), F.col("nro_comprobante").alias(f"{prefix}nro"),
                    F.col("_imp").alias(f"{prefix}importe"), F.col("_a.mes").alias(f"{prefix}mes"),
                    F.col("_a.cta_cte").alias(f"{prefix}cta_cte"))


def ledger_vs_fees(ledger: DataFrame, fees: DataFrame, tol: float = 1e-8) -> DataFrame:
    """D-CH3: ledger fee vouchers vs the fee system by (year, voucher), full
    outer; flags for voucher, amount (not within ``tol``), month and account,
    missing values compared as 0; only mismatches, most severe first.

    Each side is one row per (year, voucher) (amounts summed, month and
    account of the first row), so the full join never pairs lines.  Equally
    severe rows follow by year and voucher: four flags alone would give the
    sort 16 ranges at most, and nearly all rows to one task.
    """
    a = _one_per_voucher(ledger, "importe", "siif_")
    b = _one_per_voucher(fees, "importe_bruto", "slave_")
    m = op.match_vouchers(a, b, [("siif_ejercicio", "slave_ejercicio"), ("siif_nro", "slave_nro")],
                          coalesce={"ejercicio": ("siif_ejercicio", "slave_ejercicio")})
    m = op.fill0(m, ["siif_importe", "slave_importe"])
    m = op.flag_mismatch(m, {"err_nro": ("siif_nro", "slave_nro"),
                             "err_importe": ("siif_importe", "slave_importe", tol),
                             "err_mes": ("siif_mes", "slave_mes"), "err_cta_cte": ("siif_cta_cte", "slave_cta_cte")},
                         null_policy="equal")
    cols = ["ejercicio", "siif_nro", "slave_nro", "err_nro", "siif_importe", "slave_importe", "err_importe",
            "siif_mes", "slave_mes", "err_mes", "siif_cta_cte", "slave_cta_cte", "err_cta_cte"]
    flags, rest = ["err_nro", "err_importe", "err_cta_cte", "err_mes"], ["ejercicio", "siif_nro", "slave_nro"]
    return op.sort_out(m.select(*cols), [*flags, *rest], [False] * len(flags) + [True] * len(rest))


def fees_vs_renditions(fees_sum: DataFrame, renditions_sum: DataFrame, keys: Sequence[str],
                       only_diff: bool = False) -> DataFrame:
    """D-CH4: union-aligned subtraction (no fill of one-sided columns: NULL)."""
    out = op.subtract(fees_sum, renditions_sum, list(keys), how="union", left_only="null")
    out = out.select(*[c for c in fees_sum.columns if c in out.columns])  # the fee system's columns
    return op.only_diff(out, tol=1e-8) if only_diff else out


def notary_ledger(ledger: DataFrame) -> DataFrame:
    """D-SRC11: notary account of the ledger without opening entries: credits
    are loads, debits payments, unpaid = loads - payments."""
    d = ledger.filter(F.col("cta_contable") == NOTARY_LEDGER_ACCOUNT)
    d = d.filter(not_in_keep_null("tipo_comprobante", [OPENING_VOUCHER_TYPE]))
    d = d.withColumnsRenamed({"auxiliar_1": "cuit", "creditos": "carga_fei", "debitos": "pagos_fei"})
    return d.withColumn("fei_impagos", F.col("carga_fei") - F.col("pagos_fei"))


def notary_ledger_summary(ledger_rows: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "cuit")) -> DataFrame:
    """D-CE1: notary ledger summed by free keys."""
    return op.group_sum(ledger_rows, keys, ["carga_fei", "pagos_fei", "fei_impagos"])


def notary_renditions_summary(renditions: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "cuit",
                                                                            "beneficiario")) -> DataFrame:
    """D-CE1: renditions of the notary account, net paid by free keys."""
    r = renditions.filter(F.col("cta_cte") == K.NOTARY_ACCOUNT)
    return op.group_sum(r, keys, ["importe_neto"])


def notary_bank_summary(bank: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "cod_imputacion", "imputacion"),
                        skip_codes: Sequence[str] = NOTARY_BANK_SKIP_CODES) -> DataFrame:
    """D-CE1: notary bank account without four codes, summed, sign flipped."""
    b = op.codes(bank.filter(F.col("cta_cte") == K.NOTARY_ACCOUNT), "cod_imputacion", exclude=list(skip_codes))
    return op.group_sum(b, keys, {"importe_neto": -F.col("importe")})


def notary_renditions_vs_bank(renditions_sum: DataFrame, bank_sum: DataFrame, keys: Sequence[str],
                              only_diff: bool = False) -> DataFrame:
    """D-CE2: renditions minus bank on the union of keys, in the renditions' columns."""
    out = op.subtract(renditions_sum, bank_sum, list(keys), how="union")
    out = out.select(*[c for c in renditions_sum.columns if c in out.columns])
    return op.only_diff(out) if only_diff else out


def notary_ledger_vs_renditions(ledger_sum: DataFrame, renditions_sum: DataFrame, keys: Sequence[str],
                                only_diff: bool = False) -> DataFrame:
    """D-CE3: ledger and renditions side by side on the union of keys (gaps 0),
    ``dif_pagos`` = ledger payments - renditions paid."""
    keys = list(keys)
    a = ledger_sum.select(*keys, "carga_fei", "pagos_fei", "fei_impagos")
    b = renditions_sum.select(*keys, F.col("importe_neto").alias("pagos_sgf"))
    out = op.reconcile(a, b, keys, {"carga_fei": "carga_fei", "pagos_fei": "pagos_fei",
                                    "fei_impagos": "fei_impagos"}, {"pagos_sgf": "pagos_sgf"}, diff="dif_pagos",
                       diff_expr=F.col("pagos_fei") - F.col("pagos_sgf"), aggregate=False)
    return op.only_diff(out) if only_diff else out


def bank_debit_vouchers(vouchers: DataFrame, line: str = BANK_DEBITS_LINE) -> DataFrame:
    """D-SRC10: ledger vouchers of the bank-debits line."""
    return vouchers.filter(F.col("partida") == line)


def bank_debits(bank: DataFrame, code: str = BANK_DEBITS_CODE) -> DataFrame:
    """D-SRC10: bank debits (code 031), sign flipped."""
    return op.negate(bank.filter(F.col("cod_imputacion") == code), "importe")


def debits_control(vouchers: DataFrame, bank: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "cta_cte"),
                   only_diff: bool = False, count_flags: bool = True) -> DataFrame:
    """D-DB1: ledger bank-debit vouchers (line 355) vs bank debits (code 031)
    by free keys, on the union of keys, ``diferencia`` = ledger - bank.

    The ledger side sums every numeric column; as in the original, boolean
    flags are summed too (counts of True) unless ``count_flags=False``.
    """
    keys = list(keys)
    a = op.sum_numeric(bank_debit_vouchers(vouchers), keys, bools=count_flags) \
        .withColumnRenamed("importe", "ejecutado_siif")
    b = op.group_sum(bank.filter(F.col("cod_imputacion") == BANK_DEBITS_CODE), keys,
                     {"debitos_sscc": -F.col("importe")})
    meas = [c for c in a.columns if c not in keys]
    r = op.reconcile(a, b, keys, {c: c for c in meas}, {"debitos_sscc": "debitos_sscc"}, diff="diferencia",
                     diff_expr=F.col("ejecutado_siif") - F.col("debitos_sscc"), aggregate=False)
    return op.only_diff(r) if only_diff else r


def contribution_revenue(revenue: DataFrame, keys: Sequence[str] = ("ejercicio", "mes", "cta_cte")) -> DataFrame:
    """D-AE1: the 3 % revenue (own funds, verified), summed by free keys."""
    r = revenue.filter((F.col("es_propio") == F.lit(True)) & (F.col("es_verificado") == F.lit(True)))
    return op.group_sum(r, keys, {"recurso_3%": "importe"})


def contribution_withholdings(ledger: DataFrame, account_map: DataFrame | None = None,
                              keys: Sequence[str] = ("ejercicio", "mes")) -> DataFrame:
    """D-AE2: ledger withholdings of code 337 (account 2122-1-2, no opening
    entries) with the bank account of their entry (year + entry), mapped,
    summed by free keys: payments (debits) and charges (credits).

    The bank side is one account per entry, so an entry booked on several
    bank lines cannot repeat the withholding.
    """
    def no_opening(d):
        return d.filter(not_in_keep_null("tipo_comprobante", [OPENING_VOUCHER_TYPE]))

    bank = no_opening(ledger.filter(F.col("cta_contable") == "1112-2-6")).select(
        "ejercicio", "nro_entrada", F.col("auxiliar_1").alias("cta_cte"))
    bank = op.dedupe(bank, ["ejercicio", "nro_entrada"], ["cta_cte"], "first")
    r = no_opening(ledger.filter(F.col("cta_contable") == CONTRIBUTION_ACCOUNT))
    r = r.filter(F.col("auxiliar_1") == CONTRIBUTION_CODE).select(
        "ejercicio", "mes", "fecha", "nro_entrada", "tipo_comprobante", F.col("debitos").alias("pagos_337_siif"),
        F.col("creditos").alias("gastos_337_siif"))
    d = r.join(bank, on=["ejercicio", "nro_entrada"], how="left")
    if account_map is not None:
        d = op.lookup(d, account_map, "cta_cte", "siif_contabilidad_cta_cte", "map_to")
    return op.group_sum(d, keys, ["pagos_337_siif", "gastos_337_siif"])


def contribution_control(revenue_sum: DataFrame, withholding_sum: DataFrame, keys: Sequence[str],
                         only_diff: bool = False) -> DataFrame:
    """D-AE3: 3 % revenue vs code-337 payments side by side on the union of
    keys (gaps 0), no difference column."""
    out = op.reconcile(revenue_sum, withholding_sum.drop("gastos_337_siif"), list(keys), {"recurso_3%": "recurso_3%"},
                       {"pagos_337_siif": "pagos_337_siif"}, diff=None, aggregate=False)
    return op.only_diff(out) if only_diff else out
