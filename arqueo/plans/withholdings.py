"""Withholdings on works payments (D-RT1..D-RT12).

Four systems are compared on the same free keys: works loads with their
withholdings, the ledger (contractor payments + withholding payments), the
payment renditions and the bank.  Every comparison aggregates each side by
the keys first, then aligns the aggregates (no row-level fan-out).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.nulls import not_in_keep_null

KEYS3 = ("ejercicio", "mes", "cta_cte")
# FIXED VALUES: withholding codes of works payments and their column names.
WITHHOLDING_NAMES = {"110": "iibb", "111": "sellos", "112": "lp", "113": "gcias", "114": "suss", "337": "propia"}
LEDGER_BANK_ACCOUNT = "1112-2-6"
LEDGER_CONTRACTORS_ACCOUNT = "2111-1-2"
LEDGER_WITHHOLDINGS_ACCOUNT = "2122-1-2"
PAYMENT_VOUCHER_TYPES = ["CAP", "ANP", "CAD"]
# bank: the transfer code of withholdings and the text that names each
# withholding in the transfer concept.
BANK_TRANSFER_CODE = "034"
BANK_WITHHOLDING_WORDS = {"iibb": "IIBB", "sellos": "SELLOS", "gcias": "GCI", "suss": "SUSS", "propia": "INV"}


def withholdings_per_load(loads: DataFrame, withholdings: DataFrame,
                          codes: Sequence[str] = tuple(WITHHOLDING_NAMES)) -> DataFrame:
    """D-RT1: withholdings of the loads present (semi-join), one column per code, total."""
    w = op.semi(withholdings, loads.select(F.col("id").alias("id_carga")), "id_carga")
    return op.pivot_sum(w, ["id_carga"], "codigo", "importe", values=list(codes), total="retenciones")


def loads_with_withholdings(loads: DataFrame, withholdings: DataFrame,
                            codes: Sequence[str] = tuple(WITHHOLDING_NAMES)) -> DataFrame:
    """D-RT2: loads with their withholdings; withholdings take the sign of the
    gross amount; net = gross - withholdings; codes renamed."""
    w = withholdings_per_load(loads, withholdings, codes)
    d = loads.join(w, loads["id"] == w["id_carga"], "left").drop("id_carga")
    d = op.fill0(d, list(codes) + ["retenciones"])
    d = d.withColumn("importe_bruto", F.col("importe"))
    d = d.withColumn("retenciones", F.when(F.col("importe_bruto") < 0, -F.col("retenciones"))
                     .otherwise(F.col("retenciones")))
    d = d.withColumn("importe_neto", F.col("importe_bruto") - F.col("retenciones"))
    d = d.drop("importe", "nro_comprobante")
    return d.withColumnsRenamed({c: WITHHOLDING_NAMES.get(c, c) for c in codes})


def loads_summary(loads_w: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-RT3: D-RT2 summed by free keys (retention guarantee and progress left out)."""
    return op.sum_numeric(loads_w, keys, exclude=("fondo_reparo", "avance"))


def _bank_account_by_entry(ledger: DataFrame, account_map: DataFrame | None, with_year: bool) -> DataFrame:
    keys = ["ejercicio", "nro_entrada"] if with_year else ["nro_entrada"]
    b = ledger.filter(F.col("cta_contable") == LEDGER_BANK_ACCOUNT).select(*keys, F.col("auxiliar_1")
                                                                           .alias("cta_cte"))
    # one bank account per entry: the ledger may book an entry on several lines
    return op.dedupe(b, keys, ["cta_cte"], "first")


def contractor_payments(ledger: DataFrame, account_map: DataFrame | None = None) -> DataFrame:
    """D-RT4: contractor payments in the ledger with the bank account of their entry."""
    c = ledger.filter(F.col("cta_contable") == LEDGER_CONTRACTORS_ACCOUNT)
    c = op.codes(c, "tipo_comprobante", include=PAYMENT_VOUCHER_TYPES)
    c = c.select("ejercicio", "mes", "nro_entrada", "tipo_comprobante", F.col("debitos").alias("importe_neto"),
                 F.col("auxiliar_1").alias("cuit"))
    d = c.join(_bank_account_by_entry(ledger, account_map, True), on=["ejercicio", "nro_entrada"], how="left")
    if account_map is not None:
        d = op.lookup(d, account_map, "cta_cte", "siif_contabilidad_cta_cte", "map_to")
    return d


def withholding_payments(ledger: DataFrame, account_map: DataFrame | None = None, entry_with_year: bool = True
                         ) -> DataFrame:
    """D-RT5: withholding payments in the ledger, named by code.

    The original joined the bank entry without the year (amounts repeat when
    several years are loaded); ``entry_with_year=False`` reproduces that.
    """
    r = ledger.filter(F.col("cta_contable") == LEDGER_WITHHOLDINGS_ACCOUNT)
    r = op.codes(r, "tipo_comprobante", include=PAYMENT_VOUCHER_TYPES)
    r = r.select("ejercicio", "mes", "nro_entrada", "tipo_comprobante", F.col("debitos").alias("importe"),
                 F.col("auxiliar_1").alias("cod_ret"))
    keys = ["ejercicio", "nro_entrada"] if entry_with_year else ["nro_entrada"]
    d = r.join(_bank_account_by_entry(ledger, account_map, entry_with_year), on=keys, how="left")
    d = op.codes(d, "cod_ret", include=list(WITHHOLDING_NAMES))
    d = op.classify(d, "cod_ret", {v: [k] for k, v in WITHHOLDING_NAMES.items()}, out="cod_ret")
    if account_map is not None:
        d = op.lookup(d, account_map, "cta_cte", "siif_contabilidad_cta_cte", "map_to")
    return d


def ledger_summary(contractors: DataFrame, withholdings: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-RT6: ledger summary: net, one column per withholding, gross = net + withholdings.

    The six withholding columns are always present (0 when a code has no
    payment), so the summary keeps one schema whatever the data.
    """
    keys = list(keys)
    net = op.group_sum(contractors, keys, ["importe_neto"])
    names = list(WITHHOLDING_NAMES.values())
    ret = op.pivot_sum(withholdings, keys, "cod_ret", "importe", values=names, total="retenciones")
    out = net.join(ret, on=keys, how="full")
    out = op.fill0(out, ["importe_neto", "retenciones"] + names)
    return out.withColumn("importe_bruto", F.col("importe_neto") + F.col("retenciones"))


def renditions_summary(renditions: DataFrame, keys: Sequence[str] = KEYS3) -> DataFrame:
    """D-RT7: payment renditions summed by free keys."""
    return op.sum_numeric(renditions, keys)


def bank_summary(bank: DataFrame, keys: Sequence[str] = KEYS3, parity: bool = False,
                 words: Mapping[str, str] = BANK_WITHHOLDING_WORDS) -> DataFrame:
    """D-RT8: bank movements of works investment codes plus transfers (034).

    Transfers are withholdings (sign flipped); each named column takes the
    transfer when its text appears in the concept (a transfer may count in
    several columns, and ``retenciones`` is the whole transfer amount).  Other
    movements are the net paid (sign flipped).  Gross = net + withholdings.
    """
    keys = list(keys)
    codes_ = list(K.cash_flow_classes(parity)["3 - Inversión Obras"]) + [BANK_TRANSFER_CODE]
    b = op.codes(bank, "cod_imputacion", include=codes_)
    is_tr = F.coalesce(F.col("cod_imputacion") == BANK_TRANSFER_CODE, F.lit(False))
    zero = F.lit(0).cast(bank.schema["importe"].dataType)
    cols = {"retenciones": F.when(is_tr, -F.col("importe")).otherwise(zero)}
    for name, word in words.items():
        hit = is_tr & F.coalesce(F.col("concepto").contains(word), F.lit(False))
        cols[name] = F.when(hit, -F.col("importe")).otherwise(zero)
    cols["importe_neto"] = F.when(~is_tr, -F.col("importe")).otherwise(zero)
    out = op.group_sum(b.withColumns(cols), keys, list(cols))
    return out.withColumn("importe_bruto", F.col("importe_neto") + F.col("retenciones"))


def compare(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS3, how: str = "left",
            only_diff: bool = False, fold_lp: bool = False) -> DataFrame:
    """D-RT9, D-RT10, D-RT11, D-RT12: aligned subtraction of two summaries, in the left
    summary's columns (a column only on the right is not shown).

    ``how='left'`` reproduces D-RT9 / D-RT10, whose missing keys came from a
    frame minus itself (so only left keys remain); D-RT11 / D-RT12 align on
    the union of keys and first fold ``lp`` into ``sellos`` (``fold_lp``).
    """
    keys = list(keys)
    if fold_lp and "lp" in a.columns:
        a = a.withColumn("sellos", F.coalesce(F.col("sellos"), F.lit(0)) + F.coalesce(F.col("lp"), F.lit(0))) \
            .drop("lp")
    out = op.subtract(a, b, keys, how=how)
    out = out.select(*[c for c in a.columns if c in out.columns])
    return op.only_diff(out) if only_diff else out


def renditions_for_withholdings(renditions: DataFrame, account_map: DataFrame | None = None,
                                exclude_origin: str = "FUNCIONAMIENTO") -> DataFrame:
    """S-28 as used here: renditions of works payments (operating ones left out)."""
    r = renditions.filter(not_in_keep_null("origen", [exclude_origin]))
    if account_map is not None:
        r = op.lookup(r, account_map, "cta_cte", "sgf_cta_cte", "map_to")
    return r
