"""Source cleaning and execution listings (D-SRC1, D-SRC2, D-SRC5, D-SRC13, D-EO1..D-EO4, D-EG1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.nulls import not_in_keep_null

# FIXED VALUES: accounts whose renditions repeat, the columns that identify a
# repeated rendition, and the bank rows added to the renditions.
REPEATED_RENDITION_ACCOUNTS = ["106", "2210178150"]
RENDITION_DEDUPE_COLS = ["mes", "fecha", "beneficiario", "libramiento_sgf", "importe_bruto"]
NEGATIVE_CERTIFICATE_CODE = "018"
NEGATIVE_CERTIFICATE_CUIT = K.OWN_CUIT
ALIMONY_CODE = "049"
ALIMONY_LABEL = "EMBARGO POR ALIMENTOS"
FEE_DESTINATIONS = ["HONORARIOS - FUNCIONAMIENTO", "COMISIONES - FUNCIONAMIENTO", "HONORARIOS - EPAM"]


def renditions_clean(renditions: DataFrame, bank: DataFrame | None = None, net_negative_certificates: bool = False,
                     account_map: DataFrame | None = None) -> DataFrame:
    """D-SRC1: renditions (account mapped) with the repeated rows of two
    accounts removed (dedupe on five columns, only inside those accounts);
    optionally plus bank deposits of negative certificates (code 018, not
    cheques) as negative gross = net rows with a fixed tax id."""
    r = renditions
    if account_map is not None:
        r = op.lookup(r, account_map, "cta_cte", "sgf_cta_cte", "map_to")
    for account in REPEATED_RENDITION_ACCOUNTS:
        r = op.dedupe_subset(r, F.col("cta_cte") == account, ["cta_cte"] + RENDITION_DEDUPE_COLS)
    if net_negative_certificates and bank is not None:
        b = bank.filter((F.col("cod_imputacion") == NEGATIVE_CERTIFICATE_CODE) & (F.col("movimiento") == K.DEPOSIT)
                        & (F.col("es_cheque") == F.lit(False)))
        b = b.select("ejercicio", "mes", "fecha", "cta_cte", F.lit("BANCO").alias("origen"),
                     F.lit(NEGATIVE_CERTIFICATE_CUIT).alias("cuit"), F.col("concepto").alias("beneficiario"),
                     "movimiento", F.col("imputacion").alias("destino"),
                     (-F.col("importe")).alias("importe_bruto"), (-F.col("importe")).alias("importe_neto"))
        r = op.union_all(r, b)
    return r


def fee_renditions(renditions: DataFrame, bank: DataFrame | None = None, accounts: Sequence[str] = ("130832-05",
                                                                                                    "130832-07"),
                   with_alimony: bool = True, account_map: DataFrame | None = None) -> DataFrame:
    """D-SRC2: fee renditions (not works, two accounts, three destinations,
    account mapped), plus alimony seizures from the bank (account 130832-05,
    code 049): gross = other withholdings = withholdings = the seized amount
    (sign flipped), net 0; numbers filled with 0."""
    r = renditions.filter(not_in_keep_null("origen", ["OBRAS"])).filter(F.col("cta_cte").isin(list(accounts)))
    r = op.codes(r, "destino", include=FEE_DESTINATIONS)
    if account_map is not None:
        r = op.lookup(r, account_map, "cta_cte", "sgf_cta_cte", "map_to")
    if with_alimony and bank is not None:
        b = bank.filter((F.col("cta_cte") == K.FEES_ACCOUNT) & (F.col("cod_imputacion") == ALIMONY_CODE))
        gross = -F.col("importe")
        b = b.select("ejercicio", "mes", "fecha", F.lit(ALIMONY_LABEL).alias("beneficiario"),
                     F.lit(ALIMONY_LABEL).alias("destino"), "cta_cte",
                     F.col("libramiento").alias("libramiento_sgf"), "movimiento", gross.alias("importe_bruto"),
                     gross.alias("otras"), gross.alias("retenciones"),
                     F.lit(0).cast("decimal(18,2)").alias("importe_neto"))
        r = op.fill0(op.union_all(r, b))
    return r


def bank_payments(bank: DataFrame) -> DataFrame:
    """D-SRC5: bank payments: not deposits, sign flipped."""
    return op.negate(bank.filter(not_in_keep_null("movimiento", [K.DEPOSIT])), "importe")


def permanent_fund_vouchers(vouchers: DataFrame, account: str = K.FEES_ACCOUNT) -> DataFrame:
    """D-SRC13: vouchers with a fund number on one account."""
    return vouchers.filter(F.col("nro_fondo").isNotNull() & (F.col("cta_cte") == account))


DESC_FRONT = ["ejercicio", "estructura", "partida", "fuente", "desc_prog", "desc_subprog", "desc_proy", "desc_act"]


def _drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def works_execution(budget: DataFrame, descriptions: DataFrame, years=None, current_only: str | None = None,
                    lines: Sequence[str] = ("421", "422")) -> DataFrame:
    """D-EO1: works budget execution (lines 421/422) with ledger descriptions
    by structure, descriptions first; ``current_only`` keeps one year and drops
    the year column (the current-year report)."""
    b = op.years(budget, years) if years is not None else budget
    b = b.filter(F.col("partida").isin(list(lines)))
    d = _drop(op.enrich(b, descriptions, "estructura"),
              ["org", "pendiente", "programa", "subprograma", "proyecto", "actividad", "grupo"])
    d = op.front(d, DESC_FRONT)
    if current_only is not None:
        d = op.years(d, current_only).drop("ejercicio")
    return d


def works_execution_icaro_desc(budget: DataFrame, descriptions: DataFrame, years=None,
                               lines: Sequence[str] = ("421", "422")) -> DataFrame:
    """D-EO2: works budget execution with works-system descriptions: lines
    421/422 with ordered > 0, the structure cut to the activity (11 chars)."""
    b = op.years(budget, years) if years is not None else budget
    b = b.filter(F.col("partida").isin(list(lines)) & (F.col("ordenado") > 0))
    b = _drop(b, ["org", "pendiente", "programa", "subprograma", "proyecto", "actividad", "grupo"])
    b = b.withColumn("actividad", F.substring("estructura", 1, 11))
    d = op.enrich(b, descriptions, "actividad").withColumn("estructura", F.col("actividad"))
    d = _drop(d, ["ejercicio", "actividad", "desc_subprog"]).withColumnsRenamed(
        {"desc_prog": "prog_con_desc", "desc_proy": "proy_con_desc", "desc_act": "act_con_desc"})
    return op.front(d, ["estructura", "partida", "fuente", "prog_con_desc", "proy_con_desc", "act_con_desc"])


def expense_execution(budget: DataFrame, descriptions: DataFrame, years=None) -> DataFrame:
    """D-EG1: expense budget execution with ledger descriptions, descriptions first."""
    b = op.years(budget, years) if years is not None else budget
    d = _drop(op.enrich(b, descriptions, "estructura"), ["org", "pendiente", "subprograma", "proyecto",
                                                         "actividad"])
    d = d.withColumn("programa", F.col("programa").cast("int"))
    return op.front(d, DESC_FRONT)


def _with_descriptions(d: DataFrame, descriptions: DataFrame, siif_desc: bool) -> DataFrame:
    if siif_desc:  # ledger descriptions are keyed by structure = activity-line
        d = d.withColumn("estructura", F.concat(F.col("actividad"), F.lit("-"), F.col("partida")))
        return op.enrich(d, descriptions, "estructura").drop("estructura")
    return op.enrich(d, descriptions, "actividad")


def _with_supplier(d: DataFrame, suppliers: DataFrame) -> DataFrame:
    prov = op.dedupe(suppliers.select("cuit", F.col("desc_prov").alias("proveedor")), ["cuit"], [], "first")
    return op.enrich(d, prov, "cuit")


def _year_scope(d: DataFrame, up_to_year: str | None, years) -> DataFrame:
    if years is not None:
        return op.years(d, years)
    return op.up_to(d, up_to_year) if up_to_year is not None else d


def loads_with_descriptions(loads: DataFrame, descriptions: DataFrame, suppliers: DataFrame,
                            cash_basis: bool = False, up_to_year: str | None = None, years=None,
                            siif_desc: bool = True, lines: Sequence[str] = ("421", "422")) -> DataFrame:
    """D-EO3: works loads on accrual basis (no advances) or cash basis (no
    regularisations), up to a year (or a list of years), works lines only,
    with budget descriptions and the first supplier name per tax id."""
    skip = K.WORKS_REGULARISATION_TYPE if cash_basis else K.WORKS_ADVANCE_TYPE
    d = _year_scope(loads.filter(not_in_keep_null("tipo", [skip])), up_to_year, years)
    d = d.filter(F.col("partida").isin(list(lines)))
    return _with_supplier(_with_descriptions(d, descriptions, siif_desc), suppliers)


def basic_module_loads(loads: DataFrame, works: DataFrame, descriptions: DataFrame, suppliers: DataFrame,
                       up_to_year: str | None = None, skip_regularisations: bool = False,
                       skip_advances: bool = True, siif_desc: bool = True, prefix: str = "29") -> DataFrame:
    """D-EO4: loads of activities starting with 29 up to a year, with the
    works' town, legal norm and agreement (one row per work), descriptions and
    supplier."""
    skip = [t for t, on in ((K.WORKS_ADVANCE_TYPE, skip_advances),
                            (K.WORKS_REGULARISATION_TYPE, skip_regularisations)) if on]
    d = loads.filter(not_in_keep_null("tipo", skip)) if skip else loads
    d = _year_scope(op.prefix_filter(d, "actividad", prefix=prefix), up_to_year, None)
    w = op.dedupe(works.select("obra", "localidad", "norma_legal", "info_adicional"), ["obra"], [], "first")
    d = op.enrich(d, w, "obra")
    return _with_supplier(_with_descriptions(d, descriptions, siif_desc), suppliers)
