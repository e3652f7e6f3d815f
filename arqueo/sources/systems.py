"""One reader per source of the accounting systems (S-01..S-40).

Each reads ``<root>/<table>`` (Parquet by default, partitioned by
``ejercicio`` when written by :func:`arqueo.sources.io.write_tables`) with its
declared schema; the year filter is part of the scan, and source-specific
filters and account mapping follow the original loaders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as K
from ..functions.nulls import not_in_keep_null
from ..operators.joins import lookup
from .io import read_source

Years = str | Sequence[str] | None


def _read(spark, root, table, schema, years=None, up_to=None, fmt="parquet"):
    return read_source(spark, schema, f"{root}/{table}", years=years, up_to=up_to, fmt=fmt)


def _map(df: DataFrame, account_map: DataFrame | None, system_col: str) -> DataFrame:
    return df if account_map is None else lookup(df, account_map, "cta_cte", system_col, "map_to")


def account_map(spark: SparkSession, root: str) -> DataFrame:                          # S-01
    return _read(spark, root, "ctas_ctes", "account_map")


def imputation_codes(spark: SparkSession, root: str) -> DataFrame:                     # S-02
    return _read(spark, root, "sscc_imputaciones", "imputation_codes")


def bank_movements(spark, root, years: Years = None, amap: DataFrame | None = None,    # S-03
                   table: str = "banco"):
    return _map(_read(spark, root, table, "bank", years), amap, "sscc_cta_cte")


def bank_final_balances(spark, root, years: Years = None, amap=None,                  # S-04
                        table: str = "sdo_final_banco"):
    return _map(_read(spark, root, table, "bank_final_balance", years), amap, "sscc_cta_cte")


def professional_fees(spark, root, years: Years = None):                               # S-05
    return _read(spark, root, "slave", "fees", years)


def programs(spark, root):                                                              # S-06
    return _read(spark, root, "icaro_programas", "programs")


def subprograms(spark, root):                                                           # S-07
    return _read(spark, root, "icaro_subprogramas", "subprograms")


def projects(spark, root):                                                              # S-08
    return _read(spark, root, "icaro_proyectos", "projects")


def activities(spark, root):                                                            # S-09
    return _read(spark, root, "icaro_actividades", "activities")


def works_loads(spark, root, years: Years = None, amap=None, skip_advances: bool = False,  # S-10
                skip_regularisations: bool = False):
    d = _map(_read(spark, root, "icaro_carga", "works_loads", years), amap, "icaro_cta_cte")
    skip = [t for t, on in ((K.WORKS_ADVANCE_TYPE, skip_advances), (K.WORKS_REGULARISATION_TYPE,
                                                                      skip_regularisations)) if on]
    return d.filter(not_in_keep_null("tipo", skip)) if skip else d


def works_list(spark, root):                                                            # S-11
    return _read(spark, root, "icaro_obras", "works_list")


def works_withholdings(spark, root):                                                    # S-12
    return _read(spark, root, "icaro_retenciones", "works_withholdings")


def suppliers(spark, root):                                                             # S-13
    return _read(spark, root, "icaro_proveedores", "suppliers")


def floating_debt(spark, root, years: Years = None, amap=None):                        # S-14
    # the original sorted by snapshot date; every consumer here orders explicitly
    return _map(_read(spark, root, "siif_rdeu012", "floating_debt", years), amap, "siif_gastos_cta_cte")


def floating_debt_treasury(spark, root, month: str | None = None):                     # S-15
    d = _read(spark, root, "siif_rdeu012b2_c", "floating_debt")
    return d if month is None else d.filter(F.col("mes_hasta") == month)


def budget(spark, root, years: Years = None):                                           # S-16
    return _read(spark, root, "siif_rf602", "budget", years)


def budget_form(spark, root, years: Years = None):                                      # S-17
    return _read(spark, root, "siif_rfp_p605b", "budget", years)


def structure_descriptions(spark, root, up_to: str | None = None):                     # S-18
    return _read(spark, root, "siif_rf610", "structure_desc", up_to=up_to)


def budget_with_descriptions(spark, root, years: Years = None):                         # S-19
    return _read(spark, root, "siif_ppto_gtos_desc", "budget", years)


def fund_summary_advances(spark, root, years: Years = None, voucher_type: str = "PA6"):  # S-20
    return _read(spark, root, "siif_rfondo07tp", "fund_summary", years).filter(
        F.col("tipo_comprobante") == voucher_type)


def expense_vouchers_account(spark, root, years: Years = None, amap=None):              # S-21
    return _map(_read(spark, root, "siif_rcg01_uejp", "expense_vouchers", years), amap, "siif_gastos_cta_cte")


def expense_vouchers(spark, root, years: Years = None, amap=None):                      # S-22
    return _map(_read(spark, root, "siif_comprobantes_gtos", "expense_vouchers", years), amap,
                "siif_gastos_cta_cte")


def revenue_vouchers(spark, root, years: Years = None, amap=None):                      # S-23
    return _map(_read(spark, root, "siif_rci02", "revenue_vouchers", years), amap, "siif_recursos_cta_cte")


def revenue_budget(spark, root, years: Years = None):                                   # S-24
    return _read(spark, root, "siif_ri102", "budget", years)


def general_ledger(spark, root, years: Years = None, account: str | None = None):       # S-25
    d = _read(spark, root, "siif_rcocc31", "ledger", years)
    return d if account is None else d.filter(F.col("cta_contable") == account)


def account_summary(spark, root, years: Years = None):                                  # S-26
    # the original accepted an account argument and never applied it
    return _read(spark, root, "siif_rvicon03", "ledger", years)


def payment_renditions(spark, root, years: Years = None, amap=None):                    # S-27 / S-28
    return _map(_read(spark, root, "sgf_resumen_rend_prov", "renditions", years), amap, "sgf_cta_cte")


def fee_renditions(spark, root, years: Years = None, amap=None):                        # S-29
    return payment_renditions(spark, root, years, amap)


def ledger_bank_book(spark, root, years: Years = None, amap=None):                     # S-30
    d = general_ledger(spark, root, years, "1112-2-6").withColumn("cta_cte", F.col("auxiliar_1"))
    return _map(d, amap, "siif_contabilidad_cta_cte")


def _receivables(spark, root, table, schema, up_to):
    d = _read(spark, root, table, schema)
    # the original compared the year as text ('<='), which equals the integer order for 4-digit years
    return d if up_to is None else d.filter(F.col("ejercicio") <= F.lit(str(up_to)))


def new_neighbourhoods(spark, root, up_to=None):       # S-31
    return _receivables(spark, root, "barrios_nuevos", "new_neighbourhoods", up_to)


def billed(spark, root, up_to=None):                   # S-32
    return _receivables(spark, root, "resumen_facturado", "billed", up_to)


def collected(spark, root, up_to=None):                # S-33
    return _receivables(spark, root, "resumen_recaudado", "collected", up_to)


def balance_variation(spark, root, up_to=None):        # S-34
    return _receivables(spark, root, "saldo_barrio_variacion", "balance_variation", up_to)


def neighbourhood_balance(spark, root, up_to=None):    # S-35
    return _receivables(spark, root, "saldo_barrio", "neighbourhood_balance", up_to)


def receivable_variation(spark, root, up_to=None):     # S-36
    return _receivables(spark, root, "saldo_recuperos_cobrar_variacion", "receivable_variation", up_to)


def reason_neighbourhood_balance(spark, root, up_to=None): # S-37
    return _receivables(spark, root, "saldo_motivo_por_barrio", "reason_neighbourhood_balance", up_to)


def reason_balance(spark, root, up_to=None):           # S-38
    return _receivables(spark, root, "saldo_motivo", "reason_balance", up_to)


def works_register(spark, root):                                                        # S-39
    return _read(spark, root, "sgo_listado_obras", "works_register")


def opening_2008(spark, root, fmt: str = "csv"):                                        # S-40 (re-aimed)
    """The 2008 opening balances, exported from the spreadsheet to CSV/Parquet
    with an explicit ``row_no`` column (row order is data, not file order)."""
    return _read(spark, root, "acum_2008", "opening_2008", fmt=fmt)
