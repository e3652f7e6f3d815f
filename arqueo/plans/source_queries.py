"""Every source reader (S-01..S-40) over tables that are derived from the driver's customers by the sources' schemas.

One rule makes a value of every declared column, once as a Spark column and once as SQL, so that schemas, year filters, own
filters and account mapping of all readers are checked against counts and sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..session import checkpoint_root
from ..sources import io, systems
from ..sources.schemas import SCHEMAS
from ..sources.views import table
from . import withholdings
from .registry import fin, query

YEARS = ["1998", "1999"]
IN_YEARS = "ejercicio IN ('1998', '1999')"

#: Columns whose values the readers look at: the values in turn.
TURNS = {"tipo": ["PA6", "REG", "CYO"], "tipo_comprobante": ["PA6", "CYO"], "cta_contable": ["1112-2-6", "2113-2-9", "2122-1-2"], "origen": ["FUNCIONAMIENTO", "OBRAS", "EPAM"]}

#: Source: reader with its arguments, table, schema, the rows it keeps, and the column that the account map replaces.
Reader = tuple[Callable, dict, str, str, str, str | None]
READERS: dict[str, Reader] = {
    "S-02": (systems.imputation_codes, {}, "sscc_imputaciones", "imputation_codes", "true", None),
    "S-03": (systems.bank_movements, {"years": YEARS, "amap": True}, "banco", "bank", IN_YEARS, "cta_cte"),
    "S-04": (systems.bank_final_balances, {"years": "1998", "amap": True}, "sdo_final_banco", "bank_final_balance", "ejercicio = '1998'", "cta_cte"),
    "S-05": (systems.professional_fees, {"years": YEARS}, "slave", "fees", IN_YEARS, None),
    "S-06": (systems.programs, {}, "icaro_programas", "programs", "true", None),
    "S-07": (systems.subprograms, {}, "icaro_subprogramas", "subprograms", "true", None),
    "S-08": (systems.projects, {}, "icaro_proyectos", "projects", "true", None),
    "S-09": (systems.activities, {}, "icaro_actividades", "activities", "true", None),
    "S-10": (systems.works_loads, {"years": YEARS, "amap": True, "skip_regularisations": True}, "icaro_carga", "works_loads", f"{IN_YEARS} AND tipo <> 'REG'", "cta_cte"),
    "S-11": (systems.works_list, {}, "icaro_obras", "works_list", "true", None),
    "S-12": (systems.works_withholdings, {}, "icaro_retenciones", "works_withholdings", "true", None),
    "S-13": (systems.suppliers, {}, "icaro_proveedores", "suppliers", "true", None),
    "S-14": (systems.floating_debt, {"years": YEARS, "amap": True}, "siif_rdeu012", "floating_debt", IN_YEARS, "cta_cte"),
    "S-15": (systems.floating_debt_treasury, {"month": "04/1998"}, "siif_rdeu012b2_c", "floating_debt", "mes_hasta = '04/1998'", None),
    "S-16": (systems.budget, {"years": YEARS}, "siif_rf602", "budget", IN_YEARS, None),
    "S-17": (systems.budget_form, {"years": YEARS}, "siif_rfp_p605b", "budget", IN_YEARS, None),
    "S-18": (systems.structure_descriptions, {"up_to": "1998"}, "siif_rf610", "structure_desc", "CAST(ejercicio AS INTEGER) <= 1998", None),
    "S-19": (systems.budget_with_descriptions, {"years": YEARS}, "siif_ppto_gtos_desc", "budget", IN_YEARS, None),
    "S-20": (systems.fund_summary_advances, {"years": YEARS}, "siif_rfondo07tp", "fund_summary", f"{IN_YEARS} AND tipo_comprobante = 'PA6'", None),
    "S-21": (systems.expense_vouchers_account, {"years": YEARS, "amap": True}, "siif_rcg01_uejp", "expense_vouchers", IN_YEARS, "cta_cte"),
    "S-22": (systems.expense_vouchers, {"years": YEARS, "amap": True}, "siif_comprobantes_gtos", "expense_vouchers", IN_YEARS, "cta_cte"),
    "S-23": (systems.revenue_vouchers, {"years": YEARS, "amap": True}, "siif_rci02", "revenue_vouchers", IN_YEARS, "cta_cte"),
    "S-24": (systems.revenue_budget, {"years": YEARS}, "siif_ri102", "budget", IN_YEARS, None),
    "S-25": (systems.general_ledger, {"years": YEARS, "account": "2113-2-9"}, "siif_rcocc31", "ledger", f"{IN_YEARS} AND cta_contable = '2113-2-9'", None),
    "S-26": (systems.account_summary, {"years": YEARS}, "siif_rvicon03", "ledger", IN_YEARS, None),
    "S-27": (systems.payment_renditions, {"years": YEARS, "amap": True}, "sgf_resumen_rend_prov", "renditions", IN_YEARS, "cta_cte"),
    "S-28": (lambda spark, root, years, amap: withholdings.renditions_for_withholdings(systems.payment_renditions(spark, root, years), amap), {"years": YEARS, "amap": True},
             "sgf_resumen_rend_prov", "renditions", f"{IN_YEARS} AND origen <> 'FUNCIONAMIENTO'", "cta_cte"),
    "S-29": (systems.fee_renditions, {"years": "1999", "amap": True}, "sgf_resumen_rend_prov", "renditions", "ejercicio = '1999'", "cta_cte"),
    "S-30": (systems.ledger_bank_book, {"years": YEARS, "amap": True}, "siif_rcocc31", "ledger", f"{IN_YEARS} AND cta_contable = '1112-2-6'", "auxiliar_1"),
    "S-31": (systems.new_neighbourhoods, {"up_to": "1998"}, "barrios_nuevos", "new_neighbourhoods", "ejercicio <= '1998'", None),
    "S-32": (systems.billed, {"up_to": "1998"}, "resumen_facturado", "billed", "ejercicio <= '1998'", None),
    "S-33": (systems.collected, {"up_to": "1998"}, "resumen_recaudado", "collected", "ejercicio <= '1998'", None),
    "S-34": (systems.balance_variation, {"up_to": "1998"}, "saldo_barrio_variacion", "balance_variation", "ejercicio <= '1998'", None),
    "S-35": (systems.neighbourhood_balance, {"up_to": "1998"}, "saldo_barrio", "neighbourhood_balance", "ejercicio <= '1998'", None),
    "S-36": (systems.receivable_variation, {"up_to": "1998"}, "saldo_recuperos_cobrar_variacion", "receivable_variation", "ejercicio <= '1998'", None),
    "S-37": (systems.reason_neighbourhood_balance, {"up_to": "1998"}, "saldo_motivo_por_barrio", "reason_neighbourhood_balance", "ejercicio <= '1998'", None),
    "S-38": (systems.reason_balance, {}, "saldo_motivo", "reason_balance", "true", None),
    "S-39": (systems.works_register, {}, "sgo_listado_obras", "works_register", "true", None),
    "S-40": (systems.opening_2008, {"fmt": "parquet"}, "acum_2008", "opening_2008", "true", None),
}


def value(f: T.StructField) -> Column:
    """The value of a declared column for customer ``c_custkey``."""
    k = F.col("c_custkey")
    if f.name == "ejercicio":
        v = F.when(k % 53 > 0, (k % 7 + 1995).cast("string"))
    elif f.name in ("cta_cte", "auxiliar_1"):
        v = F.concat(F.lit("S"), (k % 6).cast("string"))
    elif f.name == "mes_hasta":
        v = F.concat(F.lit("0"), (k % 9 + 1).cast("string"), F.lit("/1998"))
    elif f.name in TURNS:
        v = F.element_at(F.array(*map(F.lit, TURNS[f.name])), (k % len(TURNS[f.name]) + 1).cast("int"))
    elif isinstance(f.dataType, T.StringType):
        v = F.when(k % 9 > 0, F.concat(F.lit(f"{f.name}-"), (k % 9).cast("string")))
    elif isinstance(f.dataType, T.BooleanType):
        v = k % 2 == 0
    elif isinstance(f.dataType, T.DateType):
        v = F.date_add(F.lit("1995-01-01").cast("date"), (k % 2000).cast("int"))
    elif isinstance(f.dataType, T.IntegerType):
        v = k
    else:
        v = F.col("c_acctbal")
    return v.cast(f.dataType).alias(f.name)


def value_sql(f: T.StructField) -> str:
    """The same in SQL, for the columns that the oracle reads."""
    if f.name == "ejercicio":
        return "CASE WHEN c_custkey % 53 > 0 THEN CAST(c_custkey % 7 + 1995 AS VARCHAR) END"
    if f.name in ("cta_cte", "auxiliar_1"):
        return "'S' || c_custkey % 6"
    if f.name == "mes_hasta":
        return "'0' || (c_custkey % 9 + 1) || '/1998'"
    if f.name in TURNS:
        return f"{TURNS[f.name]}[CAST(c_custkey % {len(TURNS[f.name])} + 1 AS INTEGER)]"
    if isinstance(f.dataType, T.StringType):
        return f"CASE WHEN c_custkey % 9 > 0 THEN '{f.name}-' || c_custkey % 9 END"
    return "CAST(c_acctbal AS DECIMAL(18,2))"


def write_all(spark: SparkSession, d: str) -> str:
    """All sources' tables, partitioned by year, and the account map; their folder."""
    root = f"{checkpoint_root(spark).rstrip('/')}/all-sources-{uuid.uuid4().hex}"
    base = table(spark, d, "customer")
    made = {name: base.select(*[value(f) for f in SCHEMAS[schema].fields]) for _, _, name, schema, _, _ in READERS.values()}
    k = F.col("n_nationkey")
    key = F.concat(F.lit("S"), k.cast("string"))
    made["ctas_ctes"] = table(spark, d, "nation").select(F.when(k != 3, F.concat(F.lit("M"), k.cast("string"))).alias("map_to"),
                                                         *[key.alias(f.name) for f in SCHEMAS["account_map"].fields if f.name != "map_to"])
    io.write_tables(made, root)
    return root


def money_of(schema: str) -> str | None:
    return next((f.name for f in SCHEMAS[schema].fields if isinstance(f.dataType, T.DecimalType)), None)


def text_of(schema: str) -> str:
    return next((f.name for f in SCHEMAS[schema].fields if isinstance(f.dataType, T.StringType) and f.name not in ("ejercicio", "cta_cte")), "ejercicio")


def _sql(source: str, reader: Reader) -> str:
    _, _, _, schema, where, mapped = reader
    fields = {f.name: f for f in SCHEMAS[schema].fields}
    money, text = money_of(schema), text_of(schema)
    needed = {money, text, mapped, *(c for c in ("ejercicio", "mes_hasta", *TURNS) if c in fields)} - {None}
    inner = ", ".join(f"{value_sql(fields[c])} AS {c}" for c in sorted(needed))
    account = f"count(CASE WHEN {mapped} <> 'S3' THEN 1 END)" if mapped else "CAST(NULL AS BIGINT)"
    # the text column is the mapped one in none of the schemas
    return (f"SELECT '{source}' AS fuente, count(*) AS n, count({text}) AS n_texto, {account} AS n_cuenta, "
            f"{f'CAST(sum({money}) AS DOUBLE)' if money else 'CAST(NULL AS DOUBLE)'} AS importe FROM (SELECT {inner} FROM customer) WHERE {where}")


@query("s_sources", "\nUNION ALL\n".join([
    "SELECT 'S-01' AS fuente, count(*) AS n, count(CASE WHEN n_nationkey <> 3 THEN 1 END) AS n_texto, CAST(NULL AS BIGINT) AS n_cuenta, CAST(NULL AS DOUBLE) AS importe FROM nation",
    *[_sql(s, r) for s, r in READERS.items()]]))
def s_sources(spark, d):
    """Rows, texts, mapped accounts and amounts of every source, as its reader returns them."""
    root = write_all(spark, d)
    amap = systems.account_map(spark, root)
    none = F.lit(None)
    out = [amap.agg(F.count("*").alias("n"), F.count("map_to").alias("n_texto"), none.cast("long").alias("n_cuenta"), none.cast("double").alias("importe"))
           .select(F.lit("S-01").alias("fuente"), "n", "n_texto", "n_cuenta", "importe")]
    for source, (reader, args, _, schema, _, mapped) in READERS.items():
        df = reader(spark, root, **{k: amap if k == "amap" else v for k, v in args.items()})
        money = money_of(schema)
        out.append(df.agg(F.count("*").alias("n"), F.count(text_of(schema)).alias("n_texto"), (F.count("cta_cte") if mapped else none.cast("long")).alias("n_cuenta"),
                          (F.sum(money) if money else none).cast("double").alias("importe")).select(F.lit(source).alias("fuente"), "n", "n_texto", "n_cuenta", "importe"))
    return fin(op.union_all(*out))
