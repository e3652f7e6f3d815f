"""Registered cleaning steps and controls: renditions, vouchers, bank, revenue and budget rows (D-SRC*, D-AE*, D-CH*, D-CE*,
D-EO1..4, D-EG1, D-RM1, D-RC1, D-NET5, D-NET6, D-DIM1, D-RT9, D-RT10) and the plain column operators (P-10, P-16, P-18, T-01).

The oracles are written from the report's definition, not from the code beside them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions.scalars import month_of, year_of
from ..sources.views import MONEY, table
from . import bank, controls, debt, fees, receivables, remainder, sources_clean, withholdings, works
from .domain_queries import RT3_SQL, _loads_with_withholdings
from .ledger_queries import DEBT_SQL, MAJOR_SQL, _debt, _lines, _major, _pick
from .registry import V, fin, query
from .report_queries import LEDGER_SQL, WORKS_BANK_SQL, _ledger_summary, _works_bank

# ---------------------------------------------------------------- views

#: Ledger vouchers: all values that the filters look for, others and NULLs in turn.
VOUCHER_SQL = """
vo AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, strftime(o_orderdate, '%m/%Y') AS mes, CAST(l_orderkey AS VARCHAR) AS nro_comprobante,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS importe, ['421', '422', '354', '355', '384', NULL][CAST(l_partkey % 6 + 1 AS INTEGER)] AS partida,
              ['30632351514', '30500049460', '20231243527', 'otro', NULL][CAST(l_suppkey % 5 + 1 AS INTEGER)] AS cuit, CASE WHEN l_linenumber % 2 = 0 THEN '300' ELSE '400' END AS grupo,
              ['130832-05', '130832-07', '130832-04', NULL][CAST(o_custkey % 4 + 1 AS INTEGER)] AS cta_cte,
              ['HONORARIOS MES', 'RECONOCIMIENTO', 'LOCACION', 'OTRA COSA', NULL][CAST(l_orderkey % 5 + 1 AS INTEGER)] AS glosa,
              CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_orderkey AS VARCHAR) END AS nro_fondo, CASE WHEN l_linenumber < 7 THEN l_linenumber % 3 = 0 END AS es_pagado
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
VOUCHER_COLS = ["ejercicio", "mes", "nro_comprobante", "importe", "partida", "cuit", "grupo", "cta_cte", "glosa", "nro_fondo", "es_pagado"]


def _vouchers(spark, d):
    n = F.col("l_linenumber")
    return _lines(spark, d).select(
        year_of("o_orderdate").alias("ejercicio"), month_of("o_orderdate").alias("mes"), F.col("l_orderkey").cast("string").alias("nro_comprobante"),
        F.col("l_extendedprice").cast(MONEY).alias("importe"), _pick(F.col("l_partkey") % 6, ["421", "422", "354", "355", "384", None]).alias("partida"),
        _pick(F.col("l_suppkey") % 5, ["30632351514", "30500049460", "20231243527", "otro", None]).alias("cuit"), F.when(n % 2 == 0, "300").otherwise("400").alias("grupo"),
        _pick(F.col("o_custkey") % 4, ["130832-05", "130832-07", "130832-04", None]).alias("cta_cte"),
        _pick(F.col("l_orderkey") % 5, ["HONORARIOS MES", "RECONOCIMIENTO", "LOCACION", "OTRA COSA", None]).alias("glosa"),
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_orderkey").cast("string")).alias("nro_fondo"), F.when(n < 7, n % 3 == 0).alias("es_pagado"))


RENDITION_SQL = """
re AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/%Y') AS mes, ['130832-05', '130832-07', '130832-08', '130832-04', NULL][CAST(l_suppkey % 5 + 1 AS INTEGER)] AS cta_cte,
              ['OBRAS', 'FUNCIONAMIENTO', 'EPAM', NULL][CAST(l_partkey % 4 + 1 AS INTEGER)] AS origen,
              ['HONORARIOS - FUNCIONAMIENTO', 'COMISIONES - FUNCIONAMIENTO', 'HONORARIOS - EPAM', 'OTRO DESTINO', NULL][CAST(l_linenumber % 5 + 1 AS INTEGER)] AS destino,
              CASE WHEN l_orderkey % 50 > 0 THEN 'b' || l_orderkey % 50 END AS beneficiario, CAST(l_orderkey % 50 AS VARCHAR) AS cuit, CAST(l_extendedprice AS DECIMAL(18,2)) AS importe_bruto,
              CAST(l_quantity AS DECIMAL(18,2)) AS otras, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS gcias,
              CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) AS importe_neto FROM lineitem)"""
RENDITION_COLS = ["ejercicio", "mes", "cta_cte", "origen", "destino", "beneficiario", "cuit", "importe_bruto", "otras", "gcias", "importe_neto"]


def _rends(spark, d):
    k, gross, few = F.col("l_orderkey") % 50, F.col("l_extendedprice").cast(MONEY), F.col("l_quantity").cast(MONEY)
    return table(spark, d, "lineitem").select(
        year_of("l_shipdate").alias("ejercicio"), month_of("l_shipdate").alias("mes"), _pick(F.col("l_suppkey") % 5, ["130832-05", "130832-07", "130832-08", "130832-04", None]).alias("cta_cte"),
        _pick(F.col("l_partkey") % 4, ["OBRAS", "FUNCIONAMIENTO", "EPAM", None]).alias("origen"),
        _pick(F.col("l_linenumber") % 5, ["HONORARIOS - FUNCIONAMIENTO", "COMISIONES - FUNCIONAMIENTO", "HONORARIOS - EPAM", "OTRO DESTINO", None]).alias("destino"),
        F.when(k > 0, F.concat(F.lit("b"), k.cast("string"))).alias("beneficiario"), k.cast("string").alias("cuit"), gross.alias("importe_bruto"), few.alias("otras"),
        F.when(F.col("l_linenumber") % 2 == 0, few).alias("gcias"), (gross - few).alias("importe_neto"))


MOVES_SQL = """
mv AS (SELECT ejercicio, mes, fecha, libramiento, movimiento, importe, ['049', '031', '018', '004', '102', '062', NULL][CAST(CAST(libramiento AS BIGINT) % 7 + 1 AS INTEGER)] AS cod_imputacion,
              ['130832-05', '130832-08', '130832-04', '10270', 'Macro', NULL][CAST((CAST(libramiento AS BIGINT) // 7) % 6 + 1 AS INTEGER)] AS cta_cte,
              ['PAGO GCIAS', 'RET GANANCIAS', 'SUELDOS', 'TRANSFER', NULL][CAST(CAST(libramiento AS BIGINT) % 5 + 1 AS INTEGER)] AS concepto FROM bank)"""
MOVES_COLS = ["ejercicio", "mes", "fecha", "libramiento", "movimiento", "importe", "cod_imputacion", "cta_cte", "concepto"]
GROUP_SQL = "CASE WHEN cta_cte = '10270' THEN 'FONAVI' WHEN cta_cte IN ('130832-12', '334', 'Macro', 'Patagonia') THEN 'RECUPEROS' ELSE 'OTROS' END AS grupo"


def _moves(spark, d):
    n = F.col("libramiento").cast("long")
    return V(spark, d, "bank").select(
        "ejercicio", "mes", "fecha", "libramiento", "movimiento", "importe", _pick(n % 7, ["049", "031", "018", "004", "102", "062", None]).alias("cod_imputacion"),
        _pick(F.floor(n / 7) % 6, ["130832-05", "130832-08", "130832-04", "10270", "Macro", None]).alias("cta_cte"),
        _pick(n % 5, ["PAGO GCIAS", "RET GANANCIAS", "SUELDOS", "TRANSFER", None]).alias("concepto"))


REVENUE_SQL = """
rv AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, strftime(o_orderdate, '%m/%Y') AS mes, ['10270', '334', 'otra', NULL][CAST(o_custkey % 4 + 1 AS INTEGER)] AS cta_cte,
              ['DEP MACRO', 'OTRO', NULL][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS glosa, CAST(o_totalprice AS DECIMAL(18,2)) AS importe,
              CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 2 = 0 END AS es_propio, CASE WHEN o_orderkey % 11 > 0 THEN o_orderkey % 5 > 0 END AS es_verificado FROM orders)"""


def _revenues(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        year_of("o_orderdate").alias("ejercicio"), month_of("o_orderdate").alias("mes"), _pick(F.col("o_custkey") % 4, ["10270", "334", "otra", None]).alias("cta_cte"),
        _pick(k % 3, ["DEP MACRO", "OTRO", None]).alias("glosa"), F.col("o_totalprice").cast(MONEY).alias("importe"), F.when(k % 7 > 0, k % 2 == 0).alias("es_propio"),
        F.when(k % 11 > 0, k % 5 > 0).alias("es_verificado"))


BUDGET_SQL = """
bu AS (SELECT ejercicio, programa, actividad, partida, fuente, actividad || '-' || coalesce(partida, '000') AS estructura, ordenado, saldo FROM (
  SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, lpad(CAST(l_partkey % 5 AS VARCHAR), 2, '0') AS programa,
         lpad(CAST(l_partkey % 5 AS VARCHAR), 2, '0') || '-00-' || lpad(CAST(l_suppkey % 4 AS VARCHAR), 2, '0') || '-03' AS actividad,
         ['421', '422', '354', '300', NULL][CAST(l_orderkey % 5 + 1 AS INTEGER)] AS partida, ['10', '11', NULL][CAST(l_linenumber % 3 + 1 AS INTEGER)] AS fuente,
         CASE WHEN l_linenumber = 5 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS ordenado, CAST(l_quantity AS DECIMAL(18,2)) AS saldo FROM lineitem)),
de AS (SELECT DISTINCT estructura, 'p ' || programa AS desc_prog, 's' AS desc_subprog, CASE WHEN fuente_min = '10' THEN 'y' END AS desc_proy, 'a ' || estructura AS desc_act
       FROM (SELECT estructura, programa, min(fuente) AS fuente_min FROM bu WHERE ordenado > 100000 GROUP BY ALL)),
da AS (SELECT actividad, 'p ' || programa AS desc_prog, 's' AS desc_subprog, 'y' AS desc_proy, 'a ' || actividad AS desc_act FROM bu WHERE programa <> '02' GROUP BY ALL)"""


def _budget(spark, d):
    n = F.col("l_linenumber")
    two = lambda c, m: F.lpad((F.col(c) % m).cast("string"), 2, "0")
    b = table(spark, d, "lineitem").select(
        year_of("l_shipdate").alias("ejercicio"), two("l_partkey", 5).alias("programa"), F.concat_ws("-", two("l_partkey", 5), F.lit("00"), two("l_suppkey", 4), F.lit("03")).alias("actividad"),
        _pick(F.col("l_orderkey") % 5, ["421", "422", "354", "300", None]).alias("partida"), _pick(n % 3, ["10", "11", None]).alias("fuente"),
        F.when(n == 5, F.lit(0).cast(MONEY)).otherwise(F.col("l_extendedprice").cast(MONEY)).alias("ordenado"), F.col("l_quantity").cast(MONEY).alias("saldo"))
    return b.withColumn("estructura", F.concat("actividad", F.lit("-"), F.coalesce("partida", F.lit("000"))))


def _by_structure(spark, d):
    b = _budget(spark, d).filter("ordenado > 100000").groupBy("estructura", "programa").agg(F.min("fuente").alias("f"))
    return b.select("estructura", F.concat(F.lit("p "), "programa").alias("desc_prog"), F.lit("s").alias("desc_subprog"), F.when(F.col("f") == "10", "y").alias("desc_proy"),
                    F.concat(F.lit("a "), "estructura").alias("desc_act"))


def _by_activity(spark, d):
    return _budget(spark, d).filter("programa != '02'").select(
        "actividad", F.concat(F.lit("p "), "programa").alias("desc_prog"), F.lit("s").alias("desc_subprog"), F.lit("y").alias("desc_proy"), F.concat(F.lit("a "), "actividad").alias("desc_act")).distinct()


def _out(columns: list[str], amounts: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in amounts else c for c in columns)


VOUT, ROUT, MOUT = _out(VOUCHER_COLS, ["importe"]), _out(RENDITION_COLS, ["importe_bruto", "otras", "gcias", "importe_neto"]), _out(MOVES_COLS, ["importe"])

# ---------------------------------------------------------------- cleaned sources (D-SRC2..D-SRC15)


@query("d_src2", f"""
WITH {RENDITION_SQL}, {MOVES_SQL}
SELECT ejercicio, mes, cta_cte, destino, beneficiario, CAST(importe_bruto AS DOUBLE) AS importe_bruto, CAST(otras AS DOUBLE) AS otras, CAST(coalesce(gcias, 0) AS DOUBLE) AS gcias,
       CAST(importe_neto AS DOUBLE) AS importe_neto, CAST(0 AS DOUBLE) AS retenciones FROM re
WHERE origen IS DISTINCT FROM 'OBRAS' AND cta_cte IN ('130832-05', '130832-07') AND destino IN ('HONORARIOS - FUNCIONAMIENTO', 'COMISIONES - FUNCIONAMIENTO', 'HONORARIOS - EPAM')
UNION ALL SELECT ejercicio, mes, cta_cte, 'EMBARGO POR ALIMENTOS', 'EMBARGO POR ALIMENTOS', CAST(-importe AS DOUBLE), CAST(-importe AS DOUBLE), 0, 0, CAST(-importe AS DOUBLE) FROM mv
WHERE cta_cte = '130832-05' AND cod_imputacion = '049'""")
def d_src2(spark, d):
    out = sources_clean.fee_renditions(_rends(spark, d), _moves(spark, d))
    return fin(out.select("ejercicio", "mes", "cta_cte", "destino", "beneficiario", "importe_bruto", "otras", "gcias", "importe_neto", "retenciones"))


@query("d_src3", f"""
WITH {MOVES_SQL} SELECT {MOUT}, {GROUP_SQL} FROM mv
WHERE movimiento = 'DEPOSITO' AND (cod_imputacion IS NULL OR cod_imputacion NOT IN ('034', '004', '214', '215', '003', '055', '005', '013', '018'))""")
def d_src3(spark, d):
    return fin(controls.revenue_deposits(_moves(spark, d)).select(*MOVES_COLS, "grupo"))


@query("d_src3_recuperos", f"""
WITH {MOVES_SQL} SELECT {MOUT} FROM mv
WHERE movimiento = 'DEPOSITO' AND cta_cte = 'Macro' AND (cod_imputacion IS NULL OR cod_imputacion NOT IN ('034', '004', '214', '215', '003', '055', '005', '013', '018'))""")
def d_src3_recuperos(spark, d):
    return fin(controls.receivable_deposits(_moves(spark, d)).select(*MOVES_COLS))


@query("d_src4", f"""
WITH {MOVES_SQL} SELECT * REPLACE (CAST(-importe AS DOUBLE) AS importe) FROM mv
WHERE movimiento IS DISTINCT FROM 'DEPOSITO' AND cta_cte = '130832-04' AND NOT coalesce(contains(concepto, 'GCIAS') OR contains(concepto, 'GANANCIAS'), false)
  AND (cod_imputacion IS NULL OR cod_imputacion NOT IN ('034', '004', '003', '055', '005', '013'))""")
def d_src4(spark, d):
    return fin(controls.bank_payroll(_moves(spark, d)))


@query("d_src5", f"WITH {MOVES_SQL} SELECT * REPLACE (CAST(-importe AS DOUBLE) AS importe) FROM mv WHERE movimiento IS DISTINCT FROM 'DEPOSITO'")
def d_src5(spark, d):
    return fin(sources_clean.bank_payments(_moves(spark, d)))


@query("d_src6", f"""
WITH {REVENUE_SQL}, x AS (SELECT * REPLACE (CASE WHEN contains(glosa, 'MACRO') THEN 'Macro' ELSE cta_cte END AS cta_cte) FROM rv WHERE es_verificado)
SELECT * REPLACE (CAST(importe AS DOUBLE) AS importe), {GROUP_SQL} FROM x""")
def d_src6(spark, d):
    return fin(controls.verified_revenue(_revenues(spark, d)))


@query("d_src7", f"""
WITH {VOUCHER_SQL} SELECT {VOUT} FROM vo
WHERE partida IN ('421', '422') OR partida = '354' AND (cuit IS NULL OR cuit NOT IN ('30500049460', '30632351514', '20231243527'))""")
def d_src7(spark, d):
    return fin(controls.ledger_works_vouchers(_vouchers(spark, d)))


@query("d_src8", f"""
WITH {BUDGET_SQL} SELECT * REPLACE (CAST(ordenado AS DOUBLE) AS ordenado, CAST(saldo AS DOUBLE) AS saldo) FROM bu WHERE partida IN ('421', '422') OR estructura = '01-00-00-03-354'""")
def d_src8(spark, d):
    return fin(controls.ledger_works_budget(_budget(spark, d)))


@query("d_src9", f"""
WITH {VOUCHER_SQL} SELECT {VOUT} FROM vo
WHERE cuit = '30632351514' AND grupo = '300' AND partida IS DISTINCT FROM '384' AND cta_cte IN ('130832-05', '130832-07')
  AND (contains(glosa, 'HONOR') OR contains(glosa, 'RECON') OR contains(glosa, 'LOC'))""")
def d_src9(spark, d):
    return fin(fees.fee_vouchers(_vouchers(spark, d)))


@query("d_src10", f"""
WITH {VOUCHER_SQL}, {MOVES_SQL}
SELECT 'siif' AS lado, ejercicio, mes, cta_cte, CAST(importe AS DOUBLE) AS importe FROM vo WHERE partida = '355'
UNION ALL SELECT 'sscc', ejercicio, mes, cta_cte, CAST(-importe AS DOUBLE) FROM mv WHERE cod_imputacion = '031'""")
def d_src10(spark, d):
    a, b = fees.bank_debit_vouchers(_vouchers(spark, d)), fees.bank_debits(_moves(spark, d))
    return fin(op.union_all(*(x.select(F.lit(n).alias("lado"), "ejercicio", "mes", "cta_cte", "importe") for n, x in (("siif", a), ("sscc", b)))))


@query("d_src12", f"""
WITH {RENDITION_SQL} SELECT {ROUT} FROM re
WHERE origen IS DISTINCT FROM 'FUNCIONAMIENTO' AND (origen IS DISTINCT FROM 'EPAM' OR NOT coalesce(contains(destino, 'HONORARIOS'), false))""")
def d_src12(spark, d):
    return fin(controls.works_renditions(_rends(spark, d)))


@query("d_src13", f"WITH {VOUCHER_SQL} SELECT {VOUT} FROM vo WHERE nro_fondo IS NOT NULL AND cta_cte = '130832-05'")
def d_src13(spark, d):
    return fin(sources_clean.permanent_fund_vouchers(_vouchers(spark, d)))


@query("d_src15", f"""
WITH {MOVES_SQL}
SELECT {MOUT}, CASE cod_imputacion WHEN '049' THEN 'tipo 1' WHEN '031' THEN 'tipo 2' END AS tipo FROM mv""")
def d_src15(spark, d):
    codes = table(spark, d, "region").filter("r_regionkey < 3").select(_pick(F.col("r_regionkey"), ["049", "031", "999"]).alias("cod_imputacion"),
                                                                      F.concat(F.lit("tipo "), (F.col("r_regionkey") + 1).cast("string")).alias("tipo"))
    return fin(bank.bank_with_imputation_type(_moves(spark, d), codes).select(*MOVES_COLS, "tipo"))


@query("d_src15_libro", f"""
WITH {MAJOR_SQL} SELECT ejercicio, nro_entrada, tipo_comprobante, CAST(saldo AS DOUBLE) AS saldo FROM gl WHERE tipo_comprobante IS DISTINCT FROM 'ANP'""")
def d_src15_libro(spark, d):
    return fin(bank.ledger_bank_without_advances(_major(spark, d), advance_type="ANP").select("ejercicio", "nro_entrada", "tipo_comprobante", "saldo"))


# ---------------------------------------------------------------- debt views (D-NET5, D-NET6)


@query("d_net5", f"WITH {DEBT_SQL} SELECT ejercicio, nro_comprobante, nro_origen, cuit, CAST(saldo AS DOUBLE) AS saldo FROM rdeu WHERE mes_hasta = '12/2012'")
def d_net5(spark, d):
    return fin(remainder.treasury_debt(_debt(spark, d), "2012").select("ejercicio", "nro_comprobante", "nro_origen", "cuit", "saldo"))


@query("d_net6", f"""
WITH {MAJOR_SQL} SELECT ejercicio, nro_original, nro_entrada, tipo_comprobante, cta_contable, CAST(saldo AS DOUBLE) AS saldo_contable FROM gl
WHERE ejercicio = '2012' AND starts_with(cta_contable, '2') AND tipo_comprobante IN ('CAO', 'CAP', 'CAM', 'CAD', 'ANP', 'AJU')""")
def d_net6(spark, d):
    return fin(debt.liabilities(_major(spark, d), "2012").select("ejercicio", "nro_original", "nro_entrada", "tipo_comprobante", "cta_contable", "saldo_contable"))


# ---------------------------------------------------------------- the 3 % contribution (D-AE1..D-AE3)

#: Ledger with entries on several bank lines, some entries without one, opening entries.
CONTRIBUTION_SQL = f"""
{REVENUE_SQL.strip()},
lc AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, strftime(o_orderdate, '%m/%Y') AS mes, CAST(l_orderkey % 4000 AS VARCHAR) AS nro_entrada,
              ['1112-2-6', '2122-1-2', '2113-2-9'][CAST(l_linenumber % 3 + 1 AS INTEGER)] AS cta_contable, ['APE', 'CAP', NULL][CAST(l_partkey % 3 + 1 AS INTEGER)] AS tipo_comprobante,
              CASE l_linenumber % 3 WHEN 0 THEN ['10270', '334', 'otra'][CAST(o_custkey % 3 + 1 AS INTEGER)] WHEN 1 THEN ['337', '245'][CAST(l_suppkey % 2 + 1 AS INTEGER)] ELSE 'x' END AS auxiliar_1,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS debitos, CAST(l_quantity AS DECIMAL(18,2)) AS creditos FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ae1 AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS r FROM rv WHERE es_propio AND es_verificado AND cta_cte IS NOT NULL GROUP BY ALL),
bn AS (SELECT ejercicio, nro_entrada, min(auxiliar_1) AS cta_cte FROM lc WHERE cta_contable = '1112-2-6' AND tipo_comprobante IS DISTINCT FROM 'APE' GROUP BY ALL),
ae2 AS (SELECT lc.ejercicio, mes, cta_cte, sum(debitos) AS p, sum(creditos) AS g FROM lc LEFT JOIN bn ON bn.ejercicio = lc.ejercicio AND bn.nro_entrada = lc.nro_entrada
        WHERE cta_contable = '2122-1-2' AND tipo_comprobante IS DISTINCT FROM 'APE' AND auxiliar_1 = '337' GROUP BY ALL)"""


def _contribution_ledger(spark, d):
    n = F.col("l_linenumber") % 3
    return _lines(spark, d).select(
        year_of("o_orderdate").alias("ejercicio"), month_of("o_orderdate").alias("mes"), F.to_date("o_orderdate").alias("fecha"), (F.col("l_orderkey") % 4000).cast("string").alias("nro_entrada"),
        _pick(n, ["1112-2-6", "2122-1-2", "2113-2-9"]).alias("cta_contable"), _pick(F.col("l_partkey") % 3, ["APE", "CAP", None]).alias("tipo_comprobante"),
        F.when(n == 0, _pick(F.col("o_custkey") % 3, ["10270", "334", "otra"])).when(n == 1, _pick(F.col("l_suppkey") % 2, ["337", "245"])).otherwise("x").alias("auxiliar_1"),
        F.col("l_extendedprice").cast(MONEY).alias("debitos"), F.col("l_quantity").cast(MONEY).alias("creditos"))


@query("d_ae1", f'WITH {CONTRIBUTION_SQL} SELECT ejercicio, mes, cta_cte, CAST(r AS DOUBLE) AS "recurso_3%" FROM ae1')
def d_ae1(spark, d):
    return fin(fees.contribution_revenue(_revenues(spark, d)))


@query("d_ae2", f"""
WITH {CONTRIBUTION_SQL} SELECT ejercicio, mes, cta_cte, CAST(p AS DOUBLE) AS pagos_337_siif, CAST(g AS DOUBLE) AS gastos_337_siif FROM ae2 WHERE cta_cte IS NOT NULL""")
def d_ae2(spark, d):
    return fin(fees.contribution_withholdings(_contribution_ledger(spark, d), keys=["ejercicio", "mes", "cta_cte"]))


@query("d_ae3", f"""
WITH {CONTRIBUTION_SQL},
b AS (SELECT * FROM ae2 WHERE cta_cte IS NOT NULL)
SELECT ejercicio, mes, cta_cte, CAST(coalesce(r, 0) AS DOUBLE) AS "recurso_3%", CAST(coalesce(p, 0) AS DOUBLE) AS pagos_337_siif FROM ae1 FULL JOIN b USING (ejercicio, mes, cta_cte)""")
def d_ae3(spark, d):
    keys = ["ejercicio", "mes", "cta_cte"]
    return fin(fees.contribution_control(fees.contribution_revenue(_revenues(spark, d)), fees.contribution_withholdings(_contribution_ledger(spark, d), keys=keys), keys))


# ---------------------------------------------------------------- fees (D-SRC14, D-CH1..D-CH3)

#: Professional fees: vouchers of the ledger, others, some of the ledger system's own ('SIIF'); several columns missing.
FEE_SQL = f"""
{VOUCHER_SQL.strip()},
fe AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/%Y') AS mes,
              CASE WHEN l_orderkey % 13 = 0 THEN 'SIIF ' || l_orderkey WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS nro_comprobante, 'p' || l_suppkey % 30 AS razon_social,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS importe_bruto, CAST(l_quantity AS DECIMAL(18,2)) AS iibb, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS sellos,
              CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS lp, CAST(1 AS DECIMAL(18,2)) AS seguro, CASE WHEN l_linenumber > 3 THEN CAST(2 AS DECIMAL(18,2)) END AS anticipo
       FROM lineitem WHERE l_linenumber < 6),
ac AS (SELECT ejercicio, nro_comprobante, min(cta_cte) AS cta_cte FROM vo GROUP BY ALL),
s14 AS (SELECT fe.ejercicio, mes, fe.nro_comprobante, cta_cte, razon_social AS beneficiario, importe_bruto, iibb, coalesce(sellos, 0) AS sellos, coalesce(lp, 0) AS lp, seguro, coalesce(anticipo, 0) AS anticipo
        FROM fe LEFT JOIN ac ON ac.ejercicio = fe.ejercicio AND ac.nro_comprobante = fe.nro_comprobante WHERE NOT coalesce(contains(fe.nro_comprobante, 'SIIF'), false))"""


def _fees(spark, d):
    k, n, few = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity").cast(MONEY)
    number = F.when(k % 13 == 0, F.concat(F.lit("SIIF "), k.cast("string"))).when(k % 17 != 0, k.cast("string"))
    own = table(spark, d, "lineitem").filter(n < 6).select(
        year_of("l_shipdate").alias("ejercicio"), month_of("l_shipdate").alias("mes"), number.alias("nro_comprobante"), F.concat(F.lit("p"), (F.col("l_suppkey") % 30).cast("string")).alias("razon_social"),
        F.col("l_extendedprice").cast(MONEY).alias("importe_bruto"), few.alias("iibb"), F.when(n % 2 == 0, few).alias("sellos"), F.when(n % 3 == 0, few).alias("lp"),
        F.lit(1).cast(MONEY).alias("seguro"), F.when(n > 3, F.lit(2).cast(MONEY)).alias("anticipo"))
    return fees.fees_with_account(own, _vouchers(spark, d))


S14_COLS = ["ejercicio", "mes", "nro_comprobante", "cta_cte", "beneficiario", "importe_bruto", "iibb", "sellos", "lp", "seguro", "anticipo"]


@query("d_src14", f"WITH {FEE_SQL} SELECT {_out(S14_COLS, S14_COLS[5:])} FROM s14")
def d_src14(spark, d):
    return fin(_fees(spark, d).select(*S14_COLS))


@query("d_ch1", f"""
WITH {FEE_SQL}
SELECT ejercicio, mes, nro_comprobante, cta_cte, CAST(sum(importe_bruto) AS DOUBLE) AS importe_bruto, CAST(sum(iibb) AS DOUBLE) AS iibb, CAST(sum(sellos + lp) AS DOUBLE) AS sellos,
       CAST(sum(seguro) AS DOUBLE) AS seguro, CAST(sum(anticipo) AS DOUBLE) AS otras, CAST(sum(iibb + sellos + lp + seguro + anticipo) AS DOUBLE) AS retenciones,
       CAST(sum(importe_bruto - iibb - sellos - lp - seguro - anticipo) AS DOUBLE) AS importe_neto
FROM s14 WHERE nro_comprobante IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL""")
def d_ch1(spark, d):
    return fin(fees.fees_summary(_fees(spark, d)))


@query("d_ch2", f"""
WITH {VOUCHER_SQL}
SELECT ejercicio, mes, nro_comprobante, cta_cte, CAST(sum(importe) AS DOUBLE) AS importe, CAST(coalesce(sum(CAST(es_pagado AS INTEGER)), 0) AS BIGINT) AS es_pagado FROM vo
WHERE cuit = '30632351514' AND grupo = '300' AND partida IS DISTINCT FROM '384' AND cta_cte IN ('130832-05', '130832-07')
  AND (contains(glosa, 'HONOR') OR contains(glosa, 'RECON') OR contains(glosa, 'LOC')) GROUP BY ALL""")
def d_ch2(spark, d):
    return fin(fees.fee_vouchers_summary(fees.fee_vouchers(_vouchers(spark, d))))


@query("d_ch2_rendido", f"""
WITH {RENDITION_SQL}
SELECT ejercicio, mes, cuit, beneficiario, CAST(sum(importe_bruto) AS DOUBLE) AS importe_bruto, CAST(sum(importe_neto) AS DOUBLE) AS importe_neto, CAST(sum(otras + coalesce(gcias, 0)) AS DOUBLE) AS otras
FROM re WHERE beneficiario IS NOT NULL GROUP BY ALL""")
def d_ch2_rendido(spark, d):
    return fin(fees.fee_renditions_summary(_rends(spark, d)))


@query("d_ch3", f"""
WITH {FEE_SQL},
a AS (SELECT ejercicio, nro_comprobante AS nro, sum(importe) AS importe, min(mes) AS mes, min(cta_cte) AS cta_cte FROM vo WHERE grupo = '300' GROUP BY ALL),
b AS (SELECT ejercicio, nro_comprobante AS nro, sum(importe_bruto) AS importe, min(mes) AS mes, min(cta_cte) AS cta_cte FROM s14 GROUP BY ALL),
m AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, a.nro AS siif_nro, b.nro AS slave_nro, coalesce(a.importe, 0) AS siif_importe, coalesce(b.importe, 0) AS slave_importe,
             a.mes AS siif_mes, b.mes AS slave_mes, a.cta_cte AS siif_cta_cte, b.cta_cte AS slave_cta_cte FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.nro = b.nro),
f AS (SELECT *, siif_nro IS DISTINCT FROM slave_nro AS err_nro, abs(siif_importe - slave_importe) > 1e-8 AS err_importe, siif_mes IS DISTINCT FROM slave_mes AS err_mes,
             siif_cta_cte IS DISTINCT FROM slave_cta_cte AS err_cta_cte FROM m)
SELECT * REPLACE (CAST(siif_importe AS DOUBLE) AS siif_importe, CAST(slave_importe AS DOUBLE) AS slave_importe) FROM f WHERE err_nro OR err_importe OR err_mes OR err_cta_cte""")
def d_ch3(spark, d):
    return fin(fees.ledger_vs_fees(_vouchers(spark, d).filter("grupo = '300'"), _fees(spark, d)))


# ---------------------------------------------------------------- notaries (D-SRC11, D-CE1, D-CE2)


@query("d_ce1", f"""
WITH {CONTRIBUTION_SQL}
SELECT ejercicio, mes, auxiliar_1 AS cuit, CAST(sum(creditos) AS DOUBLE) AS carga_fei, CAST(sum(debitos) AS DOUBLE) AS pagos_fei, CAST(sum(creditos - debitos) AS DOUBLE) AS fei_impagos
FROM lc WHERE cta_contable = '2113-2-9' AND tipo_comprobante IS DISTINCT FROM 'APE' GROUP BY ALL""")
def d_ce1(spark, d):
    return fin(fees.notary_ledger_summary(fees.notary_ledger(_contribution_ledger(spark, d))))


@query("d_src11", f"""
WITH {CONTRIBUTION_SQL}
SELECT ejercicio, mes, nro_entrada, auxiliar_1 AS cuit, CAST(creditos AS DOUBLE) AS carga_fei, CAST(debitos AS DOUBLE) AS pagos_fei, CAST(creditos - debitos AS DOUBLE) AS fei_impagos
FROM lc WHERE cta_contable = '2113-2-9' AND tipo_comprobante IS DISTINCT FROM 'APE'""")
def d_src11(spark, d):
    return fin(fees.notary_ledger(_contribution_ledger(spark, d)).select("ejercicio", "mes", "nro_entrada", "cuit", "carga_fei", "pagos_fei", "fei_impagos"))


NOTARY_SIDES_SQL = f"""
{RENDITION_SQL.strip()}, {MOVES_SQL.strip()},
nr AS (SELECT ejercicio, mes, sum(importe_neto) AS importe_neto FROM re WHERE cta_cte = '130832-08' GROUP BY ALL),
nb AS (SELECT ejercicio, mes, sum(-importe) AS importe_neto FROM mv WHERE cta_cte = '130832-08' AND (cod_imputacion IS NULL OR cod_imputacion NOT IN ('004', '034', '213', '102')) GROUP BY ALL)"""


@query("d_ce1_lados", f"""
WITH {NOTARY_SIDES_SQL} SELECT 'sgf' AS lado, ejercicio, mes, CAST(importe_neto AS DOUBLE) AS importe_neto FROM nr UNION ALL SELECT 'sscc', ejercicio, mes, CAST(importe_neto AS DOUBLE) FROM nb""")
def d_ce1_lados(spark, d):
    keys = ["ejercicio", "mes"]
    sides = (("sgf", fees.notary_renditions_summary(_rends(spark, d), keys)), ("sscc", fees.notary_bank_summary(_moves(spark, d), keys)))
    return fin(op.union_all(*(x.select(F.lit(n).alias("lado"), *keys, F.col("importe_neto").cast("double").alias("importe_neto")) for n, x in sides)))


@query("d_ce2", f"""
WITH {NOTARY_SIDES_SQL}
SELECT ejercicio, mes, CAST(coalesce(nr.importe_neto, 0) - coalesce(nb.importe_neto, 0) AS DOUBLE) AS importe_neto FROM nr FULL JOIN nb USING (ejercicio, mes)""")
def d_ce2(spark, d):
    keys = ["ejercicio", "mes"]
    return fin(fees.notary_renditions_vs_bank(fees.notary_renditions_summary(_rends(spark, d), keys), fees.notary_bank_summary(_moves(spark, d), keys), keys))


# ---------------------------------------------------------------- withholdings between systems (D-RT9, D-RT10)


@query("d_rt9", f"""
WITH {RT3_SQL.strip()}, {LEDGER_SQL.strip()}
SELECT ejercicio, mes, cta_cte, CAST(0 AS DOUBLE) AS "A", CAST(0 AS DOUBLE) AS "N", CAST(0 AS DOUBLE) AS "R", CAST(rt3.retenciones - coalesce(rt6.retenciones, 0) AS DOUBLE) AS retenciones,
       CAST(rt3.importe_bruto - coalesce(rt6.importe_bruto, 0) AS DOUBLE) AS importe_bruto, CAST(rt3.importe_neto - coalesce(rt6.importe_neto, 0) AS DOUBLE) AS importe_neto
FROM rt3 LEFT JOIN rt6 USING (ejercicio, mes, cta_cte)""")
def d_rt9(spark, d):
    return fin(withholdings.compare(withholdings.loads_summary(_loads_with_withholdings(spark, d)), _ledger_summary(spark, d)))


@query("d_rt10", f"""
WITH {WORKS_BANK_SQL},
sg AS (SELECT ejercicio, mes, cta_cte, sum(importe_bruto) AS importe_bruto, sum(importe_neto) AS importe_neto, sum(retenciones) AS retenciones FROM payments
       WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL)
SELECT ejercicio, mes, cta_cte, CAST(sg.importe_bruto - coalesce(rt8.importe_bruto, 0) AS DOUBLE) AS importe_bruto, CAST(sg.importe_neto - coalesce(rt8.importe_neto, 0) AS DOUBLE) AS importe_neto,
       CAST(sg.retenciones - coalesce(rt8.retenciones, 0) AS DOUBLE) AS retenciones FROM sg LEFT JOIN rt8 USING (ejercicio, mes, cta_cte)""")
def d_rt10(spark, d):
    return fin(withholdings.compare(withholdings.renditions_summary(V(spark, d, "payments")), withholdings.bank_summary(_works_bank(spark, d))))


# ---------------------------------------------------------------- budget with descriptions (D-EG1, D-EO1, D-EO2, D-RM1)

DESC = ["desc_prog", "desc_subprog", "desc_proy", "desc_act"]


@query("d_eg1", f"""
WITH {BUDGET_SQL}
SELECT ejercicio, bu.estructura, partida, fuente, desc_prog, desc_subprog, desc_proy, desc_act, CAST(programa AS INTEGER) AS programa, CAST(ordenado AS DOUBLE) AS ordenado, CAST(saldo AS DOUBLE) AS saldo
FROM bu LEFT JOIN de ON de.estructura = bu.estructura WHERE ejercicio IN ('1997', '1999')""")
def d_eg1(spark, d):
    out = sources_clean.expense_execution(_budget(spark, d), _by_structure(spark, d), years=["1997", "1999"])
    return fin(out.select("ejercicio", "estructura", "partida", "fuente", *DESC, "programa", "ordenado", "saldo"))


@query("d_eo1", f"""
WITH {BUDGET_SQL}
SELECT bu.estructura, partida, fuente, desc_prog, desc_subprog, desc_proy, desc_act, CAST(ordenado AS DOUBLE) AS ordenado, CAST(saldo AS DOUBLE) AS saldo
FROM bu LEFT JOIN de ON de.estructura = bu.estructura WHERE ejercicio = '1999' AND partida IN ('421', '422')""")
def d_eo1(spark, d):
    return fin(sources_clean.works_execution(_budget(spark, d), _by_structure(spark, d), years=["1998", "1999"], current_only="1999"))


@query("d_eo2", f"""
WITH {BUDGET_SQL}
SELECT bu.actividad AS estructura, partida, fuente, desc_prog AS prog_con_desc, desc_proy AS proy_con_desc, desc_act AS act_con_desc, CAST(ordenado AS DOUBLE) AS ordenado, CAST(saldo AS DOUBLE) AS saldo
FROM bu LEFT JOIN da ON da.actividad = bu.actividad WHERE partida IN ('421', '422') AND ordenado > 0""")
def d_eo2(spark, d):
    return fin(sources_clean.works_execution_icaro_desc(_budget(spark, d), _by_activity(spark, d)))


@query("d_rm1", f"""
WITH {BUDGET_SQL}
SELECT ejercicio, bu.actividad AS estructura, partida, fuente, desc_prog AS prog_con_desc, desc_act AS act_con_desc, CAST(ordenado AS DOUBLE) AS ordenado, CAST(saldo AS DOUBLE) AS saldo,
       CAST(0 AS DOUBLE) AS remte, CAST(saldo AS DOUBLE) AS saldo_remte, CAST(NULL AS VARCHAR) AS cc_remte
FROM bu LEFT JOIN da ON da.actividad = bu.actividad WHERE partida IN ('421', '422') AND fuente IS DISTINCT FROM '11'""")
def d_rm1(spark, d):
    out = remainder.worksheet(_budget(spark, d), _by_activity(spark, d))
    return fin(out.select("ejercicio", "estructura", "partida", "fuente", "prog_con_desc", "act_con_desc", "ordenado", "saldo", "remte", "saldo_remte", "cc_remte"))


# ---------------------------------------------------------------- loads with descriptions (D-EO3, D-EO4)

#: Loads of works with a supplier (several names per tax id, some unknown), budget descriptions by structure, towns by work.
LOADS_DESC_SQL = """
ld AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, CAST(l_orderkey AS VARCHAR) AS nro, ['PA6', 'REG', 'CYO', NULL][CAST(l_orderkey % 4 + 1 AS INTEGER)] AS tipo,
              CASE WHEN l_partkey % 3 = 0 THEN '29-' ELSE '11-' END || l_partkey % 7 AS actividad, ['421', '422', '354', NULL][CAST(l_linenumber % 4 + 1 AS INTEGER)] AS partida,
              CAST(l_suppkey AS VARCHAR) AS cuit, 'obra ' || l_partkey % 40 AS obra, CAST(l_extendedprice AS DECIMAL(18,2)) AS importe FROM lineitem),
ds AS (SELECT DISTINCT actividad || '-' || partida AS estructura, 'd ' || actividad AS desc_act FROM ld WHERE partida = '421'),
sp AS (SELECT CAST(s_suppkey AS VARCHAR) AS cuit, s_name AS proveedor FROM supplier WHERE s_suppkey % 5 > 0)"""


def _loads_desc(spark, d):
    p = F.col("l_partkey")
    return table(spark, d, "lineitem").select(
        year_of("l_shipdate").alias("ejercicio"), F.col("l_orderkey").cast("string").alias("nro"), _pick(F.col("l_orderkey") % 4, ["PA6", "REG", "CYO", None]).alias("tipo"),
        F.concat(F.when(p % 3 == 0, "29-").otherwise("11-"), (p % 7).cast("string")).alias("actividad"), _pick(F.col("l_linenumber") % 4, ["421", "422", "354", None]).alias("partida"),
        F.col("l_suppkey").cast("string").alias("cuit"), F.concat(F.lit("obra "), (p % 40).cast("string")).alias("obra"), F.col("l_extendedprice").cast(MONEY).alias("importe"))


def _descs(spark, d):
    return _loads_desc(spark, d).filter("partida = '421'").select(F.concat("actividad", F.lit("-"), "partida").alias("estructura"), F.concat(F.lit("d "), "actividad").alias("desc_act")).distinct()


def _suppliers(spark, d):
    return table(spark, d, "supplier").filter("s_suppkey % 5 > 0").select(F.col("s_suppkey").cast("string").alias("cuit"), F.col("s_name").alias("desc_prov"))


@query("d_eo3", f"""
WITH {LOADS_DESC_SQL}
SELECT ejercicio, nro, tipo, actividad, partida, ld.cuit, obra, CAST(importe AS DOUBLE) AS importe, desc_act, proveedor
FROM ld LEFT JOIN ds ON ds.estructura = actividad || '-' || partida LEFT JOIN sp ON sp.cuit = ld.cuit
WHERE tipo IS DISTINCT FROM 'PA6' AND CAST(ejercicio AS INTEGER) <= 1999 AND partida IN ('421', '422')""")
def d_eo3(spark, d):
    out = sources_clean.loads_with_descriptions(_loads_desc(spark, d), _descs(spark, d), _suppliers(spark, d), up_to_year="1999")
    return fin(out.select("ejercicio", "nro", "tipo", "actividad", "partida", "cuit", "obra", "importe", "desc_act", "proveedor"))


@query("d_eo3_caja", f"""
WITH {LOADS_DESC_SQL}
SELECT ejercicio, nro, tipo, actividad, partida, ld.cuit, obra, CAST(importe AS DOUBLE) AS importe, desc_act, proveedor
FROM ld LEFT JOIN ds ON ds.estructura = actividad || '-' || partida LEFT JOIN sp ON sp.cuit = ld.cuit
WHERE tipo IS DISTINCT FROM 'REG' AND ejercicio IN ('1996', '2000') AND partida IN ('421', '422')""")
def d_eo3_caja(spark, d):
    out = sources_clean.loads_with_descriptions(_loads_desc(spark, d), _descs(spark, d), _suppliers(spark, d), cash_basis=True, years=["1996", "2000"])
    return fin(out.select("ejercicio", "nro", "tipo", "actividad", "partida", "cuit", "obra", "importe", "desc_act", "proveedor"))


@query("d_eo4", f"""
WITH {LOADS_DESC_SQL},
ob AS (SELECT 'obra ' || p_partkey % 60 AS obra, min(p_brand) AS localidad FROM part WHERE p_partkey % 60 % 3 > 0 GROUP BY 1)
SELECT ejercicio, nro, tipo, actividad, partida, ld.cuit, ld.obra, localidad, CAST(importe AS DOUBLE) AS importe, desc_act, proveedor
FROM ld LEFT JOIN ds ON ds.estructura = actividad || '-' || partida LEFT JOIN sp ON sp.cuit = ld.cuit LEFT JOIN ob ON ob.obra = ld.obra
WHERE tipo IS DISTINCT FROM 'PA6' AND CAST(ejercicio AS INTEGER) <= 1998 AND starts_with(actividad, '29')""")
def d_eo4(spark, d):
    k = F.col("p_partkey") % 60
    towns = table(spark, d, "part").filter(k % 3 > 0).groupBy(F.concat(F.lit("obra "), k.cast("string")).alias("obra")).agg(F.min("p_brand").alias("localidad"))
    towns = towns.withColumns({"norma_legal": F.lit("n"), "info_adicional": F.lit("i")})
    out = sources_clean.basic_module_loads(_loads_desc(spark, d), towns, _descs(spark, d), _suppliers(spark, d), up_to_year="1998")
    return fin(out.select("ejercicio", "nro", "tipo", "actividad", "partida", "cuit", "obra", "localidad", "importe", "desc_act", "proveedor"))


# ---------------------------------------------------------------- descriptions and receivables (D-DIM1, D-RC1)


@query("d_dim1", """
WITH a AS (SELECT DISTINCT p_partkey % 4 AS p, p_partkey % 6 AS s, p_partkey % 10 AS y, p_partkey % 30 AS k FROM part),
x AS (SELECT lpad(CAST(p AS VARCHAR), 2, '0') || '-' || lpad(CAST(s AS VARCHAR), 2, '0') || '-' || lpad(CAST(y AS VARCHAR), 2, '0') || '-' || lpad(CAST(k AS VARCHAR), 2, '0') AS actividad, * FROM a)
SELECT actividad, CASE WHEN p > 0 AND y <> 3 THEN substr(actividad, 1, 2) || ' - prog ' || p END AS desc_prog, CASE WHEN s < 5 AND y <> 3 THEN substr(actividad, 4, 2) || ' - sub ' || s ELSE substr(actividad, 4, 2) || ' - ' END AS desc_subprog,
       CASE WHEN y <> 3 THEN substr(actividad, 7, 2) || ' - proy ' || y END AS desc_proy, substr(actividad, 10, 2) || ' - act ' || k AS desc_act FROM x""")
def d_dim1(spark, d):
    k = F.col("p_partkey")
    two = lambda m: F.lpad((k % m).cast("string"), 2, "0")
    named = lambda text, m: F.concat(F.lit(f"{text} "), (k % m).cast("string"))
    parts = table(spark, d, "part")
    # levels are keyed by their full codes, so that a missing project cuts off what is above it
    sub, proy = F.concat_ws("-", two(4), two(6)), F.concat_ws("-", two(4), two(6), two(10))
    acts = parts.select(F.concat_ws("-", two(4), two(6), two(10), two(30)).alias("actividad"), proy.alias("proyecto"), named("act", 30).alias("desc_act")).distinct()
    projects = parts.filter(k % 10 != 3).select(proy.alias("proyecto"), sub.alias("subprograma"), named("proy", 10).alias("desc_proy")).distinct()
    subs = parts.select(sub.alias("subprograma"), two(4).alias("programa"), F.when(k % 6 < 5, named("sub", 6)).alias("desc_subprog")).distinct()
    programs = parts.filter(k % 4 > 0).select(two(4).alias("programa"), named("prog", 4).alias("desc_prog")).distinct()
    return works.works_descriptions(programs, subs, projects, acts)


CLOSING_SQL = ", ".join(f"'{c}'" for c in receivables.OPENING_CLOSING)


@query("d_rc1", f"""
WITH v AS (SELECT ejercicio, [{CLOSING_SQL}, 'OTRO', NULL][CAST(CAST(nro_comprobante AS BIGINT) % {len(receivables.OPENING_CLOSING) + 2} + 1 AS INTEGER)] AS concepto, importe FROM loads)
SELECT ejercicio, concepto, CAST(importe AS DOUBLE) AS importe FROM v WHERE concepto IN ({CLOSING_SQL})""")
def d_rc1(spark, d):
    names = [*receivables.OPENING_CLOSING, "OTRO", None]
    v = V(spark, d, "loads").select("ejercicio", _pick(F.col("nro_comprobante").cast("long") % len(names), names).alias("concepto"), "importe")
    return fin(receivables.opening_closing(v))


# ---------------------------------------------------------------- plain operators (P-10, P-16, P-18, T-01)


@query("p_literals", """
SELECT ejercicio, cta_cte, CAST(-importe AS DOUBLE) AS importe, 'RDEU' AS tipo, true AS es_pagado, CAST(NULL AS VARCHAR) AS nro_fondo FROM loads WHERE tipo = 'REG'""")
def p_literals(spark, d):
    loads = op.negate(V(spark, d, "loads").filter("tipo = 'REG'").select("ejercicio", "cta_cte", "importe", "tipo"), "importe")
    return fin(op.with_literals(loads, {"tipo": "RDEU", "es_pagado": True, "nro_fondo": None}).withColumn("nro_fondo", F.col("nro_fondo").cast("string")))


@query("p_front", """
SELECT ejercicio || '|' || mes || '|' || coalesce(cta_cte, '') || '|' || nro_comprobante AS fila FROM loads""")
def p_front(spark, d):
    """The columns in their new order, as one text."""
    front = op.front(V(spark, d, "loads").select("nro_comprobante", "tipo", "mes", "cta_cte", "ejercicio"), ["ejercicio", "mes", "cta_cte"], drop=["tipo"])
    return front.select(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in front.columns]).alias("fila"))


@query("p_numeric", """
SELECT l_returnflag, CAST(sum(l_orderkey) + sum(l_partkey) + sum(l_suppkey) + sum(l_linenumber) AS BIGINT) AS enteros FROM lineitem GROUP BY 1""")
def p_numeric(spark, d):
    """All whole-number columns found by type, summed."""
    li = table(spark, d, "lineitem").drop("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    names = op.numeric_cols(li)
    return li.groupBy("l_returnflag").agg(sum((F.sum(c) for c in names), F.lit(0)).cast("long").alias("enteros"))


@query("t_sort", """
WITH s AS (SELECT cta_cte, ejercicio, sum(importe) AS importe FROM loads GROUP BY ALL), n AS (SELECT *, row_number() OVER (ORDER BY ejercicio DESC, cta_cte) AS fila FROM s)
SELECT list(ejercicio || ' ' || cta_cte ORDER BY fila)[1:10][CAST(i AS INTEGER)] AS clave, i AS fila FROM n, range(1, 11) r(i) GROUP BY i""")
def t_sort(spark, d):
    """The first ten of the sorted totals, with their places: the sort's order is what is compared."""
    g = op.sort_out(op.group_sum(V(spark, d, "loads"), ["cta_cte", "ejercicio"], ["importe"]), ["ejercicio", "cta_cte"], ascending=[False, True])
    return g.limit(10).select(F.concat_ws(" ", "ejercicio", "cta_cte").alias("clave"), (F.monotonically_increasing_id() + 1).alias("fila"))
