"""Registered ledger reports over the driver tables: floating debt against accounting (D-NET2, D-NET7, D-NET8), contractor
advances (D-IV3) and the newest budget descriptions (D-DIM2).

The oracles are written from the report's definition, not from the code beside them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.scalars import month_of, voucher_number
from ..sources.views import MONEY, table
from . import controls, debt, works
from .registry import fin, query

#: The years of the driver's orders are moved on so far, so that the fixed exceptions of the reports (2011 on) occur.
SHIFT = 16


def _pick(n, values):
    """The ``n``-th of ``values`` (from 0; None: NULL)."""
    return F.element_at(F.array(*map(F.lit, values)), (n + 1).cast("int"))


def _lines(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def _later(date):
    return (F.year(date) + SHIFT).cast("string")


# ---------------------------------------------------------------- floating debt and the general ledger

#: Debt snapshots: several origins per voucher, origins of another number, NULL origins; most lines are of their report year.
DEBT_SQL = """
rdeu AS (SELECT *, lpad(CAST(n AS VARCHAR), 5, '0') || '/' || substr(ejercicio, 3, 2) AS nro_comprobante FROM (
  SELECT CAST(CASE WHEN l_linenumber <= 4 THEN year(l_shipdate) ELSE year(o_orderdate) END + 16 AS VARCHAR) AS ejercicio,
         strftime(l_shipdate, '%m/') || (year(l_shipdate) + 16) AS mes_hasta,
         CASE WHEN l_orderkey % 50 = 0 THEN 2749 ELSE l_orderkey % 3000 END AS n,
         CASE l_suppkey % 10 WHEN 0 THEN NULL WHEN 1 THEN CAST(l_orderkey % 3000 + 1 AS VARCHAR) ELSE CAST(l_orderkey % 3000 AS VARCHAR) END AS nro_origen,
         CASE WHEN l_linenumber % 2 = 0 THEN '10' ELSE '11' END AS fuente, CASE o_custkey % 5 WHEN 0 THEN NULL ELSE 'cta ' || o_custkey % 5 END AS cta_cte,
         CAST(l_suppkey AS VARCHAR) AS cuit, 'glosa ' || l_returnflag AS glosa, CASE WHEN l_partkey % 9 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS nro_expte,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS saldo
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'O'))"""

#: General ledger: eight voucher types, accounts with the exceptions and a NULL, entry numbers that hit the known vouchers;
#: the adjustments of every fourth number are cents, so that their sums lie around the tolerance.
MAJOR_SQL = """
gl AS (SELECT *, CASE WHEN tipo_comprobante = 'AJU' AND k % 4 = 0 THEN 0.05 WHEN l_returnflag = 'R' THEN -precio ELSE precio END AS saldo FROM (
  SELECT CAST(year(l_shipdate) + 16 AS VARCHAR) AS ejercicio, strftime(l_shipdate, '%m/') || (year(l_shipdate) + 16) AS mes,
         l_orderkey % 3000 AS k, CASE WHEN l_linenumber < 7 THEN CAST(l_orderkey % 3000 AS VARCHAR) END AS nro_original,
         CAST(CASE year(l_shipdate) WHEN 1995 THEN 16530 + l_orderkey % 12 WHEN 1996 THEN 15790 + l_orderkey % 8 WHEN 1997 THEN 17090 + l_orderkey % 12
              ELSE l_orderkey END AS VARCHAR) AS nro_entrada,
         ['CAO', 'CAP', 'CAM', 'CAD', 'ANP', 'AJU', 'APE', NULL][CAST(l_partkey % 8 + 1 AS INTEGER)] AS tipo_comprobante,
         ['2113-2-9', '2241-1-1', '2111-1-1', '2111-1-1', '2122-1-2', '1112-2-6', NULL][CAST(l_suppkey % 7 + 1 AS INTEGER)] AS cta_contable,
         ['245', '310', '337', NULL][CAST(l_linenumber % 4 + 1 AS INTEGER)] AS auxiliar_1, l_returnflag,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS precio, CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS creditos
  FROM lineitem))"""


def _debt(spark, d):
    n = F.col("l_orderkey") % 3000
    year = F.when(F.col("l_linenumber") <= 4, _later("l_shipdate")).otherwise(_later("o_orderdate"))
    number = F.when(F.col("l_orderkey") % 50 == 0, 2749).otherwise(n).cast("string")
    origin = F.when(F.col("l_suppkey") % 10 == 1, n + 1).when(F.col("l_suppkey") % 10 != 0, n).cast("string")
    return _lines(spark, d).filter(F.col("l_linestatus") == "O").select(
        year.alias("ejercicio"), F.concat(F.date_format("l_shipdate", "MM/"), _later("l_shipdate")).alias("mes_hasta"),
        voucher_number(number, year).alias("nro_comprobante"), origin.alias("nro_origen"),
        F.when(F.col("l_linenumber") % 2 == 0, "10").otherwise("11").alias("fuente"),
        F.when(F.col("o_custkey") % 5 != 0, F.concat(F.lit("cta "), (F.col("o_custkey") % 5).cast("string"))).alias("cta_cte"),
        F.col("l_suppkey").cast("string").alias("cuit"), F.concat(F.lit("glosa "), "l_returnflag").alias("glosa"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey").cast("string")).alias("nro_expte"), F.col("l_extendedprice").cast(MONEY).alias("saldo"))


def _major(spark, d):
    k, y, price = F.col("l_orderkey"), F.year("l_shipdate"), F.col("l_extendedprice").cast(MONEY)
    kind = _pick(F.col("l_partkey") % 8, ["CAO", "CAP", "CAM", "CAD", "ANP", "AJU", "APE", None])
    entry = F.when(y == 1995, 16530 + k % 12).when(y == 1996, 15790 + k % 8).when(y == 1997, 17090 + k % 12).otherwise(k)
    return table(spark, d, "lineitem").select(
        _later("l_shipdate").alias("ejercicio"), F.concat(F.date_format("l_shipdate", "MM/"), _later("l_shipdate")).alias("mes"),
        F.to_date("l_shipdate").alias("fecha"), F.when(F.col("l_linenumber") < 7, (k % 3000).cast("string")).alias("nro_original"), entry.cast("string").alias("nro_entrada"),
        kind.alias("tipo_comprobante"), _pick(F.col("l_suppkey") % 7, ["2113-2-9", "2241-1-1", "2111-1-1", "2111-1-1", "2122-1-2", "1112-2-6", None]).alias("cta_contable"),
        _pick(F.col("l_linenumber") % 4, ["245", "310", "337", None]).alias("auxiliar_1"),
        F.when(F.col("l_returnflag") == "R", price).otherwise(0).cast(MONEY).alias("creditos"),
        F.when((kind == "AJU") & (k % 3000 % 4 == 0), F.lit(0.05)).when(F.col("l_returnflag") == "R", -price).otherwise(price).cast(MONEY).alias("saldo"))


DEBT_YEARS = ["2011", "2012", "2013"]

#: Debt of each report year's latest month; ledger rows of the year's own unpaid vouchers, with or without adjustments.
MATCH_SQL = f"""
WITH {DEBT_SQL}, {MAJOR_SQL},
y AS (SELECT unnest(['2011', '2012', '2013']) AS y),
ult AS (SELECT y, max(strptime(mes_hasta, '%m/%Y')) AS m FROM rdeu JOIN y ON right(mes_hasta, 4) = y GROUP BY y),
deuda AS (SELECT y AS contable, rdeu.* FROM rdeu JOIN ult ON strptime(mes_hasta, '%m/%Y') = m{{drop}}),
pasivo AS (SELECT * FROM gl WHERE starts_with(cta_contable, '2') AND tipo_comprobante IN ('CAO', 'CAP', 'CAM', 'CAD', 'ANP'{{types}}) AND ejercicio IN (SELECT y FROM y)),
propios AS (SELECT DISTINCT contable, CAST(CAST(split_part(nro_comprobante, '/', 1) AS INTEGER) AS VARCHAR) AS nro FROM deuda WHERE ejercicio = contable),
fl AS (SELECT p.* FROM pasivo p JOIN propios ON contable = p.ejercicio AND nro = nro_original{{more}}),
orden AS (SELECT *, row_number() OVER (PARTITION BY contable, ejercicio, nro_origen ORDER BY fuente NULLS LAST, cta_cte NULLS LAST, cuit NULLS LAST, glosa NULLS LAST, nro_expte NULLS LAST) AS rn,
                 sum(saldo) OVER (PARTITION BY contable, ejercicio, nro_origen) AS total FROM deuda WHERE nro_origen IS NOT NULL),
una AS (SELECT contable, ejercicio, nro_origen, fuente, cta_cte, cuit, glosa, nro_expte, total AS saldo_rdeu FROM orden WHERE rn = 1
        UNION ALL SELECT contable, ejercicio, NULL, fuente, cta_cte, cuit, glosa, nro_expte, saldo FROM deuda WHERE nro_origen IS NULL)"""

NET7_SQL = MATCH_SQL.format(drop="", types="", more="")
NET8_SQL = MATCH_SQL.format(drop=" WHERE nro_comprobante IS DISTINCT FROM '02749/11'", types=", 'AJU'", more=" UNION ALL SELECT * FROM pasivo WHERE tipo_comprobante = 'AJU'") + """,
acum AS (SELECT y AS contable, fl.* FROM fl JOIN y ON ejercicio <= y),
aju AS (SELECT *, nro_entrada || '/' || substr(ejercicio, 3) AS comprobante FROM acum WHERE tipo_comprobante = 'AJU' AND NOT starts_with(cta_contable, '2241') AND cta_contable <> '2113-2-9'),
buenos AS (SELECT * FROM aju WHERE comprobante NOT IN ('16535/11', '15793/12', '17773/16', '17096/13', '17097/13', '19897/17', '15142/21', '16986/24')),
grupos AS (SELECT contable, nro_original FROM buenos WHERE nro_original IS NOT NULL GROUP BY ALL HAVING abs(sum(saldo)) > 0.1),
quedan AS (SELECT b.* FROM buenos b JOIN grupos g ON g.contable = b.contable AND g.nro_original = b.nro_original
           UNION ALL SELECT * FROM buenos WHERE comprobante = '16536/11'),
cuadro AS (SELECT u.contable, u.ejercicio, u.nro_origen AS nro_original, fuente, cta_cte, cuit, glosa, nro_expte, saldo_rdeu, nro_entrada, tipo_comprobante, cta_contable, saldo AS saldo_contable
           FROM una u LEFT JOIN acum a ON a.contable = u.contable AND a.ejercicio = u.ejercicio AND a.nro_original = u.nro_origen
           UNION ALL SELECT contable, ejercicio, nro_original, '11', NULL, NULL, NULL, NULL, -saldo, nro_entrada, tipo_comprobante, cta_contable, saldo FROM quedan)"""
NET8_COLS = ["ejercicio_contable", "ejercicio", "nro_original", "fuente", "cta_cte", "cuit", "glosa", "nro_expte", "saldo_rdeu", "nro_entrada", "tipo_comprobante", "cta_contable", "saldo_contable"]


@query("d_net7", f"""{NET7_SQL}
SELECT u.ejercicio, u.nro_origen AS nro_original, fuente, cta_cte, cuit, glosa, nro_expte, CAST(saldo_rdeu AS DOUBLE) AS saldo_rdeu, nro_entrada, tipo_comprobante,
       cta_contable, CAST(saldo AS DOUBLE) AS saldo_contable
FROM una u LEFT JOIN fl ON fl.ejercicio = u.ejercicio AND fl.nro_original = u.nro_origen WHERE u.contable = '2013'""")
def d_net7(spark, d):
    return fin(debt.debt_with_accounting_class(_debt(spark, d), _major(spark, d), DEBT_YEARS).select(*NET8_COLS[1:]))


def _net8(spark, d):
    return debt.debt_with_accounting(_debt(spark, d), _major(spark, d), DEBT_YEARS)


@query("d_net8", f"""{NET8_SQL}
SELECT contable AS ejercicio_contable, ejercicio, nro_original, fuente, cta_cte, cuit, glosa, nro_expte, CAST(saldo_rdeu AS DOUBLE) AS saldo_rdeu, nro_entrada,
       tipo_comprobante, cta_contable, CAST(saldo_contable AS DOUBLE) AS saldo_contable FROM cuadro""")
def d_net8(spark, d):
    return fin(_net8(spark, d)["rdeu_cta_contable"].select(*NET8_COLS))


@query("d_net8_cuentas", f"""{NET8_SQL}
SELECT contable AS ejercicio_contable, cta_contable, CAST(coalesce(sum(saldo_contable), 0) AS DOUBLE) AS saldo_contable, CAST(sum(saldo_rdeu) AS DOUBLE) AS saldo_rdeu
FROM cuadro WHERE cta_contable IS NOT NULL GROUP BY ALL""")
def d_net8_cuentas(spark, d):
    return fin(debt.account_summary(_net8(spark, d)["rdeu_cta_contable"]))


@query("d_net8_deuda", f"""{NET8_SQL}
SELECT contable AS ejercicio_contable, ejercicio, mes_hasta, nro_comprobante, nro_origen AS nro_original, cuit, CAST(saldo AS DOUBLE) AS saldo_rdeu FROM deuda""")
def d_net8_deuda(spark, d):
    return fin(_net8(spark, d)["rdeu012"].select("ejercicio_contable", "ejercicio", "mes_hasta", "nro_comprobante", "nro_original", "cuit", "saldo_rdeu"))


@query("d_net8_mayor", f"""{NET8_SQL}
SELECT ejercicio, nro_original, nro_entrada, tipo_comprobante, cta_contable, CAST(saldo AS DOUBLE) AS saldo_contable FROM fl""")
def d_net8_mayor(spark, d):
    return fin(_net8(spark, d)["rcocc31"].select("ejercicio", "nro_original", "nro_entrada", "tipo_comprobante", "cta_contable", "saldo_contable"))


# ---------------------------------------------------------------- payroll vouchers (D-NET2)

#: Vouchers of the payroll account and others; the lines to skip occur, and so do lines without a number.
PAYROLL_SQL = """
hab AS (SELECT CAST(year(o_orderdate) + 16 AS VARCHAR) AS ejercicio, strftime(o_orderdate, '%m/') || (year(o_orderdate) + 16) AS mes,
               (CASE WHEN l_orderkey > 9999 THEN CAST(l_orderkey AS VARCHAR) ELSE lpad(CAST(l_orderkey AS VARCHAR), 5, '0') END) || '/' || (year(o_orderdate) - 1984) AS nro_comprobante, CAST(l_extendedprice AS DECIMAL(18,2)) AS importe,
               ['100', '150', '151', '160', NULL][CAST(l_linenumber % 5 + 1 AS INTEGER)] AS partida, CASE WHEN l_suppkey % 3 = 0 THEN '10' ELSE '11' END AS fuente,
               CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '10270' ELSE '130832-04' END AS cta_cte, CAST(l_suppkey AS VARCHAR) AS cuit, CAST(o_custkey AS VARCHAR) AS beneficiario
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
NET2_COLS = ["ejercicio", "mes", "nro_comprobante", "importe", "partida", "fuente", "cta_cte", "cuit", "beneficiario", "clase_reg", "clase_gto", "glosa", "nro_expte", "es_pagado"]


def _payroll(spark, d):
    return _lines(spark, d).select(
        _later("o_orderdate").alias("ejercicio"), F.concat(F.date_format("o_orderdate", "MM/"), _later("o_orderdate")).alias("mes"),
        voucher_number("l_orderkey", _later("o_orderdate")).alias("nro_comprobante"), F.col("l_extendedprice").cast(MONEY).alias("importe"),
        _pick(F.col("l_linenumber") % 5, ["100", "150", "151", "160", None]).alias("partida"), F.when(F.col("l_suppkey") % 3 == 0, "10").otherwise("11").alias("fuente"),
        _pick(F.col("o_custkey") % 3, [None, "10270", K.PAYROLL_ACCOUNT]).alias("cta_cte"), F.col("l_suppkey").cast("string").alias("cuit"),
        F.col("o_custkey").cast("string").alias("beneficiario"))


@query("d_net2", f"""
WITH {PAYROLL_SQL} SELECT * REPLACE (CAST(importe AS DOUBLE) AS importe) FROM hab WHERE cta_cte = '130832-04'""")
def d_net2(spark, d):
    return fin(debt.payroll_vouchers(_payroll(spark, d), _major(spark, d)))


@query("d_net2_neto", f"""
WITH {PAYROLL_SQL}, {MAJOR_SQL}
SELECT ejercicio, mes, nro_comprobante, CAST(importe AS DOUBLE) AS importe, partida, fuente, cta_cte, cuit, beneficiario, NULL AS clase_reg, NULL AS clase_gto, NULL AS glosa,
       NULL AS nro_expte, CAST(NULL AS BOOLEAN) AS es_pagado
FROM hab WHERE cta_cte = '130832-04' AND (partida IS NULL OR partida NOT IN ('150', '151'))
UNION ALL
SELECT ejercicio, mes, (CASE WHEN length(nro_entrada) >= 5 THEN nro_entrada ELSE lpad(nro_entrada, 5, '0') END) || '/' || substr(ejercicio, 3) || 'A', CAST(-creditos AS DOUBLE), auxiliar_1, '11', '130832-04',
       '30632351514', 'own', 'CYO', 'REM', CASE auxiliar_1 WHEN '245' THEN 'RET. GCIAS. 4TA CATEGORÍA' ELSE 'HABERES ERRONEOS COD 310' END, '90000000' || ejercicio, true
FROM gl WHERE cta_contable = '2122-1-2' AND tipo_comprobante IS DISTINCT FROM 'APE' AND auxiliar_1 IN ('245', '310')""")
def d_net2_neto(spark, d):
    v = debt.payroll_vouchers(_payroll(spark, d), _major(spark, d), skip_art=True, net_codes=True, own_name="own")
    return fin(v.select(*NET2_COLS))


@query("d_net2_por_mes", f"""
WITH {PAYROLL_SQL}, {MAJOR_SQL},
n AS (SELECT ejercicio, mes, partida, importe, 0 AS sint FROM hab WHERE cta_cte = '130832-04'
      UNION ALL SELECT ejercicio, mes, auxiliar_1, -creditos, 1 FROM gl
      WHERE cta_contable = '2122-1-2' AND tipo_comprobante IS DISTINCT FROM 'APE' AND auxiliar_1 IN ('245', '310'))
SELECT ejercicio, mes, CAST(sum(importe) AS DOUBLE) AS importe FROM n GROUP BY ALL""")
def d_net2_por_mes(spark, d):
    """Real vouchers (all lines) and the negative synthetic ones of the ledger meet in one monthly sum."""
    return fin(op.group_sum(debt.payroll_vouchers(_payroll(spark, d), _major(spark, d), net_codes=True), ["ejercicio", "mes"], ["importe"]))


# ---------------------------------------------------------------- contractor advances (D-IV3)

#: Funds of every third order; regularisations (several lines, several vouchers of one fund, some without fund or of another
#: year); advance loads with other amounts, months and numbers, some without fund; regularisation loads with gaps.
ADVANCES_SQL = """
fo AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, CAST(o_orderkey AS VARCHAR) AS nro_fondo, strftime(o_orderdate, '%m/%Y') AS mes,
              CAST(o_totalprice AS DECIMAL(18,2)) AS ingresos, CAST(o_totalprice AS DECIMAL(18,2)) / 2 AS saldo FROM orders WHERE o_orderkey % 3 = 0),
co AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(CASE WHEN l_linenumber = 6 THEN year(l_shipdate) ELSE year(o_orderdate) END AS VARCHAR) AS ejercicio,
              CASE WHEN l_orderkey % 5 > 0 THEN CAST(l_orderkey AS VARCHAR) END AS nro_fondo, CASE WHEN l_returnflag = 'N' THEN 'CYO' ELSE 'REG' END AS clase_reg,
              CAST(l_orderkey * 2 + l_linenumber % 2 AS VARCHAR) AS reg,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS importe, strftime(o_orderdate, '%m/%Y') AS mes, CASE WHEN o_custkey % 4 > 0 THEN 'cta ' || o_custkey % 4 END AS cta_cte,
              CAST(o_custkey AS VARCHAR) AS cuit, '1' || o_custkey % 3 AS fuente
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cv AS (SELECT *, (CASE WHEN length(reg) >= 5 THEN reg ELSE lpad(reg, 5, '0') END) || '/' || substr(ejercicio, 3) AS nro_comprobante FROM co),
ic AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS ejercicio, (CASE WHEN o_orderkey > 9999 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 5, '0') END) || '/' || substr(CAST(year(o_orderdate) AS VARCHAR), 3) AS nro_comprobante,
              'PA6' AS tipo, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 7 = 0 THEN 0.1 ELSE 0 END AS importe,
              CASE WHEN o_orderkey % 17 = 0 THEN '01/1990' ELSE strftime(o_orderdate, '%m/%Y') END AS mes, CAST(NULL AS VARCHAR) AS cta_cte, CAST(NULL AS VARCHAR) AS cuit, CAST(NULL AS VARCHAR) AS fuente
       FROM orders WHERE o_orderkey % 6 < 4 AND o_orderkey % 13 > 0
       UNION ALL
       SELECT ejercicio, nro_comprobante, CASE WHEN k % 29 = 0 THEN 'CYO' ELSE 'REG' END, importe + CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END, CASE WHEN k % 31 = 0 THEN '02/1990' ELSE mes END,
              CASE WHEN k % 19 > 0 THEN cta_cte END, CASE WHEN k % 37 = 0 THEN '0' ELSE cuit END, CASE WHEN k % 41 = 0 THEN '99' ELSE fuente END
       FROM cv WHERE clase_reg = 'REG' AND k % 17 > 0)"""


def _funds(spark, d):
    total = F.col("o_totalprice").cast(MONEY)
    return table(spark, d, "orders").filter(F.col("o_orderkey") % 3 == 0).select(
        F.year("o_orderdate").cast("string").alias("ejercicio"), F.col("o_orderkey").cast("string").alias("nro_fondo"), month_of("o_orderdate").alias("mes"),
        total.alias("ingresos"), (total / 2).alias("saldo"))


def _fund_vouchers(spark, d):
    year = F.when(F.col("l_linenumber") == 6, F.year("l_shipdate")).otherwise(F.year("o_orderdate")).cast("string")
    return _lines(spark, d).select(
        F.col("l_orderkey").alias("k"), year.alias("ejercicio"), F.when(F.col("l_orderkey") % 5 > 0, F.col("l_orderkey").cast("string")).alias("nro_fondo"),
        F.when(F.col("l_returnflag") == "N", "CYO").otherwise("REG").alias("clase_reg"),
        voucher_number(F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2, year).alias("nro_comprobante"), F.col("l_extendedprice").cast(MONEY).alias("importe"),
        month_of("o_orderdate").alias("mes"), F.when(F.col("o_custkey") % 4 > 0, F.concat(F.lit("cta "), (F.col("o_custkey") % 4).cast("string"))).alias("cta_cte"),
        F.col("o_custkey").cast("string").alias("cuit"), F.concat(F.lit("1"), (F.col("o_custkey") % 3).cast("string")).alias("fuente"))


def _advance_loads(spark, d):
    o, k = F.col("o_orderkey"), F.col("k")
    year = F.year("o_orderdate").cast("string")
    advances = table(spark, d, "orders").filter((o % 6 < 4) & (o % 13 > 0)).select(
        year.alias("ejercicio"), voucher_number("o_orderkey", year).alias("nro_comprobante"), F.lit("PA6").alias("tipo"),
        (F.col("o_totalprice").cast(MONEY) + F.when(o % 11 == 0, 1).when(o % 7 == 0, 0.1).otherwise(0).cast("decimal(3,1)")).alias("importe"),
        F.when(o % 17 == 0, "01/1990").otherwise(month_of("o_orderdate")).alias("mes"))
    regs = _fund_vouchers(spark, d).filter((F.col("clase_reg") == "REG") & (k % 17 > 0)).select(
        "ejercicio", "nro_comprobante", F.when(k % 29 == 0, "CYO").otherwise("REG").alias("tipo"), (F.col("importe") + F.when(k % 23 == 0, 1).otherwise(0)).alias("importe"),
        F.when(k % 31 == 0, "02/1990").otherwise(F.col("mes")).alias("mes"), F.when(k % 19 > 0, F.col("cta_cte")).alias("cta_cte"),
        F.when(k % 37 == 0, "0").otherwise(F.col("cuit")).alias("cuit"), F.when(k % 41 == 0, "99").otherwise(F.col("fuente")).alias("fuente"))
    return op.union_all(advances, regs)


IV3_FLAGS = [("nro_fondo", ""), ("importe_pa6", "0"), ("nro_reg", ""), ("importe_reg", "0"), ("fuente", ""), ("cta_cte", ""), ("cuit", ""), ("tipo", ""), ("mes_pa6", ""), ("mes_reg", "")]
IV3_ERRORS = ",\n       ".join((f"abs(siif_{c} - icaro_{c}) > 0.1" if money else f"siif_{c} IS DISTINCT FROM icaro_{c}") + f" AS err_{c}" for c, money in IV3_FLAGS)


@query("d_iv3", f"""
WITH {ADVANCES_SQL},
f AS (SELECT ejercicio, (CASE WHEN length(nro_fondo) >= 5 THEN nro_fondo ELSE lpad(nro_fondo, 5, '0') END) || '/' || substr(ejercicio, 3) AS fondo, mes, ingresos FROM fo),
g AS (SELECT ejercicio, (CASE WHEN length(nro_fondo) >= 5 THEN nro_fondo ELSE lpad(nro_fondo, 5, '0') END) || '/' || substr(ejercicio, 3) AS fondo, nro_comprobante, sum(importe) AS importe,
             min(mes) AS mes, min(clase_reg) AS tipo, min(fuente) AS fuente, min(cta_cte) AS cta_cte, min(cuit) AS cuit
      FROM cv WHERE clase_reg = 'REG' AND nro_fondo IS NOT NULL GROUP BY ALL),
p AS (SELECT nro_comprobante, min(mes) AS mes, sum(importe) AS importe FROM ic WHERE tipo = 'PA6' GROUP BY 1),
r AS (SELECT ejercicio, nro_comprobante, sum(importe) AS importe, min(mes) AS mes, min(tipo) AS tipo, min(fuente) AS fuente, min(cta_cte) AS cta_cte, min(cuit) AS cuit
      FROM ic WHERE tipo <> 'PA6' GROUP BY ALL),
a AS (SELECT f.ejercicio, f.fondo, f.mes, ingresos, g.nro_comprobante, g.importe, g.mes AS gmes, tipo, fuente, cta_cte, cuit
      FROM f LEFT JOIN g ON g.ejercicio = f.ejercicio AND g.fondo = f.fondo),
b AS (SELECT a.*, p.nro_comprobante AS pnro, p.mes AS pmes, p.importe AS pimporte FROM a FULL JOIN p ON p.nro_comprobante = a.fondo),
m AS (SELECT b.ejercicio, fondo AS siif_nro_fondo, pnro AS icaro_nro_fondo, b.mes AS siif_mes_pa6, pmes AS icaro_mes_pa6, coalesce(ingresos, 0) AS siif_importe_pa6,
             coalesce(pimporte, 0) AS icaro_importe_pa6, b.nro_comprobante AS siif_nro_reg, r.nro_comprobante AS icaro_nro_reg, gmes AS siif_mes_reg, r.mes AS icaro_mes_reg,
             coalesce(b.importe, 0) AS siif_importe_reg, coalesce(r.importe, 0) AS icaro_importe_reg, b.tipo AS siif_tipo, r.tipo AS icaro_tipo,
             b.fuente AS siif_fuente, r.fuente AS icaro_fuente, b.cta_cte AS siif_cta_cte, r.cta_cte AS icaro_cta_cte, b.cuit AS siif_cuit, r.cuit AS icaro_cuit
      FROM b LEFT JOIN r ON r.ejercicio = b.ejercicio AND r.nro_comprobante = b.nro_comprobante),
e AS (SELECT *, {IV3_ERRORS} FROM m),
w AS (SELECT * FROM e WHERE {" OR ".join(f"err_{c}" for c, _ in IV3_FLAGS)})
SELECT ejercicio, siif_nro_fondo, icaro_nro_fondo, siif_nro_reg, icaro_nro_reg, CAST(siif_importe_pa6 AS DOUBLE) AS siif_importe_pa6,
       CAST(icaro_importe_pa6 AS DOUBLE) AS icaro_importe_pa6, CAST(siif_importe_reg AS DOUBLE) AS siif_importe_reg, CAST(icaro_importe_reg AS DOUBLE) AS icaro_importe_reg,
       {", ".join(f"err_{c}" for c, _ in IV3_FLAGS)},
       rank() OVER (ORDER BY {", ".join(f"err_{c} DESC" for c, _ in IV3_FLAGS)}) AS orden
FROM w""")
def d_iv3(spark, d):
    out = controls.advances_control(_funds(spark, d), _fund_vouchers(spark, d), _advance_loads(spark, d), rank="orden")
    return fin(out.select("ejercicio", "siif_nro_fondo", "icaro_nro_fondo", "siif_nro_reg", "icaro_nro_reg", "siif_importe_pa6", "icaro_importe_pa6", "siif_importe_reg",
                          "icaro_importe_reg", *[f"err_{c}" for c, _ in IV3_FLAGS], "orden"))


# ---------------------------------------------------------------- newest descriptions (D-DIM2)

#: Structures of several years; the text of a level changes with the year, the structure that carries it, and may be missing.
STRUCTURE_SQL = """
rf AS (SELECT DISTINCT ejercicio, programa, subprograma, proyecto, actividad, estructura,
              'P' || ejercicio || actividad AS desc_prog, CASE WHEN CAST(actividad AS INTEGER) % 4 > 0 THEN 'S' || ejercicio || actividad END AS desc_subprog,
              'Y' || ejercicio || subprograma || actividad AS desc_proy, CASE WHEN ejercicio <> '2000' OR actividad <> '01' THEN 'A' || ejercicio END AS desc_act FROM (
  SELECT *, programa || '-' || subprograma || '-' || proyecto || '-' || actividad AS estructura FROM (
    SELECT CAST(year(l_shipdate) AS VARCHAR) AS ejercicio, lpad(CAST(l_partkey % 11 AS VARCHAR), 2, '0') AS programa, lpad(CAST(l_suppkey % 3 AS VARCHAR), 2, '0') AS subprograma,
           lpad(CAST(l_orderkey % 13 AS VARCHAR), 2, '0') AS proyecto, lpad(CAST(l_orderkey % 17 AS VARCHAR), 2, '0') AS actividad
    FROM lineitem WHERE (l_partkey % 11 + year(l_shipdate)) % 5 > 0 AND l_linenumber < 4)))"""


def _structures(spark, d):
    two = lambda c, m: F.lpad((F.col(c) % m).cast("string"), 2, "0")
    y, act = F.col("ejercicio"), F.col("actividad")
    li = table(spark, d, "lineitem").filter(((F.col("l_partkey") % 11 + F.year("l_shipdate")) % 5 > 0) & (F.col("l_linenumber") < 4))
    s = li.select(F.year("l_shipdate").cast("string").alias("ejercicio"), two("l_partkey", 11).alias("programa"), two("l_suppkey", 3).alias("subprograma"),
                  two("l_orderkey", 13).alias("proyecto"), two("l_orderkey", 17).alias("actividad")).distinct()
    return s.withColumns({
        "estructura": F.concat_ws("-", "programa", "subprograma", "proyecto", "actividad"), "desc_prog": F.concat(F.lit("P"), y, act),
        "desc_subprog": F.when(act.cast("int") % 4 > 0, F.concat(F.lit("S"), y, act)), "desc_proy": F.concat(F.lit("Y"), y, F.col("subprograma"), act),
        "desc_act": F.when((y != "2000") | (act != "01"), F.concat(F.lit("A"), y))})


def _newest_sql(where: str) -> str:
    def level(keys: str, text: str) -> str:
        return f"(SELECT {keys}, {text} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY CAST(ejercicio AS INTEGER) DESC, estructura) AS rn FROM d) WHERE rn = 1)"

    return f"""
WITH {STRUCTURE_SQL}, d AS (SELECT * FROM rf WHERE {where})
SELECT estructura, programa || ' - ' || desc_prog AS desc_prog, subprograma || ' - ' || desc_subprog AS desc_subprog,
       proyecto || ' - ' || desc_proy AS desc_proy, actividad || ' - ' || desc_act AS desc_act
FROM {level("estructura", "programa, subprograma, proyecto, actividad, desc_act")}
LEFT JOIN {level("programa", "desc_prog")} USING (programa)
LEFT JOIN {level("programa, subprograma", "desc_subprog")} USING (programa, subprograma)
LEFT JOIN {level("programa, subprograma, proyecto", "desc_proy")} USING (programa, subprograma, proyecto)"""


@query("d_dim2", _newest_sql("CAST(ejercicio AS INTEGER) <= 2000"))
def d_dim2(spark, d):
    return works.budget_descriptions(_structures(spark, d), up_to_year="2000")


@query("d_dim2_lista", _newest_sql("ejercicio IN ('1996', '1999')"))
def d_dim2_lista(spark, d):
    return works.budget_descriptions(_structures(spark, d), years=["1996", "1999"])
