"""Named reports registered on the domain views."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as op
from ..session import materialize
from . import bank, controls, receivables, withholdings, works
from .generic_queries import FIRST_SNAP_SQL
from .registry import V, fin, query

KEYS3 = ["ejercicio", "mes", "cta_cte"]

LAST_SNAP_SQL = """
last_snap AS (SELECT nro_comprobante, cuit, saldo, fecha_hasta FROM (
    SELECT nro_comprobante, cuit, saldo, fecha_hasta, row_number() OVER (PARTITION BY nro_comprobante
        ORDER BY fecha_hasta DESC NULLS FIRST, saldo DESC NULLS FIRST, cuit DESC NULLS FIRST) AS rn
    FROM snapshots) WHERE rn = 1)"""

NET_SQL = f"""
base AS (SELECT * FROM loads WHERE tipo IS DISTINCT FROM 'PA6' AND tipo IS DISTINCT FROM 'REG'),
{FIRST_SNAP_SQL},
{LAST_SNAP_SQL},
neg AS (SELECT b.ejercicio, b.nro_comprobante, b.cuit, -f.saldo AS importe, b.fecha, b.mes, b.cta_cte, b.fuente,
               'RDEU' AS tipo, b.id
        FROM first_snap f JOIN base b ON f.nro_comprobante = b.nro_comprobante AND f.mes = b.mes),
pos AS (SELECT CAST(year(l.fecha_hasta + INTERVAL 1 MONTH) AS VARCHAR) AS ejercicio, l.nro_comprobante, l.cuit,
               l.saldo AS importe, CAST(l.fecha_hasta + INTERVAL 1 MONTH AS DATE) AS fecha,
               strftime(l.fecha_hasta + INTERVAL 1 MONTH, '%m/%Y') AS mes, b.cta_cte, b.fuente, 'RDEU' AS tipo,
               l.nro_comprobante || 'C' AS id
        FROM last_snap l JOIN base b ON l.nro_comprobante = b.nro_comprobante),
net AS (SELECT * FROM pos
        UNION ALL SELECT * FROM neg
        UNION ALL SELECT ejercicio, nro_comprobante, cuit, importe, fecha, mes, cta_cte, fuente, tipo, id FROM base
        UNION ALL SELECT ejercicio, nro_comprobante, cuit, importe, fecha, mes, cta_cte, fuente, tipo, id
                  FROM loads WHERE tipo = 'PA6')"""


def net_loads(spark, d, years=None):
    """D-NET1 on the views: loads net of floating debt (all years unless given)."""
    return op.net_pending(V(spark, d, "loads"), V(spark, d, "snapshots"), years=years, snap_cols=["cuit"],
                          load_cols=["cta_cte", "fuente"], require=None)


@query("d_net1", f"""
WITH {NET_SQL}
SELECT ejercicio, nro_comprobante, cuit, CAST(importe AS DOUBLE) AS importe, fecha, mes, cta_cte, fuente, tipo, id
FROM net""")
def d_net1(spark, d):
    n = net_loads(spark, d)
    return fin(n.select("ejercicio", "nro_comprobante", "cuit", "importe", "fecha", "mes", "cta_cte", "fuente",
                        "tipo", "id"))


@query("d_co1", f"""
WITH {NET_SQL},
a AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS ejecutado_icaro FROM net
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
b AS (SELECT ejercicio, mes, cta_cte, sum(importe_bruto) AS bruto_sgf FROM payments
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL)
SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
       coalesce(a.cta_cte, b.cta_cte) AS cta_cte,
       CAST(coalesce(ejecutado_icaro, 0) AS DOUBLE) AS ejecutado_icaro, CAST(coalesce(bruto_sgf, 0) AS DOUBLE) AS bruto_sgf,
       CAST(coalesce(ejecutado_icaro, 0) - coalesce(bruto_sgf, 0) AS DOUBLE) AS diferencia
FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes AND a.cta_cte = b.cta_cte""")
def d_co1(spark, d):
    return fin(controls.works_vs_paid(net_loads(spark, d), V(spark, d, "payments")))


# ---------------------------------------------------------------- works status (D-EO*)

EO_YEARS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]


def _eo_sql(group: list[str], cur: int, years: list[str], where: str = "TRUE", total: str = "acum") -> str:
    g = ", ".join(group)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in group)
    piv = ",\n  ".join(f"CAST(coalesce(sum(CASE WHEN ejercicio = '{y}' THEN s END), 0) AS DOUBLE) AS \"{y}\""
                       for y in years)
    curso = "coalesce(sum(CASE WHEN wmax < 1 THEN s END), 0)"
    ant = f"coalesce(sum(CASE WHEN CAST(ejercicio AS INTEGER) < {cur} AND wprev1 THEN s END), 0)"
    return f"""
WITH d AS (SELECT {g}, obra, ejercicio, sum(importe) AS s, max(avance) AS mx, max(avance = 1) AS hit1
           FROM works WHERE {where} AND {nn} GROUP BY ALL),
f AS (SELECT obra, max(mx) AS wmax, max(CASE WHEN CAST(ejercicio AS INTEGER) < {cur} THEN hit1 END) AS wprev1
      FROM d WHERE obra IS NOT NULL GROUP BY obra),
j AS (SELECT d.*, f.wmax, f.wprev1 FROM d LEFT JOIN f ON d.obra = f.obra)
SELECT {g}, min(ejercicio) AS alta,
  {piv},
  CAST(coalesce(sum(s), 0) AS DOUBLE) AS {total},
  CAST({curso} AS DOUBLE) AS en_curso,
  CAST({ant} AS DOUBLE) AS terminadas_ant,
  CAST(coalesce(sum(s), 0) - {curso} - {ant} AS DOUBLE) AS terminadas_actual
FROM j GROUP BY {g}"""


@query("d_eo5", _eo_sql(["actividad", "partida", "fuente", "obra"], 2000, EO_YEARS,
                        where="starts_with(actividad, 'Brand#1')", total="ejecucion_total"))
def d_eo5(spark, d):
    w = op.prefix_filter(V(spark, d, "works"), "actividad", prefix="Brand#1")
    return fin(works.works_report(w, ["actividad", "partida", "fuente", "obra"], "2000", pivot_years=EO_YEARS,
                                  total="ejecucion_total"))


@query("d_eo6", _eo_sql(["actividad", "partida", "fuente"], 2000, ["1999", "2000", "2001"]))
def d_eo6(spark, d):
    return fin(works.works_report(V(spark, d, "works"), ["actividad", "partida", "fuente"], "2000",
                                  pivot_years=["1999", "2000", "2001"]))


@query("d_eo7", """
WITH y AS (SELECT DISTINCT ejercicio AS hasta FROM works WHERE ejercicio IS NOT NULL),
d AS (SELECT actividad, partida, obra, ejercicio, sum(importe) AS s, max(avance) AS mx FROM works
      WHERE actividad IS NOT NULL AND partida IS NOT NULL GROUP BY ALL),
wy AS (SELECT obra, ejercicio, max(mx) AS mx FROM d WHERE obra IS NOT NULL GROUP BY ALL),
wf AS (SELECT w.obra, y.hasta, max(w.mx) AS mx_le,
              max(CASE WHEN CAST(w.ejercicio AS INTEGER) < CAST(y.hasta AS INTEGER) THEN w.mx END) AS mx_lt
       FROM wy w JOIN y ON CAST(w.ejercicio AS INTEGER) <= CAST(y.hasta AS INTEGER) GROUP BY ALL),
e AS (SELECT d.*, y.hasta FROM d JOIN y ON CAST(d.ejercicio AS INTEGER) <= CAST(y.hasta AS INTEGER)),
a AS (SELECT e.actividad, e.partida, e.hasta,
             coalesce(sum(e.s), 0) AS acum,
             coalesce(sum(CASE WHEN e.ejercicio = e.hasta THEN e.s END), 0) AS ejecucion,
             coalesce(sum(CASE WHEN wf.mx_le < 1 THEN e.s END), 0) AS en_curso,
             coalesce(sum(CASE WHEN CAST(e.ejercicio AS INTEGER) < CAST(e.hasta AS INTEGER) AND wf.mx_lt = 1
                               THEN e.s END), 0) AS terminadas_ant
      FROM e LEFT JOIN wf ON e.obra = wf.obra AND e.hasta = wf.hasta GROUP BY ALL),
al AS (SELECT actividad, partida, min(ejercicio) AS alta FROM d GROUP BY ALL)
SELECT al.actividad || '-' || al.partida AS estructura, al.alta, a.hasta AS ejercicio,
       CAST(acum AS DOUBLE) AS acum, CAST(en_curso AS DOUBLE) AS en_curso,
       CAST(terminadas_ant AS DOUBLE) AS terminadas_ant, CAST(ejecucion AS DOUBLE) AS ejecucion,
       CAST(acum - en_curso - terminadas_ant AS DOUBLE) AS terminadas_actual
FROM al JOIN a ON al.actividad = a.actividad AND al.partida = a.partida""")
def d_eo7(spark, d):
    return fin(works.works_ledger_for_accounting(V(spark, d, "works"), ["actividad", "partida"], from_year=None))


def _sheet(spark, d):
    """Opening sheet: orders as rows; some are programme headings, some project headings, the rest balances."""
    k = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    program, work = F.floor(k / 64) % 7, k % 8
    o = V(spark, d, "orders_raw").withColumns({
        "prog": two(program), "subprog": F.lit("00"), "proy": F.when(k % 64 >= 4, two(F.floor(k / 8) % 8)),
        "obra": F.when((k % 64 >= 4) & (work >= 1), two(work))})
    act = F.concat_ws("-", "prog", "subprog", "proy", "obra")
    line = F.when(k % 2 == 0, "421").otherwise("422")
    detail = F.col("obra").isNotNull()
    return o.select(k.alias("row_no"), "prog", "subprog", "proy", "obra", F.col("o_orderpriority").alias("descripcion"),
                    F.when(detail, F.concat_ws("-", act, line)).alias("estructura"), F.when(detail, act).alias("actividad"),
                    F.when(detail, line).alias("partida"), F.when(detail, F.lit("2008")).alias("alta"),
                    F.when(detail, F.col("o_totalprice").cast("decimal(18,2)")).alias("acum_2008"))


SHEET_SQL = """
k AS (SELECT o_orderkey AS row_no, o_orderpriority AS descripcion, CAST(o_totalprice AS DECIMAL(18,2)) AS price, '00' AS subprog,
             lpad(CAST((o_orderkey // 64) % 7 AS VARCHAR), 2, '0') AS prog,
             CASE WHEN o_orderkey % 64 >= 4 THEN lpad(CAST((o_orderkey // 8) % 8 AS VARCHAR), 2, '0') END AS proy,
             CASE WHEN o_orderkey % 64 >= 4 AND o_orderkey % 8 >= 1 THEN lpad(CAST(o_orderkey % 8 AS VARCHAR), 2, '0') END AS obra,
             CASE WHEN o_orderkey % 2 = 0 THEN '421' ELSE '422' END AS line FROM orders),
h AS (SELECT *, CASE WHEN proy IS NULL THEN prog || ' - ' || descripcion END AS hp, CASE WHEN obra IS NULL THEN proy || ' - ' || descripcion END AS hy FROM k),
fl AS (SELECT *, last_value(hp IGNORE NULLS) OVER w AS desc_prog, last_value(hy IGNORE NULLS) OVER w AS desc_proy
       FROM h WINDOW w AS (ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ob AS (SELECT desc_prog, subprog || ' - --' AS desc_subprog, desc_proy, obra || ' - ' || descripcion AS desc_act,
              prog || '-00-' || proy || '-' || obra AS actividad, line AS partida, prog || '-00-' || proy || '-' || obra || '-' || line AS estructura,
              '2008' AS alta, price AS acum_2008 FROM fl WHERE obra IS NOT NULL)"""


@query("d_eo8", f"""
WITH {SHEET_SQL}
SELECT * REPLACE (CAST(acum_2008 AS DOUBLE) AS acum_2008) FROM ob""")
def d_eo8(spark, d):
    return fin(works.opening_balances(_sheet(spark, d)))


@query("d_eo7_opening", f"""
WITH {SHEET_SQL},
ld AS (SELECT DISTINCT actividad || '-' || partida AS e, actividad FROM works),
wk AS (SELECT lpad(CAST(CAST(obra AS BIGINT) % 7 AS VARCHAR), 2, '0') || '-00-' || lpad(CAST(CAST(obra AS BIGINT) % 8 AS VARCHAR), 2, '0') || '-01' AS actividad,
              CASE WHEN partida = 'A' THEN '421' ELSE '422' END AS partida, obra, ejercicio, importe, avance, 'work ' || partida AS desc_act FROM works),
ref AS (SELECT actividad || '-' || partida AS estructura, min(desc_act) AS desc_act FROM wk GROUP BY 1),
op AS (SELECT ob.actividad, ob.partida, ob.desc_act AS obra, '2008' AS ejercicio, ob.acum_2008 AS importe, 1.0 AS avance,
              CASE WHEN ref.estructura IS NULL THEN ob.desc_act ELSE ref.desc_act END AS desc_act
       FROM ob LEFT JOIN ref USING (estructura)),
al AS (SELECT actividad, partida, obra, ejercicio, importe, avance, desc_act FROM wk UNION ALL SELECT actividad, partida, obra, ejercicio, importe, avance, desc_act FROM op),
dd AS (SELECT desc_act, actividad, partida, obra, CAST(ejercicio AS INTEGER) AS y, sum(importe) AS s, max(avance) AS mx FROM al
       WHERE desc_act IS NOT NULL AND actividad IS NOT NULL AND partida IS NOT NULL AND ejercicio IS NOT NULL GROUP BY ALL),
ys AS (SELECT DISTINCT y AS h FROM dd),
wy AS (SELECT obra, y, max(mx) AS mx FROM dd GROUP BY ALL),
wf AS (SELECT obra, h, max(mx) AS le, max(CASE WHEN y < h THEN mx END) AS lt FROM wy JOIN ys ON y <= h GROUP BY ALL),
a AS (SELECT desc_act, actividad, partida, dd_h AS h, sum(s) AS acum, coalesce(sum(CASE WHEN y = dd_h THEN s END), 0) AS ejecucion,
             coalesce(sum(CASE WHEN le < 1 THEN s END), 0) AS en_curso, coalesce(sum(CASE WHEN y < dd_h AND lt = 1 THEN s END), 0) AS terminadas_ant
      FROM (SELECT dd.*, ys.h AS dd_h, wf.le, wf.lt FROM dd JOIN ys ON dd.y <= ys.h LEFT JOIN wf ON wf.obra = dd.obra AND wf.h = ys.h) GROUP BY ALL),
fy AS (SELECT desc_act, actividad, partida, CAST(min(y) AS VARCHAR) AS alta FROM dd GROUP BY ALL)
SELECT a.desc_act, a.actividad || '-' || a.partida AS estructura, alta, CAST(h AS VARCHAR) AS ejercicio, CAST(acum AS DOUBLE) AS acum,
       CAST(en_curso AS DOUBLE) AS en_curso, CAST(terminadas_ant AS DOUBLE) AS terminadas_ant, CAST(ejecucion AS DOUBLE) AS ejecucion,
       CAST(acum - en_curso - terminadas_ant AS DOUBLE) AS terminadas_actual
FROM a JOIN fy USING (desc_act, actividad, partida)""")
def d_eo7_opening(spark, d):
    """The 2008 opening sheet (D-EO8) through the as-of-year report."""
    code = lambda m: F.lpad((F.col("obra").cast("long") % m).cast("string"), 2, "0")
    w = V(spark, d, "works").select(
        F.concat_ws("-", code(7), F.lit("00"), code(8), F.lit("01")).alias("actividad"),
        F.when(F.col("partida") == "A", "421").otherwise("422").alias("partida"), "obra", "ejercicio", "importe", "avance",
        F.concat(F.lit("work "), "partida").alias("desc_act"))
    return fin(works.works_ledger_for_accounting(w, ["desc_act", "actividad", "partida"], from_year=None,
                                                 opening=works.opening_balances(_sheet(spark, d))))


# ---------------------------------------------------------------- netting views (D-NET3, D-NET4)

def _payroll_vouchers(spark, d):
    return V(spark, d, "loads").filter(F.col("tipo") == "CYO").select("ejercicio", "nro_comprobante", "mes",
                                                                      "cta_cte", "importe")


def net_vouchers(spark, d, years=("1998", "1999")):
    return op.net_pending_semi(_payroll_vouchers(spark, d), V(spark, d, "snapshots"), list(years))


NET3_SQL = f"""
v AS (SELECT ejercicio, nro_comprobante, mes, cta_cte, importe FROM loads WHERE tipo = 'CYO'),
{FIRST_SNAP_SQL},
{LAST_SNAP_SQL},
neg2 AS (SELECT nro_comprobante, mes, ejercicio, cuit, CAST(NULL AS DATE) AS fecha, -saldo AS importe FROM (
           SELECT *, row_number() OVER (PARTITION BY nro_comprobante, mes ORDER BY fecha_hasta ASC NULLS LAST,
               saldo ASC NULLS LAST, ejercicio ASC NULLS LAST, cuit ASC NULLS LAST) AS rn FROM snapshots)
         WHERE rn = 1 AND nro_comprobante IN (SELECT nro_comprobante FROM v)),
lst AS (SELECT nro_comprobante, cuit, saldo, fecha_hasta FROM (
           SELECT *, row_number() OVER (PARTITION BY nro_comprobante ORDER BY fecha_hasta DESC NULLS FIRST,
               saldo DESC NULLS FIRST, ejercicio DESC NULLS FIRST, cuit DESC NULLS FIRST) AS rn FROM snapshots)
        WHERE rn = 1),
pos AS (SELECT nro_comprobante, strftime(fecha_hasta + INTERVAL 1 MONTH, '%m/%Y') AS mes,
               CAST(year(fecha_hasta + INTERVAL 1 MONTH) AS VARCHAR) AS ejercicio, cuit,
               CAST(fecha_hasta + INTERVAL 1 MONTH AS DATE) AS fecha, saldo AS importe
        FROM lst WHERE nro_comprobante IN (SELECT nro_comprobante FROM v)
          AND CAST(year(fecha_hasta + INTERVAL 1 MONTH) AS VARCHAR) IN ('1998', '1999')),
net3 AS (SELECT ejercicio, nro_comprobante, mes, cta_cte, importe, NULL AS cuit, CAST(NULL AS DATE) AS fecha,
                NULL AS clase_reg, NULL AS clase_mod, NULL AS clase_gto, CAST(NULL AS BOOLEAN) AS es_comprometido,
                CAST(NULL AS BOOLEAN) AS es_verificado, CAST(NULL AS BOOLEAN) AS es_aprobado,
                CAST(NULL AS BOOLEAN) AS es_pagado FROM v
         UNION ALL
         SELECT ejercicio, nro_comprobante, mes, NULL, importe, cuit, fecha, 'CYO', 'NOR', 'RDEU', true, true, true, true
         FROM (SELECT * FROM neg2 UNION ALL SELECT * FROM pos))"""


@query("d_net3", f"""
WITH {NET3_SQL}
SELECT ejercicio, nro_comprobante, mes, cta_cte, CAST(importe AS DOUBLE) AS importe, cuit, fecha, clase_reg,
       clase_mod, clase_gto, es_comprometido, es_verificado, es_aprobado, es_pagado FROM net3""")
def d_net3(spark, d):
    n = net_vouchers(spark, d)
    return fin(n.select("ejercicio", "nro_comprobante", "mes", "cta_cte", "importe", "cuit", "fecha", "clase_reg",
                        "clase_mod", "clase_gto", "es_comprometido", "es_verificado", "es_aprobado", "es_pagado"))


@query("d_net4", """
SELECT nro_comprobante, mes, fecha_hasta, CAST(saldo AS DOUBLE) AS saldo FROM snapshots
WHERE ejercicio = '1999'
  AND strptime(mes, '%m/%Y') = (SELECT max(strptime(mes, '%m/%Y')) FROM snapshots WHERE ejercicio = '1999')""")
def d_net4(spark, d):
    s = op.years(V(spark, d, "snapshots"), "1999", date_col="fecha_hasta")
    return fin(op.latest_period(s, "mes").select("nro_comprobante", "mes", "fecha_hasta", "saldo"))


@query("d_hb1", f"""
WITH {NET3_SQL},
a AS (SELECT ejercicio, mes, sum(importe) AS ejecutado_siif FROM net3
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL GROUP BY ALL),
b AS (SELECT ejercicio, mes, sum(importe_neto) AS pagado_sscc FROM payments
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL GROUP BY ALL),
r AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
             coalesce(ejecutado_siif, 0) AS ejecutado_siif, coalesce(pagado_sscc, 0) AS pagado_sscc,
             coalesce(ejecutado_siif, 0) - coalesce(pagado_sscc, 0) AS diferencia
      FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes)
SELECT ejercicio, mes, CAST(ejecutado_siif AS DOUBLE) AS ejecutado_siif, CAST(pagado_sscc AS DOUBLE) AS pagado_sscc,
       CAST(diferencia AS DOUBLE) AS diferencia,
       CAST(sum(diferencia) OVER (ORDER BY ejercicio, mes ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS dif_acum
FROM r""")
def d_hb1(spark, d):
    paid = V(spark, d, "payments").withColumnRenamed("importe_neto", "importe")
    return fin(controls.payroll_vs_paid(net_vouchers(spark, d), paid))


@query("d_sg1", """
WITH a AS (SELECT mes, cta_cte, sum(importe_neto) AS neto_sgf, sum(retenciones) AS retenciones_sgf FROM payments
           WHERE mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
     b AS (SELECT mes, cta_cte, sum(-importe) AS debitos_sscc FROM bank
           WHERE movimiento IS DISTINCT FROM 'DEPOSITO' AND cod_imputacion IS DISTINCT FROM 'error'
             AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
     r AS (SELECT coalesce(a.mes, b.mes) AS mes, coalesce(a.cta_cte, b.cta_cte) AS cta_cte,
                  coalesce(neto_sgf, 0) AS neto_sgf, coalesce(retenciones_sgf, 0) AS retenciones_sgf,
                  coalesce(debitos_sscc, 0) AS debitos_sscc
           FROM a FULL JOIN b ON a.mes = b.mes AND a.cta_cte = b.cta_cte)
SELECT mes, cta_cte, CAST(neto_sgf AS DOUBLE) AS neto_sgf, CAST(retenciones_sgf AS DOUBLE) AS retenciones_sgf,
       CAST(debitos_sscc AS DOUBLE) AS debitos_sscc,
       CAST(neto_sgf + retenciones_sgf - debitos_sscc AS DOUBLE) AS diferencia
FROM r WHERE abs(neto_sgf + retenciones_sgf - debitos_sscc) >= 0.1""")
def d_sg1(spark, d):
    return fin(controls.payments_vs_bank(V(spark, d, "payments"), V(spark, d, "bank"), debit_code="error"))


def _iv_payments(spark, d):
    """The renditions in the columns of both sides, joined and written once."""
    return materialize(V(spark, d, "payments").select("ejercicio", "nro_comprobante", "importe_bruto", "mes", "cta_cte", "cuit", "codigo"), "payments")


def _iv_ledger(payments):
    """Ledger lines: renditions with a fund number on every third voucher."""
    nro = F.col("nro_comprobante").cast("long")
    return payments.select(
        "ejercicio", "nro_comprobante", F.col("importe_bruto").alias("importe"), "mes", "cta_cte", "cuit",
        F.col("codigo").alias("partida"), F.concat(F.lit("1"), F.substring("cuit", -1, 1)).alias("fuente"),
        F.when(nro % 2 == 0, "REG").otherwise("CYO").alias("clase_reg"),
        F.when(nro % 3 == 0, F.col("nro_comprobante")).alias("nro_fondo"))


def _iv_loads(payments):
    """Loads of the same works, with a gap, another type, line, amount, month, account, tax id or fund in some vouchers."""
    nro = F.col("nro_comprobante").cast("long")
    led = _iv_ledger(payments).filter(nro % 13 != 0)
    return led.select(
        "ejercicio", F.when(nro % 17 == 0, F.concat(F.lit("x"), "nro_comprobante")).otherwise(F.col("nro_comprobante")).alias("nro_comprobante"),
        F.when(nro % 11 == 0, F.col("importe") + 1).otherwise(F.col("importe")).alias("importe"),
        F.when(nro % 19 == 0, "01/1990").otherwise(F.col("mes")).alias("mes"),
        F.when(nro % 23 != 0, F.col("cta_cte")).alias("cta_cte"),
        F.when(nro % 29 == 0, "0").otherwise(F.col("cuit")).alias("cuit"),
        F.when((nro % 7 == 0) & (F.col("partida") == "A"), "Z").otherwise(F.col("partida")).alias("partida"),
        F.when(nro % 31 == 0, "99").otherwise(F.col("fuente")).alias("fuente"),
        F.when((nro % 2 == 0) & (nro % 3 == 0), "REG").when(nro % 37 == 0, "PA6").otherwise("CYO").alias("tipo"))


IV_SQL = """
led0 AS (SELECT ejercicio, nro_comprobante, importe_bruto AS importe, mes, cta_cte, cuit, codigo AS partida,
                '1' || right(cuit, 1) AS fuente, CASE WHEN CAST(nro_comprobante AS BIGINT) % 2 = 0 THEN 'REG' ELSE 'CYO' END AS clase_reg,
                CASE WHEN CAST(nro_comprobante AS BIGINT) % 3 = 0 THEN nro_comprobante END AS nro_fondo,
                CAST(nro_comprobante AS BIGINT) AS n FROM payments),
ic0 AS (SELECT ejercicio, CASE WHEN n % 17 = 0 THEN 'x' || nro_comprobante ELSE nro_comprobante END AS nro_comprobante,
               CASE WHEN n % 11 = 0 THEN importe + 1 ELSE importe END AS importe,
               CASE WHEN n % 19 = 0 THEN '01/1990' ELSE mes END AS mes, CASE WHEN n % 23 <> 0 THEN cta_cte END AS cta_cte,
               CASE WHEN n % 29 = 0 THEN '0' ELSE cuit END AS cuit, CASE WHEN n % 7 = 0 AND partida = 'A' THEN 'Z' ELSE partida END AS partida,
               CASE WHEN n % 31 = 0 THEN '99' ELSE fuente END AS fuente,
               CASE WHEN n % 2 = 0 AND n % 3 = 0 THEN 'REG' WHEN n % 37 = 0 THEN 'PA6' ELSE 'CYO' END AS tipo
        FROM led0 WHERE n % 13 <> 0)"""


@query("d_iv2", f"""
WITH {IV_SQL},
led AS (SELECT *, CASE WHEN clase_reg = 'REG' AND nro_fondo IS NULL THEN 'CYO' ELSE clase_reg END AS tipo FROM led0),
lg AS (SELECT * FROM (SELECT *, sum(importe) OVER k AS total, row_number() OVER (k ORDER BY tipo NULLS LAST, fuente NULLS LAST, mes NULLS LAST,
                             cta_cte NULLS LAST, cuit NULLS LAST) AS rn FROM led WINDOW k AS (PARTITION BY ejercicio, nro_comprobante, partida)) WHERE rn = 1),
ic AS (SELECT * FROM (SELECT *, sum(importe) OVER k AS total, row_number() OVER (k ORDER BY tipo NULLS LAST, fuente NULLS LAST, mes NULLS LAST,
                             cta_cte NULLS LAST, cuit NULLS LAST) AS rn FROM ic0 WHERE tipo IS DISTINCT FROM 'PA6'
                             WINDOW k AS (PARTITION BY ejercicio, nro_comprobante, partida)) WHERE rn = 1),
l1 AS (SELECT lg.*, CASE WHEN ic.nro_comprobante IS NOT NULL THEN lg.partida ELSE CAST(row_number() OVER (
         PARTITION BY lg.ejercicio, lg.nro_comprobante, ic.nro_comprobante IS NULL ORDER BY lg.partida) AS VARCHAR) END AS slot
       FROM lg LEFT JOIN ic USING (ejercicio, nro_comprobante, partida)),
i1 AS (SELECT ic.*, CASE WHEN lg.nro_comprobante IS NOT NULL THEN ic.partida ELSE CAST(row_number() OVER (
         PARTITION BY ic.ejercicio, ic.nro_comprobante, lg.nro_comprobante IS NULL ORDER BY ic.partida) AS VARCHAR) END AS slot
       FROM ic LEFT JOIN lg USING (ejercicio, nro_comprobante, partida)),
m AS (SELECT coalesce(l.ejercicio, i.ejercicio) AS ejercicio, l.nro_comprobante AS siif_nro, i.nro_comprobante AS icaro_nro,
             l.tipo AS siif_tipo, i.tipo AS icaro_tipo, l.fuente AS siif_fuente, i.fuente AS icaro_fuente,
             coalesce(l.total, 0) AS siif_importe, coalesce(i.total, 0) AS icaro_importe, l.mes AS siif_mes, i.mes AS icaro_mes,
             l.cta_cte AS siif_cta_cte, i.cta_cte AS icaro_cta_cte, l.cuit AS siif_cuit, i.cuit AS icaro_cuit,
             l.partida AS siif_partida, i.partida AS icaro_partida
      FROM l1 l FULL JOIN i1 i ON l.ejercicio = i.ejercicio AND l.nro_comprobante = i.nro_comprobante AND l.slot = i.slot),
f AS (SELECT *, coalesce(siif_nro <> icaro_nro, true) AS err_nro, coalesce(siif_tipo <> icaro_tipo, true) AS err_tipo,
             coalesce(siif_fuente <> icaro_fuente, true) AS err_fuente, abs(siif_importe - icaro_importe) > 0.1 AS err_importe,
             coalesce(siif_mes <> icaro_mes, true) AS err_mes, coalesce(siif_cta_cte <> icaro_cta_cte, true) AS err_cta_cte,
             coalesce(siif_cuit <> icaro_cuit, true) AS err_cuit, coalesce(siif_partida <> icaro_partida, true) AS err_partida FROM m)
SELECT * REPLACE (CAST(siif_importe AS DOUBLE) AS siif_importe, CAST(icaro_importe AS DOUBLE) AS icaro_importe) FROM f
WHERE err_nro OR err_tipo OR err_fuente OR err_importe OR err_mes OR err_cta_cte OR err_cuit OR err_partida""")
def d_iv2(spark, d):
    payments = _iv_payments(spark, d)
    out = controls.voucher_control(_iv_ledger(payments), _iv_loads(payments))
    sides = [f"{s}_{a}" for a in ("nro", "tipo", "fuente", "importe", "mes", "cta_cte", "cuit", "partida") for s in ("siif", "icaro")]
    return fin(out.select("ejercicio", *sides, *[f"err_{a}" for a in ("nro", "tipo", "fuente", "importe", "mes", "cta_cte", "cuit", "partida")]))


# ---------------------------------------------------------------- bank (D-FC1, D-CB2)

BANK_CLASSES = {"1 - Recursos": ["purchase", "signup"], "2 - Gtos. Funcionamiento": ["click"],
                "3 - Inversión Obras": ["view"]}


@query("d_fc1", """
SELECT ejercicio, CASE WHEN cod_imputacion IN ('purchase', 'signup') THEN '1 - Recursos'
                       WHEN cod_imputacion IN ('click') THEN '2 - Gtos. Funcionamiento'
                       WHEN cod_imputacion IN ('view') THEN '3 - Inversión Obras' ELSE '4 - OTROS' END AS clase,
       CAST(sum(importe) AS DOUBLE) AS importe
FROM bank WHERE ejercicio IS NOT NULL GROUP BY ALL""")
def d_fc1(spark, d):
    return fin(bank.yearly_cash_flow(V(spark, d, "bank"), BANK_CLASSES))


@query("d_cb2", """
WITH dly AS (SELECT cta_cte, fecha, sum(importe) AS v FROM bank
             WHERE cta_cte IS NOT NULL AND fecha IS NOT NULL GROUP BY ALL),
     cum AS (SELECT cta_cte, fecha, sum(v) OVER (PARTITION BY cta_cte ORDER BY fecha
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS saldo FROM dly),
     lst AS (SELECT ejercicio, mes, fecha AS dia, cta_cte, max(fecha) AS fecha FROM bank
             WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND fecha IS NOT NULL AND cta_cte IS NOT NULL
             GROUP BY ALL)
SELECT lst.ejercicio, lst.mes, lst.dia, lst.cta_cte, CAST(cum.saldo AS DOUBLE) AS saldo
FROM lst JOIN cum ON lst.cta_cte = cum.cta_cte AND lst.fecha = cum.fecha""")
def d_cb2(spark, d):
    b = V(spark, d, "bank").withColumn("dia", F.col("fecha"))
    return fin(bank.running_balance_at_period_end(b, keys=["ejercicio", "mes", "dia", "cta_cte"]))


# ---------------------------------------------------------------- receivables (D-RC5, D-RC6, D-RC12)

def _reasons(spark, d):
    p = V(spark, d, "payments").select("ejercicio", F.col("codigo").alias("cod_motivo"),
                                       F.col("codigo").alias("motivo"), F.col("retenciones").alias("importe"))
    return op.group_sum(p, ["ejercicio", "cod_motivo", "motivo"], ["importe"])


REASONS_SQL = """
r AS (SELECT ejercicio, codigo AS cod_motivo, codigo AS motivo, sum(retenciones) AS importe FROM payments
      WHERE ejercicio IS NOT NULL AND codigo IS NOT NULL GROUP BY ALL)"""


@query("d_rc5", f"""
WITH {REASONS_SQL},
y AS (SELECT ejercicio, cod_motivo, motivo, abs(importe) AS importe FROM r WHERE ejercicio = '1998')
SELECT ejercicio, cod_motivo, motivo, CAST(importe AS DOUBLE) AS importe,
       CAST(importe AS DOUBLE) / CAST(sum(importe) OVER () AS DOUBLE) * 100.0 AS participacion,
       CAST(row_number() OVER (ORDER BY importe DESC, cod_motivo) AS BIGINT) AS ranking
FROM y""")
def d_rc5(spark, d):
    return fin(receivables.reason_ranking(_reasons(spark, d), "1998"))


@query("d_rc6", f"""
WITH {REASONS_SQL},
dd AS (SELECT ejercicio, cod_motivo, motivo, abs(importe) AS importe,
              CAST(abs(importe) AS DOUBLE) / CAST(sum(abs(importe)) OVER (PARTITION BY ejercicio) AS DOUBLE) * 100.0
                AS participacion FROM r),
t AS (SELECT cod_motivo FROM dd WHERE ejercicio = '1998' GROUP BY cod_motivo
      ORDER BY sum(abs(importe)) DESC, cod_motivo LIMIT 2),
f AS (SELECT ejercicio,
             CASE WHEN cod_motivo IN (SELECT cod_motivo FROM t) THEN cod_motivo ELSE 'OT' END AS cod_motivo,
             CASE WHEN cod_motivo IN (SELECT cod_motivo FROM t) THEN motivo ELSE 'OTROS MOTIVOS' END AS motivo,
             importe, participacion FROM dd)
SELECT ejercicio, cod_motivo, motivo, CAST(sum(importe) AS DOUBLE) AS importe, sum(participacion) AS participacion
FROM f GROUP BY ALL""")
def d_rc6(spark, d):
    return fin(receivables.top_reasons_over_time(_reasons(spark, d), "1998", n=2))


@query("d_rc12", """
WITH g AS (SELECT ejercicio, sum(importe_bruto) AS importe_bruto, sum(importe_neto) AS importe_neto,
                  sum(retenciones) AS retenciones FROM payments WHERE ejercicio = '1998' GROUP BY ALL),
l AS (SELECT ejercicio, 'importe_bruto' AS concepto, CAST(abs(importe_bruto) AS DECIMAL(38,4)) AS importe FROM g
      UNION ALL SELECT ejercicio, 'importe_neto', CAST(abs(importe_neto) AS DECIMAL(38,4)) FROM g
      UNION ALL SELECT ejercicio, 'retenciones', CAST(abs(retenciones) AS DECIMAL(38,4)) FROM g),
s AS (SELECT *, CAST(importe AS DOUBLE) / CAST(sum(importe) OVER (PARTITION BY ejercicio) AS DOUBLE) * 100.0
                AS participacion FROM l)
SELECT ejercicio, CASE WHEN rn <= 2 THEN concepto ELSE 'otros' END AS concepto,
       CAST(sum(importe) AS DOUBLE) AS importe, sum(participacion) AS participacion
FROM (SELECT *, row_number() OVER (PARTITION BY ejercicio ORDER BY importe DESC, concepto) AS rn FROM s) GROUP BY ALL""")
def d_rc12(spark, d):
    # the report's column order is not the order of the shares
    return fin(receivables.collected_composition(op.years(V(spark, d, "payments"), "1998", date_col="fecha"), "1998", n=2,
                                                 concepts=["retenciones", "importe_neto", "importe_bruto"]))


# ---------------------------------------------------------------- D-CO4, D-CR2, D-RT2

@query("d_co4", f"""
WITH {NET_SQL},
a AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS icaro_total FROM net
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
b AS (SELECT ejercicio, mes, cta_cte, sum(importe_bruto) AS sgf_total FROM payments
      WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
t AS (SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
             coalesce(a.cta_cte, b.cta_cte) AS cta_cte, coalesce(icaro_total, 0) AS icaro_total,
             coalesce(sgf_total, 0) AS sgf_total, coalesce(icaro_total, 0) - coalesce(sgf_total, 0) AS diferencia
      FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes AND a.cta_cte = b.cta_cte),
dd AS (SELECT ejercicio, mes, cta_cte, 'icaro' AS lado, id AS icaro_id, tipo AS icaro_tipo, importe AS icaro_importe,
              NULL AS sgf_nro_comprobante, NULL AS sgf_importe_bruto FROM net
       UNION ALL
       SELECT ejercicio, mes, cta_cte, 'sgf', NULL, NULL, NULL, nro_comprobante, importe_bruto FROM payments)
SELECT dd.ejercicio, dd.mes, dd.cta_cte, lado, icaro_id, icaro_tipo, CAST(icaro_importe AS DOUBLE) AS icaro_importe,
       sgf_nro_comprobante, CAST(sgf_importe_bruto AS DOUBLE) AS sgf_importe_bruto,
       CAST(icaro_total AS DOUBLE) AS icaro_total, CAST(sgf_total AS DOUBLE) AS sgf_total,
       CAST(diferencia AS DOUBLE) AS diferencia
FROM dd LEFT JOIN t ON dd.ejercicio = t.ejercicio AND dd.mes = t.mes AND dd.cta_cte = t.cta_cte""")
def d_co4(spark, d):
    a = net_loads(spark, d).select(*KEYS3, "id", "tipo", "importe")
    b = V(spark, d, "payments").select(*KEYS3, "nro_comprobante", "importe_bruto")
    out = controls.works_vs_paid_detail(a, b)
    return fin(out.select(*KEYS3, "lado", "icaro_id", "icaro_tipo", "icaro_importe", "sgf_nro_comprobante",
                          "sgf_importe_bruto", "icaro_total", "sgf_total", "diferencia"))


GROUP_SQL = ("CASE WHEN cta_cte = '10270' THEN 'FONAVI' "
             "WHEN cta_cte IN ('130832-12', '334', 'Macro', 'Patagonia') THEN 'RECUPEROS' ELSE 'OTROS' END")


#: Segments that stand for the accounts of the two fund groups.
FUND_ACCOUNTS = {"AUTOMOBILE": "10270", "BUILDING": "334", "FURNITURE": "Patagonia"}
FUND_SQL = "CASE cta_cte " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FUND_ACCOUNTS.items()) + " ELSE cta_cte END"


def _fund_accounts(df):
    return df.replace(FUND_ACCOUNTS, subset=["cta_cte"])


@query("d_cr2", f"""
WITH lf AS (SELECT ejercicio, mes, importe, {FUND_SQL} AS cta_cte FROM loads),
     bf AS (SELECT ejercicio, mes, importe, movimiento, {FUND_SQL} AS cta_cte FROM bank),
     a AS (SELECT ejercicio, mes, cta_cte, {GROUP_SQL} AS grupo, sum(importe) AS recursos_siif FROM lf
           WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
     b AS (SELECT ejercicio, mes, cta_cte, {GROUP_SQL} AS grupo, sum(importe) AS depositos_banco FROM bf
           WHERE movimiento = 'DEPOSITO' AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL
           GROUP BY ALL)
SELECT coalesce(a.ejercicio, b.ejercicio) AS ejercicio, coalesce(a.mes, b.mes) AS mes,
       coalesce(a.cta_cte, b.cta_cte) AS cta_cte, coalesce(a.grupo, b.grupo) AS grupo,
       CAST(recursos_siif AS DOUBLE) AS recursos_siif, CAST(depositos_banco AS DOUBLE) AS depositos_banco
FROM a FULL JOIN b ON a.ejercicio = b.ejercicio AND a.mes = b.mes AND a.cta_cte = b.cta_cte AND a.grupo = b.grupo""")
def d_cr2(spark, d):
    rev = _fund_accounts(V(spark, d, "loads")).withColumns({"grupo": controls.fund_group("cta_cte"), "es_propio": F.lit(False),
                                                            "es_remanente": F.lit(False)})
    dep = controls.revenue_deposits(_fund_accounts(V(spark, d, "bank")))
    return fin(controls.revenue_vs_deposits_by_group(rev, dep))


@query("d_cr1", f"""
WITH a AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS recursos_siif FROM loads
           WHERE tipo <> 'PA6' AND tipo <> 'REG' AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
     b AS (SELECT ejercicio, mes, cta_cte, sum(importe) AS depositos_sscc FROM bank
           WHERE movimiento = 'DEPOSITO' AND ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL)
SELECT ejercicio, mes, cta_cte, CAST(coalesce(recursos_siif, 0) AS DOUBLE) AS recursos_siif,
       CAST(coalesce(depositos_sscc, 0) AS DOUBLE) AS depositos_sscc,
       CAST(coalesce(recursos_siif, 0) - coalesce(depositos_sscc, 0) AS DOUBLE) AS diferencia
FROM a FULL JOIN b USING (ejercicio, mes, cta_cte)""")
def d_cr1(spark, d):
    # advances stand for own funds, regularisations for carried-over ones
    rev = V(spark, d, "loads").withColumns({"es_propio": F.col("tipo") == "PA6", "es_remanente": F.col("tipo") == "REG"})
    return fin(controls.revenue_vs_deposits(rev, controls.revenue_deposits(V(spark, d, "bank"))))


RT2_SQL = """
w AS (SELECT nro_comprobante AS id_carga, codigo, retenciones AS importe FROM payments
      WHERE nro_comprobante IN (SELECT id FROM loads)),
p AS (SELECT id_carga,
             coalesce(sum(CASE WHEN codigo = 'A' THEN importe END), 0) AS a_,
             coalesce(sum(CASE WHEN codigo = 'N' THEN importe END), 0) AS n_,
             coalesce(sum(CASE WHEN codigo = 'R' THEN importe END), 0) AS r_
      FROM w WHERE id_carga IS NOT NULL GROUP BY id_carga),
j AS (SELECT l.*, coalesce(a_, 0) AS a_, coalesce(n_, 0) AS n_, coalesce(r_, 0) AS r_,
             coalesce(a_ + n_ + r_, 0) AS ret FROM loads l LEFT JOIN p ON l.id = p.id_carga),
rt2 AS (SELECT id, ejercicio, mes, fecha, cta_cte, tipo, fuente, cuit, a_, n_, r_,
               CASE WHEN importe < 0 THEN -ret ELSE ret END AS retenciones, importe AS importe_bruto,
               importe - CASE WHEN importe < 0 THEN -ret ELSE ret END AS importe_neto FROM j)"""


@query("d_rt2", f"""
WITH {RT2_SQL}
SELECT id, ejercicio, mes, fecha, cta_cte, tipo, fuente, cuit,
       CAST(a_ AS DOUBLE) AS "A", CAST(n_ AS DOUBLE) AS "N", CAST(r_ AS DOUBLE) AS "R",
       CAST(retenciones AS DOUBLE) AS retenciones, CAST(importe_bruto AS DOUBLE) AS importe_bruto,
       CAST(importe_neto AS DOUBLE) AS importe_neto
FROM rt2""")
def d_rt2(spark, d):
    wh = V(spark, d, "payments").select(F.col("nro_comprobante").alias("id_carga"), "codigo",
                                        F.col("retenciones").alias("importe"))
    out = withholdings.loads_with_withholdings(V(spark, d, "loads"), wh, codes=["A", "N", "R"])
    return fin(out.select("id", "ejercicio", "mes", "fecha", "cta_cte", "tipo", "fuente", "cuit", "A", "N", "R",
                          "retenciones", "importe_bruto", "importe_neto"))


@query("d_cb3", """
WITH fin AS (SELECT ejercicio, cta_cte, sum(importe) AS sldo_final FROM bank
             WHERE ejercicio IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL),
     dly AS (SELECT cta_cte, fecha, sum(importe) AS v FROM bank
             WHERE cta_cte IS NOT NULL AND fecha IS NOT NULL GROUP BY ALL),
     cum AS (SELECT cta_cte, fecha, sum(v) OVER (PARTITION BY cta_cte ORDER BY fecha
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS saldo FROM dly),
     lst AS (SELECT ejercicio, cta_cte, max(fecha) AS fecha FROM bank
             WHERE ejercicio IS NOT NULL AND cta_cte IS NOT NULL AND fecha IS NOT NULL GROUP BY ALL),
     acu AS (SELECT lst.ejercicio, lst.cta_cte, cum.saldo AS sldo_acum FROM lst
             JOIN cum ON lst.cta_cte = cum.cta_cte AND lst.fecha = cum.fecha)
SELECT coalesce(fin.ejercicio, acu.ejercicio) AS ejercicio, coalesce(fin.cta_cte, acu.cta_cte) AS cta_cte,
       CAST(coalesce(sldo_final, 0) AS DOUBLE) AS sldo_final, CAST(coalesce(sldo_acum, 0) AS DOUBLE) AS sldo_acum,
       CAST(coalesce(sldo_final, 0) - coalesce(sldo_acum, 0) AS DOUBLE) AS dif
FROM fin FULL JOIN acu ON fin.ejercicio = acu.ejercicio AND fin.cta_cte = acu.cta_cte""")
def d_cb3(spark, d):
    b = V(spark, d, "bank")
    final = op.group_sum(b, ["ejercicio", "cta_cte"], {"saldo": "importe"})
    running = bank.running_balance_at_period_end(b, keys=["ejercicio", "cta_cte"])
    return fin(bank.final_vs_running(final, running))


def _loads_with_withholdings(spark, d):
    wh = V(spark, d, "payments").select(F.col("nro_comprobante").alias("id_carga"), "codigo",
                                        F.col("retenciones").alias("importe"))
    return withholdings.loads_with_withholdings(V(spark, d, "loads"), wh, codes=["A", "N", "R"])


RT3_SQL = f"""{RT2_SQL},
rt3 AS (SELECT ejercicio, mes, cta_cte, sum(a_) AS a_, sum(n_) AS n_, sum(r_) AS r_, sum(retenciones) AS retenciones,
               sum(importe_bruto) AS importe_bruto, sum(importe_neto) AS importe_neto
        FROM rt2 WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL)"""


@query("d_rt3", f"""
WITH {RT3_SQL}
SELECT ejercicio, mes, cta_cte, CAST(a_ AS DOUBLE) AS "A", CAST(n_ AS DOUBLE) AS "N", CAST(r_ AS DOUBLE) AS "R",
       CAST(retenciones AS DOUBLE) AS retenciones, CAST(importe_bruto AS DOUBLE) AS importe_bruto,
       CAST(importe_neto AS DOUBLE) AS importe_neto
FROM rt3""")
def d_rt3(spark, d):
    return fin(withholdings.loads_summary(_loads_with_withholdings(spark, d)))


@query("d_rt11", f"""
WITH {RT3_SQL},
sg AS (SELECT ejercicio, mes, cta_cte, sum(importe_bruto) AS importe_bruto, sum(importe_neto) AS importe_neto,
              sum(retenciones) AS retenciones
       FROM payments WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL)
SELECT coalesce(rt3.ejercicio, sg.ejercicio) AS ejercicio, coalesce(rt3.mes, sg.mes) AS mes,
       coalesce(rt3.cta_cte, sg.cta_cte) AS cta_cte,
       CAST(0 AS DOUBLE) AS "A", CAST(0 AS DOUBLE) AS "N", CAST(0 AS DOUBLE) AS "R",
       CAST(coalesce(rt3.retenciones, 0) - coalesce(sg.retenciones, 0) AS DOUBLE) AS retenciones,
       CAST(coalesce(rt3.importe_bruto, 0) - coalesce(sg.importe_bruto, 0) AS DOUBLE) AS importe_bruto,
       CAST(coalesce(rt3.importe_neto, 0) - coalesce(sg.importe_neto, 0) AS DOUBLE) AS importe_neto
FROM rt3 FULL JOIN sg ON rt3.ejercicio = sg.ejercicio AND rt3.mes = sg.mes AND rt3.cta_cte = sg.cta_cte""")
def d_rt11(spark, d):
    icaro = withholdings.loads_summary(_loads_with_withholdings(spark, d))
    sgf = withholdings.renditions_summary(V(spark, d, "payments"))
    return fin(withholdings.compare(icaro, sgf, how="union", fold_lp=True))


@query("d_rt1", f"""
WITH {RT2_SQL}
SELECT id_carga, CAST(a_ AS DOUBLE) AS "A", CAST(n_ AS DOUBLE) AS "N", CAST(r_ AS DOUBLE) AS "R",
       CAST(a_ + n_ + r_ AS DOUBLE) AS retenciones
FROM p""")
def d_rt1(spark, d):
    wh = V(spark, d, "payments").select(F.col("nro_comprobante").alias("id_carga"), "codigo",
                                        F.col("retenciones").alias("importe"))
    return fin(withholdings.withholdings_per_load(V(spark, d, "loads"), wh, codes=["A", "N", "R"]))


@query("d_rc2", """
SELECT ejercicio, CAST(sum(saldo) AS DOUBLE) / 1000000000.0 AS saldo_actual FROM snapshots
WHERE ejercicio IS NOT NULL GROUP BY ejercicio""")
def d_rc2(spark, d):
    bal = V(spark, d, "snapshots").withColumnRenamed("saldo", "saldo_actual")
    return receivables.balance_per_year(bal)


@query("d_co2", r"""
SELECT ltrim(regexp_replace(p_name, '^\d+-\d+', '')) AS obra_sin_cod, p_brand || '-' || p_type AS imputacion,
       p_name AS obra, p_brand AS actividad, p_type AS partida, CAST(p_partkey AS VARCHAR) AS cod
FROM part""")
def d_co2(spark, d):
    parts = spark.read.parquet(f"{d}/part.parquet").select(
        F.col("p_name").alias("obra"), F.col("p_brand").alias("actividad"), F.col("p_type").alias("partida"),
        F.col("p_partkey").cast("string").alias("cod"))
    return controls.works_list(parts)


@query("d_cb1", """
SELECT ejercicio, mes, cta_cte, CAST(sum(importe) AS DOUBLE) AS importe FROM bank
WHERE ejercicio IS NOT NULL AND mes IS NOT NULL AND cta_cte IS NOT NULL GROUP BY ALL""")
def d_cb1(spark, d):
    return fin(bank.ledger_bank_summary(V(spark, d, "bank")))
