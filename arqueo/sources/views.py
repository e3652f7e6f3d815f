"""Domain views over the driver's generated tables.

Each view exists twice: as a Spark DataFrame (what the engine runs) and as
DuckDB SQL (what the correctness oracle runs).  Both must stay equal.

| view      | built from                         | plays                              |
|-----------|------------------------------------|------------------------------------|
| loads     | orders JOIN customer               | works loads / ledger vouchers       |
| payments  | lineitem JOIN orders JOIN customer | payment renditions                  |
| snapshots | lineitem with l_linestatus = 'O'   | floating-debt snapshots             |
| works     | lineitem JOIN part                 | works progress and execution        |
| bank      | events                             | bank movements                      |
| acct_map  | nation JOIN region                 | account code map (one NULL code)    |
| headings  | conversations                      | heading rows of a spreadsheet       |
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import month_of, year_of

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderkey").cast("string").alias("nro_comprobante"),
        year_of("o_orderdate").alias("ejercicio"),
        month_of("o_orderdate").alias("mes"),
        F.to_date("o_orderdate").alias("fecha"),
        F.col("c_mktsegment").alias("cta_cte"),
        F.when(F.col("o_orderstatus") == "P", "PA6").when(F.col("o_orderstatus") == "F", "REG")
        .otherwise("CYO").alias("tipo"),
        F.concat(F.lit("1"), F.substring("o_orderpriority", 1, 1)).alias("fuente"),
        F.col("o_custkey").cast("string").alias("cuit"),
        F.col("o_totalprice").cast(MONEY).alias("importe"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name")
    price = F.col("l_extendedprice").cast(MONEY)
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .join(c, F.col("o_custkey") == c.c_custkey, "inner")
            .select(
                F.col("l_orderkey").cast("string").alias("nro_comprobante"),
                year_of("l_shipdate").alias("ejercicio"),
                month_of("l_shipdate").alias("mes"),
                F.to_date("l_shipdate").alias("fecha"),
                F.col("c_mktsegment").alias("cta_cte"),
                F.col("o_custkey").cast("string").alias("cuit"),
                F.col("c_name").alias("beneficiario"),
                F.col("l_returnflag").alias("codigo"),
                price.alias("importe_bruto"),
                (price * (F.lit(1) - F.col("l_discount").cast(RATE))).alias("importe_neto"),
                (price * F.col("l_tax").cast(RATE)).alias("retenciones"),
            ))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_linestatus") == "O").select(
        F.col("l_orderkey").cast("string").alias("nro_comprobante"),
        year_of("l_shipdate").alias("ejercicio"),
        month_of("l_shipdate").alias("mes"),
        F.to_date("l_shipdate").alias("fecha_hasta"),
        F.col("l_suppkey").cast("string").alias("cuit"),
        F.col("l_extendedprice").cast(MONEY).alias("saldo"),
    )


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_partkey").cast("string").alias("obra"),
        F.col("p_name").alias("desc_obra"),
        F.col("p_brand").alias("actividad"),
        year_of("l_shipdate").alias("ejercicio"),
        month_of("l_shipdate").alias("mes"),
        F.to_date("l_shipdate").alias("fecha"),
        F.col("l_returnflag").alias("partida"),
        F.when(F.col("l_linestatus") == "O", "11").otherwise("10").alias("fuente"),
        (F.col("l_quantity") / F.lit(50)).alias("avance"),
        F.col("l_extendedprice").cast(MONEY).alias("importe"),
    )


#: Accounts of the bank that the other systems have too (segments of the customer table).
SHARED_ACCOUNTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements of four years; five of seven accounts are shared with the other systems, one is the bank's own, one NULL."""
    ev = table(spark, sf_dir, "events")
    k = F.col("user_id") % 7
    account = F.when(k == 6, F.col("user_id").cast("string"))
    for i, name in enumerate(SHARED_ACCOUNTS):
        account = account.when(k == i, F.lit(name))
    day = F.add_months(F.to_date("ts"), (F.lit(-12) * (F.col("event_id") % 4 + 25)).cast("int"))
    return ev.withColumn("_day", day).select(
        F.col("event_id").cast("string").alias("libramiento"),
        account.alias("cta_cte"),
        year_of("_day").alias("ejercicio"),
        month_of("_day").alias("mes"),
        F.col("_day").alias("fecha"),
        F.col("event_type").alias("cod_imputacion"),
        F.when(F.col("event_type").isin("purchase", "signup"), "DEPOSITO").otherwise("DEBITO").alias("movimiento"),
        F.col("value").cast(MONEY).alias("importe"),
    )


def acct_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.col("r_name").alias("map_to"),
        F.nullif(F.col("n_name"), F.lit("NATION_3")).alias("sscc_cta_cte"),
    )


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    return cv.select(
        "conv_id", "turn", "role",
        F.when(F.col("role") == "user", F.col("turn")).alias("heading_turn"),
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


BUILDERS = {
    "orders_raw": orders_raw,
    "loads": loads, "payments": payments, "snapshots": snapshots, "works": works, "bank": bank,
    "acct_map": acct_map, "headings": headings,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


# --- the same views in DuckDB SQL (oracle side) ----------------------------

VIEW_SQL = {
    "loads": """
        SELECT CAST(o.o_orderkey AS VARCHAR) AS id, CAST(o.o_orderkey AS VARCHAR) AS nro_comprobante,
               CAST(year(o.o_orderdate) AS VARCHAR) AS ejercicio, strftime(o.o_orderdate, '%m/%Y') AS mes,
               CAST(o.o_orderdate AS DATE) AS fecha, c.c_mktsegment AS cta_cte,
               CASE WHEN o.o_orderstatus = 'P' THEN 'PA6' WHEN o.o_orderstatus = 'F' THEN 'REG' ELSE 'CYO' END
                 AS tipo,
               '1' || substr(o.o_orderpriority, 1, 1) AS fuente, CAST(o.o_custkey AS VARCHAR) AS cuit,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS importe
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "payments": """
        SELECT CAST(l.l_orderkey AS VARCHAR) AS nro_comprobante, CAST(year(l.l_shipdate) AS VARCHAR) AS ejercicio,
               strftime(l.l_shipdate, '%m/%Y') AS mes, CAST(l.l_shipdate AS DATE) AS fecha,
               c.c_mktsegment AS cta_cte, CAST(o.o_custkey AS VARCHAR) AS cuit, c.c_name AS beneficiario,
               l.l_returnflag AS codigo, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS importe_bruto,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS importe_neto,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS retenciones
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey""",
    "snapshots": """
        SELECT CAST(l_orderkey AS VARCHAR) AS nro_comprobante, CAST(year(l_shipdate) AS VARCHAR) AS ejercicio,
               strftime(l_shipdate, '%m/%Y') AS mes, CAST(l_shipdate AS DATE) AS fecha_hasta,
               CAST(l_suppkey AS VARCHAR) AS cuit, CAST(l_extendedprice AS DECIMAL(18,2)) AS saldo
        FROM lineitem WHERE l_linestatus = 'O'""",
    "works": """
        SELECT CAST(l.l_partkey AS VARCHAR) AS obra, p.p_name AS desc_obra, p.p_brand AS actividad,
               CAST(year(l.l_shipdate) AS VARCHAR) AS ejercicio, strftime(l.l_shipdate, '%m/%Y') AS mes,
               CAST(l.l_shipdate AS DATE) AS fecha, l.l_returnflag AS partida,
               CASE WHEN l.l_linestatus = 'O' THEN '11' ELSE '10' END AS fuente,
               l.l_quantity / 50 AS avance, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS importe
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "bank": """
        SELECT CAST(event_id AS VARCHAR) AS libramiento,
               CASE user_id % 7 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE' WHEN 3 THEN 'HOUSEHOLD'
                                WHEN 4 THEN 'MACHINERY' WHEN 6 THEN CAST(user_id AS VARCHAR) END AS cta_cte,
               CAST(year(dia) AS VARCHAR) AS ejercicio, strftime(dia, '%m/%Y') AS mes, dia AS fecha,
               event_type AS cod_imputacion,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'DEPOSITO' ELSE 'DEBITO' END AS movimiento,
               CAST(value AS DECIMAL(18,2)) AS importe
        FROM (SELECT *, CAST(CAST(ts AS DATE) - to_years(CAST(event_id % 4 + 25 AS INTEGER)) AS DATE) AS dia FROM events)""",
    "acct_map": """
        SELECT r.r_name AS map_to, NULLIF(n.n_name, 'NATION_3') AS sscc_cta_cte
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "headings": """
        SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN turn END AS heading_turn
        FROM conversations""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every domain view it names."""
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in used)
    body = sql.strip()
    if re.match(r"(?is)^with\s", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
