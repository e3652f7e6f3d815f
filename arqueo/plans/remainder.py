"""Unspent-funds remainder (D-RM1..D-RM5) and floating debt views (D-NET4, D-NET5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.nulls import not_in_keep_null
from ..functions.scalars import shift_year

# FIXED VALUES: bank accounts and funds of the method-1 rows, and the balance
# transferred in 09/2019 that belongs to fund 13 although it sits in the
# general account.
REMAINDER_ROWS = {
    "Fuente 10 y 12": {"accounts": ["130832-03"], "funds": ["10", "12"]},
    "Fuente 13": {"accounts": ["130832-16"], "funds": ["13"]},
    "Fuente 11": {"accounts": None, "funds": ["11"]},
}
MOVED_BALANCE = "4262062.77"
MOVED_TO, MOVED_FROM = "Fuente 13", "Fuente 11"


def latest_debt(snapshots: DataFrame, year: str | None = None, month_col: str = "mes_hasta",
                drop_vouchers: Sequence[str] = ()) -> DataFrame:
    """D-NET4: floating debt of ``year`` at its latest snapshot month (one aggregate + join)."""
    d = op.years(snapshots, year) if year is not None else snapshots
    if drop_vouchers:
        d = d.filter(not_in_keep_null("nro_comprobante", drop_vouchers))
    return op.latest_period(d, month_col)


def treasury_debt(treasury: DataFrame, year: str, month_col: str = "mes_hasta") -> DataFrame:
    """D-NET5: treasury floating debt at December of ``year``."""
    return treasury.filter(F.col(month_col) == F.lit(f"12/{year}"))


def worksheet(budget: DataFrame, descriptions: DataFrame, lines: Sequence[str] = ("421", "422"),
              skip_fund: str = "11") -> DataFrame:
    """D-RM1: budget works lines outside fund 11, by activity with descriptions,
    plus empty columns filled in by hand."""
    b = budget.filter(F.col("partida").isin(list(lines))).filter(not_in_keep_null("fuente", [skip_fund]))
    b = b.withColumn("estructura", F.expr("substring(estructura, 1, length(estructura) - 4)"))
    desc = descriptions.select(F.col("actividad").alias("estructura"),
                               *[F.col(c).alias(n) for c, n in (("desc_prog", "prog_con_desc"),
                                                                ("desc_subprog", "subprog_con_desc"),
                                                                ("desc_proy", "proy_con_desc"),
                                                                ("desc_act", "act_con_desc")) if c in descriptions.columns])
    out = b.join(desc, on="estructura", how="left")
    out = out.drop(*[c for c in ("grupo", "credito_original", "comprometido", "pendiente", "programa", "subprograma",
                                 "proyecto", "actividad") if c in out.columns])
    zero = F.lit(0).cast("decimal(18,2)")
    return out.withColumns({"remte": zero, "mal_remte": zero, "saldo_remte": F.col("saldo"),
                            "cc_remte": F.lit(None).cast("string"), "cc_mal_remte": F.lit(None).cast("string"),
                            "f_y_f": F.lit(None).cast("string")})


def _row_of_account(rows: Mapping[str, dict]):
    expr, default = None, None
    for label, spec in rows.items():
        if spec["accounts"] is None:
            default = label
            continue
        cond = F.col("cta_cte").isin(spec["accounts"])
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def method_1(bank_final: DataFrame, debt: DataFrame, rows: Mapping[str, dict] = REMAINDER_ROWS,
             moved: str = MOVED_BALANCE) -> DataFrame:
    """D-RM2: bank balance - floating debt for the fixed fund rows; the moved
    balance is added to one row and taken from another."""
    labels = list(rows)
    bk = op.group_sum(bank_final.withColumn("fuente", _row_of_account(rows)), ["fuente"], {"saldo_bco": "saldo"})
    fund_rows = {label: spec["funds"] for label, spec in rows.items()}
    db = op.conditional_rows(debt, "fuente", fund_rows, {"rdeu": "saldo"}, label="fuente")
    spine = debt.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("fuente"))
    out = spine.join(bk, "fuente", "left").join(db, "fuente", "left").fillna(0, subset=["saldo_bco", "rdeu"])
    mv = F.lit(moved).cast("decimal(18,2)")
    out = out.withColumn("saldo_bco", F.when(F.col("fuente") == MOVED_TO, F.col("saldo_bco") + mv)
                         .when(F.col("fuente") == MOVED_FROM, F.col("saldo_bco") - mv).otherwise(F.col("saldo_bco")))
    return out.withColumn("rte_met_1", F.col("saldo_bco") - F.col("rdeu"))


def method_2(revenue: DataFrame, budget: DataFrame, keys: Sequence[str] = ("fuente",)) -> DataFrame:
    """D-RM3: revenue - ordered expense per fund, and the budget balance.

    The three series are put side by side on the union of keys with gaps left
    NULL, so ``rte_met_2`` is NULL where one side is missing.
    """
    keys = list(keys)
    rec = op.group_sum(revenue, keys, {"recursos": "importe"})
    gas = op.group_sum(budget, keys, {"gastos": "ordenado", "saldo_pres": "saldo"})
    out = op.concat_columns({"recursos": rec, "gastos": gas}, keys)
    return out.withColumn("rte_met_2", F.col("recursos") - F.col("gastos"))


def method_2_history(revenue: DataFrame, budget: DataFrame, skip_fund: str = "11") -> DataFrame:
    """D-RM4: method 2 by year and fund, with the remainder requested the next
    year (revenue flagged as remainder, shifted one year back)."""
    keys = ["ejercicio", "fuente"]
    base = method_2(revenue, budget, keys)
    req = op.group_sum(revenue.filter(F.col("es_remanente") == F.lit(True)), keys, {"rte_solicitado": "importe"})
    req = req.withColumn("ejercicio", shift_year("ejercicio", -1))
    out = base.join(req, on=keys, how="left")
    out = out.withColumn("dif_rte_solicitado", F.col("rte_solicitado") - F.col("rte_met_2"))
    out = out.filter(not_in_keep_null("fuente", [skip_fund]))
    return out.dropna()


def methods_compared(method1: DataFrame, method2: DataFrame, rows: Mapping[str, dict] = REMAINDER_ROWS) -> DataFrame:
    """D-RM5: both methods on the fixed fund rows (funds 10 and 12 merged)."""
    fund_rows = {label: spec["funds"] for label, spec in rows.items()}
    m2 = op.conditional_rows(method2, "fuente", fund_rows, {"rte_met_2": "rte_met_2"}, label="fuente")
    out = method1.select("fuente", "rte_met_1").join(m2, on="fuente", how="left")
    return out.withColumn("dif_metodos", F.col("rte_met_1") - F.col("rte_met_2"))
