"""Housing receivables reports (D-RC1..D-RC14).

Only the data behind the original charts is built.  Shares are computed with
group totals from aggregates (joined back), ranks on aggregated rows, and the
top-N lists broadcast only N keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as op
from ..functions import codes as K
from ..functions.scalars import safe_percent

# FIXED VALUES: the collected concepts in report order, the concept labels of
# the receivable-variation report and the labels of the amortisation row.
COLLECTED_CONCEPTS = ["amortizacion", "int_financiero", "int_mora", "gtos_adm", "seg_incendio", "seg_vida",
                      "subsidio", "pago_amigable", "escritura", "pend_acreditacion"]
OPENING_CLOSING = ["SALDO AL INICIO:", "SALDO AL FINAL:"]
AMORTISATION_CODE, AMORTISATION_LABEL = "AM", "AMORTIZACION"
OTHER_REASONS_LABEL = "OTROS MOTIVOS"


def opening_closing(variation: DataFrame) -> DataFrame:
    """D-RC1: opening and closing receivable rows."""
    return op.codes(variation, "concepto", include=OPENING_CLOSING)


def balance_per_year(balances: DataFrame, scale: float = 1e9) -> DataFrame:
    """D-RC2: receivable balance per year, in billions."""
    g = op.group_sum(balances, ["ejercicio"], ["saldo_actual"])
    return g.withColumn("saldo_actual", F.col("saldo_actual").cast("double") / F.lit(scale))


def variation_check(variation: DataFrame) -> DataFrame:
    """D-RC3: algebraic check of the balance variation and % explained."""
    g = op.group_sum(variation, ["ejercicio"], ["saldo_inicial", "amortizacion", "cambios", "saldo_final"])
    g = g.withColumn("suma_algebraica", F.col("saldo_inicial") + F.col("amortizacion") + F.col("cambios"))
    return g.withColumn("%_saldo_explicado", safe_percent(F.col("amortizacion") + F.col("cambios"),
                                                           F.col("saldo_final") - F.col("saldo_inicial")))


def reasons_with_amortisation(reason_balance: DataFrame, collected: DataFrame) -> DataFrame:
    """D-RC4: balance by reason plus one amortisation row per year."""
    am = op.group_sum(collected, ["ejercicio"], {"importe": "amortizacion"})
    am = am.withColumns({"cod_motivo": F.lit(AMORTISATION_CODE), "motivo": F.lit(AMORTISATION_LABEL)})
    return op.union_all(reason_balance, am)


def reason_ranking(reasons: DataFrame, year: str) -> DataFrame:
    """D-RC5: reasons of one year by absolute amount, with their share."""
    d = op.years(reasons, year).withColumn("importe", F.abs("importe"))
    d = op.share(d, "importe", [])
    return op.rank_by(d, "importe", [], absolute=False, tie_break=["cod_motivo"])


def top_reasons_over_time(reasons: DataFrame, base_year: str, n: int = 5) -> DataFrame:
    """D-RC6: share of the top-N reasons of the base year in every year; the
    rest folded into one 'OT' row per year (amount and share summed)."""
    d = reasons.withColumn("importe", F.abs("importe"))
    d = op.share(d, "importe", ["ejercicio"])
    keys = op.top_keys(op.years(d, base_year), n, "cod_motivo", "importe").withColumn("_top", F.lit(True))
    j = d.join(keys, on="cod_motivo", how="left")
    top = F.coalesce(F.col("_top"), F.lit(False))
    j = j.withColumns({"cod_motivo": F.when(top, F.col("cod_motivo")).otherwise(F.lit(K.TOP_OTHER_LABEL)),
                       "motivo": F.when(top, F.col("motivo")).otherwise(F.lit(OTHER_REASONS_LABEL))})
    return op.group_sum(j, ["ejercicio", "cod_motivo", "motivo"], ["importe", "participacion"])


def new_vs_delivered(new: DataFrame, reasons: DataFrame, reason: str = "1") -> DataFrame:
    """D-RC7: new neighbourhoods vs handed-over housing by year (inner on year)."""
    a = op.group_sum(new, ["ejercicio"], {"barrios_nuevos": "importe_total"})
    b = op.codes(reasons, "cod_motivo", include=[reason]).select("ejercicio", F.col("importe")
                                                                  .alias("entrega_viviendas"))
    return op.inner(a, b, "ejercicio").withColumn("diferencia", F.col("barrios_nuevos") - F.col("entrega_viviendas"))


def new_vs_delivered_by_neighbourhood(new: DataFrame, reason_by_nbh: DataFrame, reason: str = "001",
                                      tol: float = 0.05) -> DataFrame:
    """D-RC8: the same by neighbourhood, left-aligned, |d| > tol."""
    b = op.codes(reason_by_nbh, "cod_motivo", include=[reason])
    r = op.reconcile(new, b, ["cod_barrio"], {"barrios_nuevos": "importe_total"}, {"entrega_viviendas": "importe"},
                     how="left", diff="diferencia_abs",
                     diff_expr=F.abs(F.col("barrios_nuevos") - F.col("entrega_viviendas")))
    return op.beyond(r, "diferencia_abs", tol)


def collected_vs_bank(collected: DataFrame, bank_revenue: DataFrame, after_year: int = 2017,
                      by_month: bool = False) -> DataFrame:
    """D-RC9: collected per the receivables system vs bank deposits
    (``controls.receivable_deposits``) of the same years, by year or by
    calendar month (all years together), inner on the key."""
    c = op.up_to(collected, after_year, op=">")
    b = op.semi(bank_revenue, op.distinct_values(c, ["ejercicio"]), "ejercicio")
    key = "mes" if by_month else "ejercicio"
    if by_month:
        c = c.withColumn("mes", F.substring("mes", 1, 2))
        b = b.withColumn("mes", F.substring("mes", 1, 2))
    r = op.reconcile(c, b, [key], {"recaudado_recuperos": "recaudado_total"}, {"recaudado_banco": "importe"},
                     how="inner")
    return r.withColumn("dif%", safe_percent("diferencia", "recaudado_recuperos"))


def billed_collected_share(billed: DataFrame, collected: DataFrame, balances: DataFrame,
                           after_year: str = "2010") -> DataFrame:
    """D-RC10: billed and collected per year, long form, as % of the balance."""
    f = op.group_sum(billed, ["ejercicio"], {"importe": "facturado_total"}).withColumn("concepto", F.lit("facturado"))
    r = op.group_sum(collected, ["ejercicio"], {"importe": "recaudado_total"}).withColumn("concepto",
                                                                                         F.lit("recaudado"))
    s = op.group_sum(balances, ["ejercicio"], ["saldo_actual"])
    out = op.union_all(f, r).join(s, on="ejercicio", how="left")
    out = out.withColumn("participacion", safe_percent("importe", "saldo_actual"))
    return out.filter(F.col("ejercicio") > F.lit(after_year))


def concept_share_of_collected(collected: DataFrame, concept: str, after_year: str = "2010") -> DataFrame:
    """D-RC11: pending credit (or amortisation) as % of collected, per year."""
    g = op.group_sum(collected, ["ejercicio"], [concept, "recaudado_total"])
    g = g.withColumn("participacion", safe_percent(F.abs(F.col(concept)), "recaudado_total"))
    return g.filter(F.col("ejercicio") > F.lit(after_year))


def collected_composition(collected: DataFrame, year: str, n: int = 5,
                          concepts: Sequence[str] = COLLECTED_CONCEPTS) -> DataFrame:
    """D-RC12: composition of collected in a year: the N concepts with the
    largest share (ties by name), plus 'otros' with the rest (amount and share)."""
    g = op.group_sum(op.years(collected, year), ["ejercicio"], list(concepts))
    long = op.unpivot(g, ["ejercicio"], list(concepts), "concepto", "importe")
    long = op.share(long.withColumn("importe", F.abs("importe")), "importe", ["ejercicio"])
    # one row per year and concept: the window is over the report's own lines
    long = op.rank_by(long, "importe", ["ejercicio"], tie_break=["concepto"], out="_rank", method="window")
    label = F.when(F.col("_rank") <= F.lit(n), F.col("concepto")).otherwise(F.lit("otros"))
    return op.group_sum(long.withColumn("concepto", label), ["ejercicio", "concepto"], ["importe", "participacion"])


def without_amortisation(variation: DataFrame, year: str, tol: float = 0.01) -> DataFrame:
    """D-RC13: neighbourhoods with balance in ``year`` whose amortisation in
    earlier years (sign flipped) is below ``tol``."""
    d = variation.filter(F.col("saldo_final") > 0)
    prev = op.group_sum(op.up_to(d, year, op="<"), ["barrio"], ["amortizacion"])
    cur = op.years(d, year).drop("amortizacion")
    out = cur.join(prev, on="barrio", how="inner").withColumn("amortizacion", -F.col("amortizacion"))
    return out.filter(F.col("amortizacion") < F.lit(tol))


def with_without_amortisation(variation: DataFrame, year: str, by_balance: bool = False) -> DataFrame:
    """D-RC14: two rows, neighbourhoods without / with amortisation (count or balance)."""
    cur = op.years(variation, year)
    alta = without_amortisation(variation, year)
    if by_balance:
        t_all = op.totals(cur, {"v": "saldo_final"})
        t_alta = op.totals(alta, {"v": "saldo_final"})
    else:
        t_all = cur.agg(F.count(F.lit(1)).cast("decimal(38,2)").alias("v"))
        t_alta = alta.agg(F.count(F.lit(1)).cast("decimal(38,2)").alias("v"))
    without, with_ = F.lit("Barrios sin amortizaciones"), F.lit("Barrios con amortizaciones")
    # signed one-row totals, added up per label: no join
    signed = op.union_all(t_alta.select(without.alias("concepto"), F.col("v").alias("importe")),
                          t_all.select(with_.alias("concepto"), F.col("v").alias("importe")),
                          t_alta.select(with_.alias("concepto"), (-F.col("v")).alias("importe")))
    return op.group_sum(signed, ["concepto"], ["importe"])
