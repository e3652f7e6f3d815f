"""Budget execution and works status (D-DIM1, D-DIM2, D-EO1..D-EO8, D-EG1).

Work status rule: a work is *in progress* while its maximum progress is below
1; it *finished before* year Y when it reached exactly 1 before Y.  Progress
above 1, or never set, falls in neither, so it ends in "finished now"
(= total - in progress - finished before).

Every measure is a conditional sum over rows pre-aggregated to
(group, work, year); work-level flags are windows by work over those
aggregated rows.  No step sorts a raw group, and the per-year expansion (as
of each year) multiplies only the pre-aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.nulls import drop_null_keys


def _min_year(year: str):
    """First year: years are 4-digit text, so the integer minimum is the text
    minimum, and an integer buffer keeps the aggregate hash-based."""
    return F.min(F.col(year).cast("int")).cast("string")


def _cond_sum(cond, value="s"):
    return F.coalesce(F.sum(F.when(F.coalesce(cond, F.lit(False)), F.col(value))), F.lit(0))


def _pre(df: DataFrame, group_cols: Sequence[str], work: str, year: str, value: str, progress: str) -> DataFrame:
    d = drop_null_keys(df, group_cols)
    return d.groupBy(*group_cols, work, year).agg(
        F.sum(value).alias("s"), F.max(progress).alias("mx"),
        F.max(F.col(progress) == F.lit(1)).alias("hit1"))


def works_report(df: DataFrame, group_cols: Sequence[str], current_year: str | int,
                 pivot_years: Sequence[str] | None = None, last_n: int | None = None, total: str = "acum",
                 work: str = "obra", year: str = "ejercicio", value: str = "importe",
                 progress: str = "avance", pivot_col: str | None = None,
                 pivot_values: Sequence[str] | None = None, pivot_labels: dict | None = None) -> DataFrame:
    """D-EO5 / D-EO6: per group: first year, amount per year (pivot), total,
    in progress, finished in earlier years, finished this year.

    ``pivot_years`` names the year columns; ``pivot_col`` with
    ``pivot_values`` pivots by another column instead (``pivot_labels``
    renames some values).  Without names the result is the long form: a row
    per group and year (the ``last_n`` most recent years present) or value,
    with its amount in ``value`` and the group's other columns repeated; no
    header is read from the data.  Work-level flags are windows over the
    (group, work, year) aggregate partitioned by work: a partition holds one
    row per group and year of the work, never its raw lines, and the source
    is scanned once.
    """
    g = list(group_cols)
    cur = int(current_year)
    d = _pre(df, g, work, year, value, progress)
    yr = F.col(year).cast("int")
    has_work = F.col(work).isNotNull()
    # rows without a work need no window over them: they are spread by their group
    w = Window.partitionBy(work, F.when(~has_work, F.xxhash64(*g)).otherwise(0))
    j = d.withColumns({
        "_wmax": F.when(has_work, F.max("mx").over(w)),
        "_wprev1": F.when(has_work, F.max(F.when(yr < F.lit(cur), F.col("hit1"))).over(w))})
    labels, names, by = pivot_labels or {}, pivot_years, year
    if pivot_col is not None:
        names, by = pivot_values, pivot_col
        if pivot_col not in j.columns:  # a work attribute: one value per work (the first)
            attr = op.dedupe(df.select(work, pivot_col).filter(F.col(work).isNotNull()), [work], [pivot_col], "first")
            j = j.join(attr, on=work, how="left")
    status = {"alta": _min_year(year), total: F.coalesce(F.sum("s"), F.lit(0)),
              "en_curso": _cond_sum(F.col("_wmax") < F.lit(1)),
              "terminadas_ant": _cond_sum((yr < F.lit(cur)) & F.col("_wprev1"))}
    done = F.col(total) - F.col("en_curso") - F.col("terminadas_ant")
    if names is not None:
        wide = [_cond_sum(F.col(by) == F.lit(str(v))).alias(labels.get(v, str(v))) for v in names]
        aggs = [status["alta"].alias("alta"), *wide, *[e.alias(c) for c, e in status.items() if c != "alta"]]
        return j.groupBy(*g).agg(*aggs).withColumn("terminadas_actual", done)
    each = j.groupBy(*g, by).agg(F.sum("s").alias(value), *[e.alias(c) for c, e in status.items()])
    wg = Window.partitionBy(*g)
    each = each.withColumns({c: (F.min if c == "alta" else F.sum)(c).over(wg) for c in status})
    if pivot_col is None and last_n:
        each = each.withColumn("_ys", op.joins.years_present(df, last_n, year)).filter(F.array_contains("_ys", yr)).drop("_ys")
    named = F.col(by)
    for v, label in labels.items():
        named = F.when(F.col(by) == F.lit(v), F.lit(label)).otherwise(named)
    each = each.filter(F.col(by).isNotNull()).withColumn(by, named).withColumn("terminadas_actual", done)
    return each.select(*g, by, value, *status, "terminadas_actual")


BASIC_MODULE_GROUPS = ["desc_prog", "desc_proy", "desc_act", "actividad", "partida", "fuente", "localidad",
                       "norma_legal", "obra"]


def basic_module_report(loads_bm: DataFrame, current_year: str | int, by_agreement: bool = True,
                        group_cols: Sequence[str] = BASIC_MODULE_GROUPS, columns: Sequence[str] | None = None
                        ) -> DataFrame:
    """D-EO5: basic-module works report.  By agreement: fund 11 only, amounts
    pivoted by agreement (``info_adicional``; the empty one is 'Sin Convenio');
    otherwise pivoted by year.  ``columns``: the agreements or years of the
    wide form; without them the long form (see :func:`works_report`)."""
    g = [c for c in group_cols if c in loads_bm.columns]
    if by_agreement:
        d = loads_bm.filter(F.col("fuente") == "11")
        return works_report(d, g, current_year, total="ejecucion_total", pivot_col="info_adicional",
                            pivot_values=columns, pivot_labels={"": "Sin Convenio"})
    return works_report(loads_bm, g, current_year, total="ejecucion_total", pivot_years=columns)


def works_ledger_report(loads_desc: DataFrame, current_year: str | int, full: bool = False, by_line: bool = True,
                        by_fund: bool = True, last_n: int | None = None, years: Sequence[str] | None = None
                        ) -> DataFrame:
    """D-EO6: works ledger ("planillometro"): per activity (and work, line,
    fund when asked) the first year, the amount of each year, total, in
    progress, finished before and finished this year.  ``years`` names the
    year columns; without them the long form (all years, or the last N)."""
    g = [c for c in ("desc_prog", "desc_proy", "desc_act") if c in loads_desc.columns] + ["actividad"]
    g += (["obra"] if full else []) + (["partida"] if by_line else []) + (["fuente"] if by_fund else [])
    return works_report(loads_desc, g, current_year, pivot_years=years, last_n=last_n)


def works_as_of_years(df: DataFrame, group_cols: Sequence[str], years: Sequence[str] | None = None,
                      last_n: int | None = None, work: str = "obra", year: str = "ejercicio",
                      value: str = "importe", progress: str = "avance") -> DataFrame:
    """D-EO7: for every report year Y: cumulative amount up to Y, execution in Y,
    in progress as of Y, finished before Y, finished in Y.

    Report years default to the years present (the ``last_n`` most recent).
    One scan: rows are aggregated to (group, work, year), repeated for every
    Y >= year, and the work flags as of Y are windows over (work, Y) on those
    aggregated rows.  The first year of a group is the minimum year seen at
    the last Y (which includes every year up to it).
    """
    g = list(group_cols)
    if years is None:
        years = op.joins.years_present(df, last_n, year)
        last_y = F.array_max(years).cast("string")
    else:
        last_y = F.lit(str(max(int(y) for y in years)))
    d = _pre(df, g, work, year, value, progress)
    yr = F.col(year).cast("int")
    hy = F.col("hasta").cast("int")
    e = op.as_of_years(d, years, year)
    has_work = F.col(work).isNotNull()
    # rows without a work need no window over them: they are spread by their group
    w = Window.partitionBy(work, F.when(~has_work, F.xxhash64(*g)).otherwise(0), "hasta")
    e = e.withColumns({"_mx_le": F.when(has_work, F.max("mx").over(w)),
                       "_mx_lt": F.when(has_work, F.max(F.when(yr < hy, F.col("mx"))).over(w))})
    agg = e.groupBy(*g, "hasta").agg(
        _min_year(year).alias("_alta"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("acum"),
        _cond_sum(F.col(year) == F.col("hasta")).alias("ejecucion"),
        _cond_sum(F.col("_mx_le") < F.lit(1)).alias("en_curso"),
        _cond_sum((yr < hy) & (F.col("_mx_lt") == F.lit(1))).alias("terminadas_ant"))
    alta = F.min(F.when(F.col("hasta") == last_y, F.col("_alta"))).over(Window.partitionBy(*g))
    out = agg.withColumn("alta", alta).withColumnRenamed("hasta", "ejercicio")
    out = out.withColumn("terminadas_actual", F.col("acum") - F.col("en_curso") - F.col("terminadas_ant"))
    return out.select(*g, "alta", "ejercicio", "acum", "en_curso", "terminadas_ant", "ejecucion",
                      "terminadas_actual")


def works_ledger_for_accounting(loads: DataFrame, group_cols: Sequence[str], years: Sequence[str] | None = None,
                                from_year: int | None = 2009, date_up_to=None, opening: DataFrame | None = None,
                                last_n: int | None = None, current_cash: DataFrame | None = None,
                                current_year: str | None = None) -> DataFrame:
    """D-EO7 with its input steps: year floor, optional date bound and the 2008
    opening balances (progress 1, work = activity description), then the
    as-of-year status; ``estructura`` = activity-line.

    ``current_cash`` (with ``current_year``) replaces the current year by its
    cash-basis loads (advances in, regularisations out), as the original's
    option to include advances.
    """
    df = loads
    if from_year is not None:
        df = op.up_to(df, from_year, op=">=")
    if current_cash is not None and current_year is not None:
        df = op.union_all(op.up_to(df, current_year, op="<"), op.years(current_cash, current_year))
    if date_up_to is not None:
        df = op.date_bound(df, "fecha", date_up_to)
    if opening is not None:
        df = op.union_all(df, opening_rows(opening, df))
    out = works_as_of_years(df, group_cols, years, last_n)
    if "actividad" in group_cols and "partida" in group_cols:
        out = out.withColumn("actividad", F.concat_ws("-", "actividad", "partida")) \
            .withColumnRenamed("actividad", "estructura").drop("partida")
    return out


def opening_rows(opening: DataFrame, loads: DataFrame, desc_cols: Sequence[str] = ("desc_prog", "desc_proy",
                                                                                    "desc_act")) -> DataFrame:
    """2008 opening balances (D-EO8) as load rows: progress 1, work = activity
    description; those whose structure also appears in the loads inherit the
    loads' descriptions (one description row per structure)."""
    o = (opening.withColumn("ejercicio", F.lit("2008")).withColumn("avance", F.lit(1.0))
         .withColumn("obra", F.col("desc_act")).withColumnRenamed("acum_2008", "importe"))
    dcols = [c for c in desc_cols if c in loads.columns]
    if not dcols:
        return o
    st = F.concat_ws("-", "actividad", "partida")
    ref = op.dedupe(loads.select(st.alias("estructura"), *dcols), ["estructura"], dcols, "first")
    known = o.join(ref.select("estructura"), on="estructura", how="left_semi")
    known = known.drop(*[c for c in dcols if c in known.columns]).join(ref, on="estructura", how="left")
    rest = o.join(ref.select("estructura"), on="estructura", how="left_anti")
    return op.union_all(rest, known)


def opening_balances(sheet: DataFrame, order: str = "row_no", part: Sequence[str] = (), label: str = "descripcion",
                     code: str = "estructura", amount: str = "acum_2008") -> DataFrame:
    """D-EO8: spreadsheet of 2008 balances with headings above their rows.

    A row without project is a programme heading, one without work a project
    heading: their ``NN - text`` labels are filled down the rows in ``order``
    (blocked scan).  Rows with a structure code are the balances; their own
    text is the activity's, the subprogramme has no text.
    """
    def named(number: str):
        return F.concat(F.col(number), F.lit(" - "), F.col(label))

    d = sheet.withColumns({"desc_prog": F.when(F.col("proy").isNull(), named("prog")),
                           "desc_proy": F.when(F.col("obra").isNull(), named("proy"))})
    d = op.forward_fill(d, ["desc_prog", "desc_proy"], order, list(part)).filter(F.col(code).isNotNull())
    keep = [c for c in ("actividad", "partida", "estructura", "alta") if c in d.columns]
    return d.select(*part, "desc_prog", F.concat("subprog", F.lit(" - --")).alias("desc_subprog"), "desc_proy",
                    named("obra").alias("desc_act"), *keep, F.col(amount).alias("acum_2008"))


def works_descriptions(programs: DataFrame, subprograms: DataFrame, projects: DataFrame,
                       activities: DataFrame) -> DataFrame:
    """D-DIM1: activity -> project -> subprogramme -> programme, each label
    ``NN - text`` with NN the matching two digits of the activity code
    (``PP-SS-YY-AA``); a missing subprogramme text is ''."""
    h = op.hierarchy([(activities, []), (projects, ["proyecto"]), (subprograms, ["subprograma"]),
                      (programs, ["programa"])])
    act = F.col("actividad")

    def label(start: int, text):
        return F.concat(F.substring(act, start, 2), F.lit(" - "), text)

    return h.select("actividad", label(1, F.col("desc_prog")).alias("desc_prog"),
                    label(4, F.coalesce(F.col("desc_subprog"), F.lit(""))).alias("desc_subprog"),
                    label(7, F.col("desc_proy")).alias("desc_proy"), label(10, F.col("desc_act")).alias("desc_act"))


def budget_descriptions(structure_desc: DataFrame, up_to_year: str | None = None,
                        years: Sequence[str] | None = None) -> DataFrame:
    """D-DIM2: ledger budget descriptions; the newest year's text wins at each level.

    Order is year descending then structure ascending; each level keeps its
    first row (one aggregate per level), then levels are joined to the
    activity rows and labelled ``code - text`` (NULL text gives NULL).
    """
    d = structure_desc
    if years is not None:
        d = op.years(d, years)
    elif up_to_year is not None:
        d = op.up_to(d, up_to_year)
    d = d.withColumn("_y", -F.col("ejercicio").cast("int"))

    def newest(keys, cols):
        return op.dedupe(d.select(*keys, "_y", "estructura", *cols), keys, ["_y", "estructura"], "first",
                         tie_break=[]).drop("_y", "estructura")

    act = op.dedupe(d.select("estructura", "programa", "subprograma", "proyecto", "actividad", "desc_act", "_y"),
                    ["estructura"], ["_y"], "first").drop("_y")
    prog = newest(["programa"], ["desc_prog"])
    sub = newest(["programa", "subprograma"], ["desc_subprog"])
    proy = newest(["programa", "subprograma", "proyecto"], ["desc_proy"])
    out = (act.join(prog, on="programa", how="left").join(sub, on=["programa", "subprograma"], how="left")
           .join(proy, on=["programa", "subprograma", "proyecto"], how="left"))
    lbl = {"desc_prog": "programa", "desc_subprog": "subprograma", "desc_proy": "proyecto", "desc_act": "actividad"}
    return out.select("estructura", *[F.concat(F.col(code), F.lit(" - "), F.col(txt)).alias(txt)
                                      for txt, code in lbl.items()])
