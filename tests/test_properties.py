"""Randomised checks of the skew-safe rewrites against brute force in pandas.

The scale-oriented forms (blocked forward fill, aggregate dedupe, running
balance from per-day sums, reconcile) must give exactly what the direct
row-by-row computation gives.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from arqueo import operators as op

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["HOT", "HOT", "HOT", "a", "b", None])
days = st.integers(min_value=0, max_value=40)
amounts = st.integers(min_value=-500, max_value=500)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["f1", "f2", "f1", "f1"]), st.booleans(), st.integers(0, 9)),
                min_size=1, max_size=60), st.integers(min_value=1, max_value=7))
def test_forward_fill_matches_ffill(spark, rows_, block):
    data = []
    counters = {}
    for part, has, v in rows_:
        n = counters.get(part, 0)
        counters[part] = n + 1
        data.append((part, n, f"h{v}" if has else None))
    df = spark.createDataFrame(data, "file string, row_no int, heading string")
    got = {(r.file, r.row_no): r.heading for r in
           op.forward_fill(df, ["heading"], "row_no", ["file"], block_rows=block).collect()}
    pdf = pd.DataFrame(data, columns=["file", "row_no", "heading"]).sort_values(["file", "row_no"])
    pdf["heading"] = pdf.groupby("file")["heading"].ffill()
    want = {(f, int(n)): (h if isinstance(h, str) else None) for f, n, h in pdf.itertuples(index=False)}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(keys, st.one_of(st.none(), days), amounts), min_size=1, max_size=50),
       st.sampled_from(["first", "last"]))
def test_dedupe_matches_sorted_drop_duplicates(spark, rows_, keep):
    base = dt.date(2024, 1, 1)
    data = [(k, None if d is None else base + dt.timedelta(days=d), v) for k, d, v in rows_]
    df = spark.createDataFrame(data, "k string, f date, v int")
    got = sorted(((r.k or "~"), r.f, r.v) for r in op.dedupe(df, ["k"], ["f"], keep).collect())
    pdf = pd.DataFrame(data, columns=["k", "f", "v"])
    pdf["k"] = pdf["k"].fillna("~")
    # the original: stable sort by date (NULLs last) with the full row as tie-break, then keep first/last
    pdf = pdf.sort_values(["f", "v"], na_position="last", kind="mergesort")
    pdf = pdf.drop_duplicates(subset=["k"], keep=keep)
    want = sorted((k, None if pd.isna(f) else f, int(v)) for k, f, v in pdf.itertuples(index=False))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["HOT", "HOT", "c1", "c2"]), days, amounts), min_size=1, max_size=60))
def test_running_balance_matches_cumsum(spark, rows_):
    base = dt.date(2024, 1, 1)
    data = [("2024", (base + dt.timedelta(days=d)).strftime("%m/%Y"), a, base + dt.timedelta(days=d),
             Decimal(v).quantize(Decimal("0.01"))) for a, d, v in rows_]
    df = spark.createDataFrame(data, "ejercicio string, mes string, cta_cte string, fecha date, "
                                     "importe decimal(18,2)")
    got = {(r.mes, r.cta_cte): r.saldo for r in op.running_balance(df, ["ejercicio", "mes", "cta_cte"]).collect()}
    pdf = pd.DataFrame([(m, a, f, int(v)) for _, m, a, f, v in data], columns=["mes", "cta_cte", "fecha", "importe"])
    pdf = pdf.sort_values(["fecha"], kind="mergesort")
    pdf["saldo"] = pdf.groupby("cta_cte")["importe"].cumsum()
    want = {k: Decimal(int(v)).quantize(Decimal("0.01"))
            for k, v in pdf.groupby(["mes", "cta_cte"])["saldo"].last().to_dict().items()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(keys, amounts), max_size=40), st.lists(st.tuples(keys, amounts), max_size=40))
def test_reconcile_matches_outer_merge(spark, left, right):
    a = spark.createDataFrame(left or [("x", 0)], "k string, v int")
    b = spark.createDataFrame(right or [("y", 0)], "k string, w int")
    got = {r.k: (r.x, r.y, r.diferencia) for r in op.reconcile(a, b, ["k"], {"x": "v"}, {"y": "w"}).collect()}
    pa = pd.DataFrame(left or [("x", 0)], columns=["k", "v"]).groupby("k")["v"].sum().rename("x")
    pb = pd.DataFrame(right or [("y", 0)], columns=["k", "w"]).groupby("k")["w"].sum().rename("y")
    m = pd.concat([pa, pb], axis=1).fillna(0)
    want = {k: (int(x), int(y), int(x - y)) for k, (x, y) in m.iterrows()}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["HOT", "HOT", "y1", None]), amounts, st.integers(0, 3)),
                min_size=1, max_size=80), st.integers(min_value=1, max_value=6))
def test_distributed_rank_equals_window_rank(spark, rows_, n):
    df = spark.createDataFrame(rows_, "ejercicio string, importe int, cod int")
    a = op.rank_by(df, "importe", ["ejercicio"], tie_break=["cod"], method="range", partitions=n)
    b = op.rank_by(df, "importe", ["ejercicio"], tie_break=["cod"], method="window")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    g = op.rank_by(df, "importe", [], tie_break=["ejercicio", "cod"], method="range", partitions=n)
    assert sorted(r.ranking for r in g.collect()) == list(range(1, len(rows_) + 1))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["HOT", "HOT", "p2", None]), st.integers(0, 12), amounts),
                min_size=1, max_size=80), st.integers(min_value=1, max_value=6))
def test_distributed_cumulative_equals_window(spark, rows_, n):
    df = spark.createDataFrame(rows_, "cta string, k int, v int")
    a = op.cumulative(df, ["k"], "v", ["cta"], partitions=n)
    b = op.cumulative(df, ["k"], "v", ["cta"], presummed=True)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
