from __future__ import annotations

from pyspark.sql import functions as F

from arqueo import operators as op
from conftest import D, day, rows


def test_group_sum_drops_null_keys_and_zero_sums(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", D(2)), (None, D(9))], "k string, x decimal(18,2)")
    assert rows(op.group_sum(df, ["k"], ["x"])) == [("a", D(0)), ("b", D(2))]


def test_sum_numeric_excludes_booleans(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("a", 2.0, True)], "k string, x double, f boolean")
    assert op.sum_numeric(df, ["k"]).columns == ["k", "x"]
    assert rows(op.sum_numeric(df, ["k"], bools=True), "k", "f") == [("a", 2)]


def test_pivot_fill_and_total(spark):
    df = spark.createDataFrame([("c1", "110", 5.0), ("c1", "111", 2.0), ("c2", "110", 1.0)],
                               "id string, codigo string, importe double")
    long = op.pivot_sum(df, ["id"], "codigo", "importe", total="total")  # no header is read from the data
    assert rows(long, "id", "codigo", "importe", "total") == [("c1", "110", 5.0, 7.0), ("c1", "111", 2.0, 7.0), ("c2", "110", 1.0, 1.0)]
    p = op.pivot_sum(df, ["id"], "codigo", "importe", values=["110", "111"], total="total")
    assert p.columns == ["id", "110", "111", "total"]
    assert rows(p) == [("c1", 5.0, 2.0, 7.0), ("c2", 1.0, 0.0, 1.0)]


def test_conditional_rows_fixed_labels(spark):
    df = spark.createDataFrame([("2024", "a", 1.0), ("2024", "x", 9.0)], "ejercicio string, c string, v double")
    out = op.conditional_rows(df, "c", {"A": ["a"], "B": ["b"]}, {"v": "v"}, keys=["ejercicio"])
    assert rows(out, "concepto", "v") == [("A", 1.0), ("B", 0.0)]


def test_period_end_and_latest_period(spark):
    df = spark.createDataFrame([("c", day("2024-01-05"), 1.0), ("c", day("2024-01-20"), None),
                                ("c", day("2024-01-10"), 3.0)], "k string, f date, v double")
    assert rows(op.period_end(df, ["k"], "v", "f")) == [("c", 3.0)]
    snaps = spark.createDataFrame([("01/2024", 1), ("12/2023", 2), ("01/2024", 3)], "mes string, v int")
    assert rows(op.latest_period(snaps), "v") == [(1,), (3,)]


def test_running_balance_equals_total(spark):
    df = spark.createDataFrame([
        ("2024", "01/2024", "A", day("2024-01-03"), D(10)), ("2024", "01/2024", "A", day("2024-01-03"), D(-4)),
        ("2024", "02/2024", "A", day("2024-02-01"), D(5)), ("2024", "01/2024", "B", day("2024-01-31"), D(1)),
        ("2024", "03/2024", "A", day("2024-03-09"), None)],
        "ejercicio string, mes string, cta_cte string, fecha date, importe decimal(18,2)")
    out = op.running_balance(df, ["ejercicio", "mes", "cta_cte"])
    assert rows(out, "mes", "cta_cte", "saldo") == [("01/2024", "A", D(6)), ("01/2024", "B", D(1)),
                                                   ("02/2024", "A", D(11)), ("03/2024", "A", D(11))]
    total = df.groupBy("cta_cte").agg(F.sum("importe").alias("t"))
    last = out.filter(F.col("mes") == "03/2024").first()
    assert last.saldo == total.filter(F.col("cta_cte") == "A").first().t


def test_forward_fill_across_blocks(spark):
    data = [("f1", i, (f"H{i}" if i in (0, 5, 11) else None)) for i in range(14)] + [("f2", 0, None), ("f2", 1, "X")]
    df = spark.createDataFrame(data, "file string, row_no int, heading string")
    out = op.forward_fill(df, ["heading"], "row_no", ["file"], block_rows=3)
    got = {(r.file, r.row_no): r.heading for r in out.collect()}
    assert got[("f1", 4)] == "H0" and got[("f1", 10)] == "H5" and got[("f1", 13)] == "H11"
    assert got[("f2", 0)] is None and got[("f2", 1)] == "X"


def test_dedupe_first_last_nulls_last_and_ties(spark):
    df = spark.createDataFrame([("v1", day("2024-02-01"), 5.0), ("v1", day("2024-01-31"), 7.0),
                                ("v1", None, 1.0), ("v2", day("2024-01-01"), 3.0), ("v2", day("2024-01-01"), 2.0)],
                               "v string, f date, s double")
    first = op.dedupe(df, ["v"], ["f"], "first")
    assert first.columns == ["v", "f", "s"]
    assert rows(first) == [("v1", day("2024-01-31"), 7.0), ("v2", day("2024-01-01"), 2.0)]
    last = op.dedupe(df, ["v"], ["f"], "last")
    assert rows(last, "v", "s") == [("v1", 1.0), ("v2", 3.0)]  # NULL date sorts last, so it is "last"


def test_latest_snapshot_keeps_ties(spark):
    df = spark.createDataFrame([("v", day("2024-01-02"), 1), ("v", day("2024-01-02"), 2), ("v", day("2024-01-01"), 3)],
                               "v string, f date, s int")
    assert rows(op.latest_snapshot(df, ["v"], "f"), "s") == [(1,), (2,)]


def test_share_rank_topn_other(spark):
    df = spark.createDataFrame([("2024", "a", -60.0), ("2024", "b", 30.0), ("2024", "c", 10.0), ("2023", "a", 5.0),
                                ("2023", "d", 5.0)], "ejercicio string, cod string, importe double")
    s = op.share(df, "importe", ["ejercicio"], absolute=True)
    assert rows(s.filter(F.col("ejercicio") == "2024"), "cod", "participacion") == [("a", 60.0), ("b", 30.0),
                                                                                     ("c", 10.0)]
    r = op.rank_by(df, "importe", ["ejercicio"], tie_break=["cod"])
    assert rows(r.filter(F.col("ejercicio") == "2024"), "cod", "ranking") == [("a", 1), ("b", 2), ("c", 3)]
    t = op.top_n_other(df, 2, "cod", "importe", ["ejercicio"], base=df.filter(F.col("ejercicio") == "2024"))
    assert rows(t) == [("2023", "OT", 5.0), ("2023", "a", 5.0), ("2024", "OT", 10.0), ("2024", "a", -60.0),
                       ("2024", "b", 30.0)]


def test_recent_years_and_cumulative(spark):
    df = spark.createDataFrame([("2021", 1.0), ("2022", 2.0), ("2023", 3.0), ("2023", 4.0)], "ejercicio string, v double")
    assert rows(op.recent_years(df, 2), "v") == [(2.0,), (3.0,), (4.0,)]
    c = op.cumulative(op.group_sum(df, ["ejercicio"], ["v"]), ["ejercicio"], "v")
    assert rows(c, "ejercicio", "acum") == [("2021", 1.0), ("2022", 3.0), ("2023", 10.0)]
    raw = op.cumulative(df, ["ejercicio"], "v")  # equal keys share one running value
    assert rows(raw, "v", "acum") == [(1.0, 1.0), (2.0, 3.0), (3.0, 10.0), (4.0, 10.0)]
    direct = op.cumulative(df, ["ejercicio"], "v", presummed=True)
    assert rows(direct, "v", "acum") == rows(raw, "v", "acum")


def test_union_dedupe_subset_unpivot(spark):
    a = spark.createDataFrame([("x", 1.0)], "k string, v double")
    b = spark.createDataFrame([("y", "z")], "k string, w string")
    u = op.union_all(a, b)
    assert rows(u, "k", "v", "w") == [("x", 1.0, None), ("y", None, "z")]
    df = spark.createDataFrame([("106", "e", 1), ("106", "e", 2), ("200", "e", 3), ("200", "e", 4)],
                               "cta string, e string, n int")
    d = op.dedupe_subset(df, F.col("cta") == "106", ["cta", "e"], ["n"])
    assert rows(d, "n") == [(1,), (3,), (4,)]
    w = spark.createDataFrame([("2024", 1.0, 2.0)], "ejercicio string, a double, b double")
    assert rows(op.unpivot(w, ["ejercicio"], ["a", "b"])) == [("2024", "a", 1.0), ("2024", "b", 2.0)]


def test_rank_methods_agree(spark):
    df = spark.createDataFrame([("2024", "a", -60.0), ("2024", "b", 30.0), ("2024", "c", 30.0), ("2023", "a", 5.0)],
                               "ejercicio string, cod string, importe double")
    want = rows(op.rank_by(df, "importe", ["ejercicio"], tie_break=["cod"], method="window"))
    assert rows(op.rank_by(df, "importe", ["ejercicio"], tie_break=["cod"], method="range", partitions=3)) == want


def test_rank_and_running_total_over_many_rows(spark, tmp_path):
    """Rows and per-partition totals come from one run of the range exchange: exact at any size, written in full."""
    n = 400_000
    df = spark.range(n).select("id", (F.xxhash64("id") % 90_000).alias("v"), F.concat(F.lit("x"), "id").alias("extra"))
    path = str(tmp_path / "rank")
    op.rank_by(df, "v", tie_break=["id"], absolute=False, partitions=8).write.parquet(path)
    got = spark.read.parquet(path).toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert (got["ranking"].to_numpy() == range(1, n + 1)).all() and (got["extra"] == "x" + got["id"].astype(str)).all()
    path = str(tmp_path / "sum")
    op.cumulative(df, ["v"], "v", partitions=8).write.parquet(path)
    got = spark.read.parquet(path).toPandas().sort_values("v")
    total = got.groupby("v")["v"].sum().cumsum()
    assert len(got) == n and (got["acum"].to_numpy() == total.loc[got["v"]].to_numpy()).all()
