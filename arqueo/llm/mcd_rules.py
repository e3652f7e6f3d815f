"""Robust multivariate outlier rule per language and source, with DataFrame functions only.

Method: each document gives a vector of transformed statistics (log of the words
and of their mean length; square roots of the shares of symbols, repeated lines
and repeated 8-word windows).  Per (language, source) the minimum-covariance-
determinant estimate is found by C-steps: the ``SUBSET`` of smallest Mahalanobis
distances gives the next mean and covariance, until no group's determinant changes
(``STEPS`` times at most).  Two starts, from medians and absolute deviations and from
the plain mean and covariance, go through this; of each group's two ends the one of
smaller determinant is kept and made consistent for a normal law.  A document whose
squared distance is over the chi-square ``LEVEL`` is rejected.

Scale: the texts are read once, the statistics written as a narrow table.  All
estimates are sums and counts aggregated before their shuffle, so a source with
a third of all rows costs a few rows per task.  Values lie on a fixed grid: sums
are exact decimals whatever the order of tasks, and medians and the subset's
bound are exact percentiles over a bounded number of grid values.

Groups of fewer than ``LEAST`` documents are pooled per language, then over all;
a pool that is still smaller rejects nothing.  Floors (standard deviations) are
added to the variances, as most documents have no symbol and no repeat at all: for
the sparse statistics it is what one symbol, one repeated line and the ``REPEAT``
words of one repeated passage are in a text of the group's median size, for the
other two ``FLOORS``.

Defined cases: a null text has no words and fails the base rule; null languages
and sources are groups of their own; documents that fail the base rule take no
part in the estimates; every row gives one result row, repeated rows included.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_RUN, BLANKS, row_key, written
from .line_windows import let

STATS = ["x1", "x2", "x3", "x4", "x5"]
#: Logarithms (in hundredths) of the sizes that the sparse statistics are shares of.
SIZES = ["size3", "size4", "size5"]
FLOORS, REPEAT = [0.35, 0.15], 16
SUBSET, STEPS, LEVEL, LEAST = 0.75, 20, 0.9999, 50
GRID = 10_000
SALTS = 16


def chi_square(p: int, x: float) -> float:
    """P(chi-square with p degrees of freedom <= x): series of the lower incomplete gamma function."""
    a, x = p / 2, x / 2
    term = total = 1 / a
    k = a
    while abs(term) > 1e-15 * total:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi_square_quantile(p: int, level: float) -> float:
    lo, hi = 1e-9, 500.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(p, mid) < level else (lo, mid)
    return lo


def repeat_words(hashes: Column, width: int = 8) -> Column:
    """Words inside windows of ``width`` (a power of two) that occur twice or more, from the words' hashes."""

    def joined(h: Column, step: int) -> Column:
        n = F.greatest(F.size(h) - step, F.lit(0))
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))

    def covered(at: Column) -> Column:
        n = F.size(at) - 1
        gaps = F.zip_with(F.slice(at, F.lit(1), n), F.slice(at, F.lit(2), n), lambda a, b: F.least(F.lit(width), b - a))
        return F.aggregate(gaps, F.lit(width), lambda s, x: s + x)

    def places(own: Column) -> Column:
        same = lambda x, other: F.coalesce(other["h"] == x["h"], F.lit(False))
        twice = F.filter(own, lambda x, j: same(x, F.get(own, j - 1)) | same(x, F.get(own, j + 1)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def count(h: Column) -> Column:
        own = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(let(own, places), covered)).otherwise(F.lit(0))

    step, windows = 1, lambda h: let(h, count)
    while step < width:
        step *= 2
    while step > 1:
        step //= 2
        windows = (lambda inner, by: lambda h: let(joined(h, by), inner))(windows, step)
    return let(hashes, windows)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Base statistics of every whole text: key, language, source, n_words and the four others, n_lines."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(row_key(id_col, text).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
                      text.alias("t"))
    hashes = F.transform(F.array_remove(F.split("t", BLANK_RUN), ""), lambda w: F.xxhash64(w))
    solid = F.col("t")
    for c in BLANKS:
        solid = F.replace(solid, F.lit(c), F.lit(""))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    own = own.select("key", "lang", "source", hashes.alias("h"), F.char_length(solid).cast("long").alias("word_chars"),
                     F.char_length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                     let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("l"))
    return own.select("key", "lang", "source", F.size("h").cast("long").alias("n_words"), "word_chars", "n_symbols",
                      F.col("l.d").alias("n_dup_lines"), repeat_words(F.col("h")).cast("long").alias("n_repeat_words"), F.col("l.n").alias("n_lines"))


def vector() -> list[Column]:
    """The transformed statistics on the grid (whole numbers), and the sizes."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = [F.ln(n), F.ln(F.greatest(F.col("word_chars") / n, F.lit(1.0))), F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
              F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), F.sqrt(F.col("n_repeat_words") / n)]
    sizes = [F.round(F.ln(F.greatest(F.col(c), F.lit(1))) * 100).cast("int").alias(x) for c, x in zip(("word_chars", "n_lines", "n_words"), SIZES)]
    return [F.round(v * GRID).cast("long").alias(x) for v, x in zip(values, STATS)] + sizes


def grouped(stats: DataFrame) -> DataFrame:
    """Rows that pass the base rule with ``gid``, the hash of their group or pool; null where nothing is estimated."""
    own = stats.where("NOT base_failed")
    named = lambda level, *cols: F.xxhash64(F.lit(level), *(x for c in cols for x in (F.col(c).isNull(), c)))
    groups = own.groupBy("lang", "source").agg(F.count("*").alias("n")).withColumn("small", F.col("n") < LEAST)
    pools = groups.where("small").groupBy("lang").agg(F.sum("n").alias("pool"))
    rest = pools.where(F.col("pool") < LEAST).agg(F.sum("pool")).first()[0] or 0  # one number
    groups = (groups.alias("g").join(pools.alias("p"), F.col("g.lang").eqNullSafe(F.col("p.lang")), "left")
              .select("g.lang", "g.source", F.when(~F.col("small"), named(1, "g.lang", "g.source")).when(F.col("pool") >= LEAST, named(2, "g.lang"))
                      .when(F.lit(rest >= LEAST), F.xxhash64(F.lit(3))).alias("gid")))
    g = written(groups, "groups").alias("g")
    return own.alias("o").join(g, F.col("o.lang").eqNullSafe(F.col("g.lang")) & F.col("o.source").eqNullSafe(F.col("g.source"))).select("o.key", *STATS, *SIZES, "gid")


def factor(params: DataFrame, scale: float, *kept: str) -> DataFrame:
    """gid, m1.., and the Cholesky factor l11, l21, l22, .. of scale times the covariance plus the squared floors f1..,
    its determinant and the columns ``kept``."""
    p = len(STATS)
    for i in range(1, p + 1):
        for j in range(1, i + 1):
            rest = F.col(f"s{i}{j}") * F.lit(scale)
            if i == j:
                rest = rest + F.col(f"f{i}") * F.col(f"f{i}")
            for k in range(1, j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            params = params.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    root = math.prod((F.col(f"l{i}{i}") for i in range(2, p + 1)), start=F.col("l11"))
    return params.select("gid", *(f"m{i}" for i in range(1, p + 1)), *(f"l{i}{j}" for i in range(1, p + 1) for j in range(1, i + 1)), (root * root).alias("det"), *kept)


def beside(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` joined with the one row of their group; salted, so that a group with a third of all rows is ``SALTS``
    pieces of work in the join and is aggregated in each piece before it meets."""
    salts = F.explode(F.array(*map(F.lit, range(SALTS))))
    own = rows.withColumn("salt", F.pmod(F.xxhash64("key", *STATS), F.lit(SALTS)).cast("int"))
    return own.join(groups.withColumn("salt", salts), ["gid", "salt"]).drop("salt")


def distances(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``rows`` of groups with an estimate, with d2, the squared Mahalanobis distance."""
    own = beside(rows, params)
    for i, x in enumerate(STATS, 1):
        z = F.col(x) / F.lit(float(GRID)) - F.col(f"m{i}")
        for k in range(1, i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        own = own.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    return own.select(*rows.columns, sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(2, len(STATS) + 1)), F.col("z1") * F.col("z1")).alias("d2"))


def moments(rows: DataFrame) -> DataFrame:
    """Per group: means m1.. and covariances s11, s21, .. from exact decimal sums."""
    p = range(1, len(STATS) + 1)
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    sums = rows.groupBy("gid").agg(F.count("*").alias("n"), *(exact(F.col(f"x{i}")).alias(f"t{i}") for i in p),
                                   *(exact(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i in p for j in range(1, i + 1)))
    mean = {i: F.col(f"t{i}").cast("double") / F.col("n") / GRID for i in p}
    return sums.select("gid", *(mean[i].alias(f"m{i}") for i in p),
                       *((F.col(f"q{i}{j}").cast("double") / F.col("n") / GRID**2 - mean[i] * mean[j]).alias(f"s{i}{j}") for i in p for j in range(1, i + 1)))


def start(rows: DataFrame) -> DataFrame:
    """Per group: medians, squared scaled median absolute deviations on the diagonal, and the floors."""
    p = range(1, len(STATS) + 1)
    coarse = 100  # medians to two decimals keep the number of values in an aggregation buffer bounded
    half = lambda c: F.percentile(c, 0.5)
    # one symbol, line or passage in a text of median size, as the square root of its share
    one = [F.sqrt(F.lit(float(n)) * F.exp(-half(x) / 100)) for x, n in zip(SIZES, (1, 1, REPEAT))]
    mids = written(rows.groupBy("gid").agg(*(half(F.round(F.col(f"x{i}") / coarse)).alias(f"c{i}") for i in p),
                                           *(f.alias(f"f{i}") for i, f in enumerate([*map(F.lit, FLOORS), *one], 1))), "medians")
    off = beside(rows, mids).groupBy("gid").agg(*(F.first(f"{c}{i}").alias(f"{c}{i}") for c in "cf" for i in p),
                                                *(half(F.abs(F.round(F.col(f"x{i}") / coarse) - F.col(f"c{i}"))).alias(f"a{i}") for i in p))
    unit = coarse / GRID
    return off.select("gid", *((F.col(f"c{i}") * unit).alias(f"m{i}") for i in p),
                      *(((F.col(f"a{i}") * (1.4826 * unit)) ** 2 if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i in p for j in range(1, i + 1)), *(f"f{i}" for i in p))


def estimates(rows: DataFrame) -> DataFrame:
    """The groups' MCD estimates as written factors, consistent for a normal law."""
    p = len(STATS)
    consistent = SUBSET / chi_square(p + 2, chi_square_quantile(p, SUBSET))
    tried = lambda n: F.xxhash64("gid", F.lit(n))
    medians = written(start(rows), "mcd")
    floors, spread = [f"f{i}" for i in range(1, p + 1)], [f"s{i}{j}" for i in range(1, p + 1) for j in range(1, i + 1)]
    # both starts at once, each group once for each of them
    groups = written(medians.select("gid", F.explode(F.array(F.lit(0), F.lit(1))).alias("start")).select("gid", F.xxhash64("gid", "start").alias("try")), "tries")
    plain = moments(rows).join(medians.select("gid", *floors), "gid")
    first = medians.withColumn("gid", tried(0)).unionByName(plain.withColumn("gid", tried(1)))
    both = rows.select("key", *STATS, F.explode(F.array(tried(0), tried(1))).alias("gid"))
    params = written(factor(first, 1.0, *floors), "mcd")
    for _ in range(STEPS):
        near = distances(both, params).withColumn("r", F.round(F.ln(F.col("d2") + 1), 3))
        bound = written(near.groupBy("gid").agg(F.percentile("r", SUBSET).alias("bound")), "bound")
        before = params.select("gid", *floors, F.col("det").alias("was"))
        raw = moments(beside(near, bound).where("r <= bound")).join(before, "gid")
        params = written(factor(raw, 1.0, *spread, *floors, "was"), "mcd")
        if params.where(F.abs(F.col("det") - F.col("was")) > 1e-9 * F.col("was")).isEmpty():
            break
    best = params.join(groups, params["gid"] == groups["try"]).groupBy(groups["gid"]).agg(F.min(F.struct("det", "try")).alias("best"))
    best = best.select("gid", F.col("best.try").alias("try"))
    means = [f"m{i}" for i in range(1, p + 1)]
    chosen = params.select(F.col("gid").alias("try"), *means, *spread, *floors).join(best, "try").drop("try")
    return written(factor(chosen, consistent), "mcd")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: key (id and text hashes), base statistics, base_failed, d2 (null without estimate), kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stats = written(statistics(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", failed).select("*", *vector()), "statistics")
    rows = written(grouped(stats).where("gid IS NOT NULL"), "vectors")
    far = distances(rows, estimates(rows)).select("key", "d2").distinct()
    cutoff = chi_square_quantile(len(STATS), LEVEL)
    s, f = stats.alias("s"), written(far.where(F.col("d2") > cutoff), "outliers").alias("f")
    same = F.col("s.key.id").eqNullSafe(F.col("f.key.id")) & (F.col("s.key.a") == F.col("f.key.a")) & (F.col("s.key.b") == F.col("f.key.b"))
    return s.join(f, same, "left").select(
        "s.key", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("f.d2").alias("outlier_distance"), (~F.col("base_failed") & F.col("f.d2").isNull()).alias("kept"))
