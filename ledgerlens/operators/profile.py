"""Profiling / EDA tables.

Design rules used throughout:
* many columns -> ``unpivot`` to (column_name, value) and ``groupBy(column_name)``:
  the partial aggregate runs map-side per column, and the final aggregate of
  each column lands on its own reducer (no single task holds all columns);
* exact quantiles use ``percentile`` (value map per group); ``exact=False``
  switches to the bounded ``percentile_approx`` sketch for huge cardinalities;
* nothing is collected except fixed-size scalars (min/max, bin edges, column
  means) that parameterise the next plan.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import stats as S
from ledgerlens.operators.rollup import numeric_columns


# --------------------------------------------------------------------------- B1-B4

def basic_checks(df: DataFrame, name: str) -> DataFrame:
    """B1/A3: rows, columns and dtype counts of one table (one count job)."""
    kinds = {"numeric": 0, "string": 0, "other": 0}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            kinds["numeric"] += 1
        elif isinstance(f.dataType, T.StringType):
            kinds["string"] += 1
        else:
            kinds["other"] += 1
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows",
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(kinds["numeric"]).alias("n_numeric"),
        F.lit(kinds["string"]).alias("n_string"),
        F.lit(kinds["other"]).alias("n_other"))


def duplicate_rows(df: DataFrame, name: str) -> DataFrame:
    """B2: rows beyond the first copy of each identical row (nulls compare equal).

    A grouped count over a 256-bit digest of the whole row: the partial aggregate
    collapses copies map-side, and 32 bytes per distinct row are shuffled, however
    long its texts are.
    """
    # the default formats of timestamps stop at milliseconds
    row = F.to_json(F.struct(*df.columns), {
        "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    g = df.groupBy(F.unhex(F.sha2(row, 256)).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("n_duplicates")).select(
        F.lit(name).alias("table_name"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("n_duplicates", F.lit(0)).cast("bigint").alias("n_duplicates"))


def null_profile(df: DataFrame, exclude=(), top: int | None = None) -> DataFrame:
    """Null count and % per column, only columns with nulls, sorted desc."""
    cols = [c for c in df.columns if c not in set(exclude)]
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[S.null_count(c).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column_name", "null_count")
    out = (long.where(F.col("null_count") > 0)
           .select("column_name", F.col("null_count").cast("bigint").alias("null_count"),
                   (F.col("null_count") * 100.0 / F.col("_n")).alias("null_pct")))
    out = out.orderBy(F.desc("null_count"), "column_name")
    return out.limit(top) if top else out


def null_counts_over(profile: DataFrame, thresholds=(50.0, 70.0)) -> DataFrame:
    """How many columns exceed each null-% threshold."""
    return profile.agg(*[F.count_if(F.col("null_pct") > t).alias(f"n_over_{int(t)}")
                         for t in thresholds])


# --------------------------------------------------------------------------- B5-B10

def to_long(df: DataFrame, cols: list[str], ids=()) -> DataFrame:
    """Unpivot ``cols`` (cast to double) to (column_name, value)."""
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(list(ids), cols, "column_name", "value")


def numeric_summary(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, std (ddof 1), min, 25/50/75 %, max, skewness, kurtosis."""
    cols = cols or numeric_columns(df)
    long = to_long(df, cols)
    v = F.col("value")
    g = long.groupBy("column_name").agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        S.skew(v).alias("skewness"),
        S.kurt(v).alias("kurtosis"),
    )
    if exact:
        q = S.grouped_quantiles(long, "column_name", "value", [0.25, 0.50, 0.75]).withColumnRenamed("q", "_q")
        g = g.join(q, "column_name", "left")
    else:
        g = g.join(long.groupBy("column_name").agg(S.quantile(v, [0.25, 0.50, 0.75], False).alias("_q")),
                   "column_name", "left")
    return g.select("column_name", "count", "mean", "std", "min",
                    F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"),
                    "max", "skewness", "kurtosis")


def skew_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per-column bias-corrected skewness (one grouped pass)."""
    return to_long(df, cols).groupBy("column_name").agg(S.skew("value").alias("skewness"))


def skew_rank(df: DataFrame, cols: list[str], threshold: float = 1.5, top: int = 20) -> DataFrame:
    """Columns with |skew| above the threshold, most skewed first, top-k."""
    t = skew_table(df, cols)
    return (t.where(F.abs("skewness") > threshold)
            .orderBy(F.desc(F.abs("skewness")), "column_name").limit(top))


def categorical_top(df: DataFrame, cols: list[str], k: int = 5) -> DataFrame:
    """Per string column: top-k values (null counted as a value),
    distinct non-null count and null count."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))
    order = [F.desc("value_count"), F.asc_nulls_first("value")]
    per_col = counts.groupBy("column_name").agg(
        F.count("value").alias("n_unique"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("value_count"))), F.lit(0)).alias("n_null"))
    # two-phase top-k: the k best of each of 256 hash slices of a column, then
    # the k best of those <= 256 k rows -- no task holds all distinct values
    sliced = counts.withColumn("_s", F.abs(F.xxhash64("value")) % 256)
    w1 = Window.partitionBy("column_name", "_s").orderBy(*order)
    pre = sliced.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w = Window.partitionBy("column_name").orderBy(*order)
    top = pre.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.join(per_col, "column_name").select(
        "column_name", F.col("rank").cast("int").alias("rank"), "value", "value_count",
        "n_unique", F.col("n_null").cast("bigint").alias("n_null"))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Counts and share per value, most frequent first."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    g = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("_t"))
    return (g.crossJoin(F.broadcast(total))  # one-row side
            .select(F.col(col).alias("value"), "n", (F.col("n") / F.col("_t")).alias("share"))
            .orderBy(F.desc("n"), "value"))


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """Class counts, % and the imbalance ratio n0/n1 with the minority %."""
    agg = df.agg(F.count_if(F.col(target) == 0).alias("n0"),
                 F.count_if(F.col(target) == 1).alias("n1"),
                 F.count(target).alias("n"))
    g = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n_class"))
    return g.crossJoin(F.broadcast(agg)).select(
        F.col(target).cast("int").alias(target), "n_class",
        (F.col("n_class") * 100.0 / F.col("n")).alias("pct"),
        F.try_divide(F.col("n0").cast("double"), F.col("n1")).alias("imbalance_ratio"),
        (F.least("n0", "n1") * 100.0 / F.col("n")).alias("minority_pct"))


# --------------------------------------------------------------------------- B11-B14

def _widened(stats: DataFrame) -> DataFrame:
    """A range without width gets half a unit on either side, as ``np.histogram`` does."""
    flat = F.col("mn") == F.col("mx")
    return stats.withColumns({"mn": F.when(flat, F.col("mn") - 0.5).otherwise(F.col("mn")),
                              "mx": F.when(flat, F.col("mx") + 0.5).otherwise(F.col("mx"))})


def density_histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """``np.histogram(density=True)``: equal-width bins over [min, max],
    half-open except the last; every bin is listed (empty ones with 0)."""
    x = F.col(col).cast("double")
    med = S.grouped_quantiles(df.select(F.lit(0).alias("_g"), x.alias("_x")), "_g", "_x", [0.5])
    stats = _widened(df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.count(x).alias("n"),
                            F.avg(x).alias("mean"))).crossJoin(  # one row x one row
        med.select(F.col("q")[0].alias("median")))
    w = (F.col("mx") - F.col("mn")) / bins
    idx = F.least(F.floor((x - F.col("mn")) * bins / (F.col("mx") - F.col("mn"))),
                  F.lit(bins - 1)).cast("int")
    counted = (df.where(x.isNotNull()).crossJoin(F.broadcast(stats))  # one-row side
               .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(counted, "bin", "left").crossJoin(F.broadcast(stats))
    return out.select(
        "bin",
        (F.col("mn") + F.col("bin") * w).alias("bin_lo"),
        (F.col("mn") + (F.col("bin") + 1) * w).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        (F.coalesce("count", F.lit(0)) / (F.col("n") * w)).alias("density"),
        "mean", "median")


def grouped_histogram(df: DataFrame, col: str, group: str, bins: int) -> DataFrame:
    """B11 per group, each group over its own [min, max]; all bins listed."""
    x = F.col(col).cast("double")
    st = _widened(df.where(x.isNotNull()).groupBy(group).agg(
        F.min(x).alias("mn"), F.max(x).alias("mx"), F.count(x).alias("n")))
    # one row per group: bounded by the number of windows
    idx = F.least(F.floor((x - F.col("mn")) * bins / (F.col("mx") - F.col("mn"))), F.lit(bins - 1)).cast("int")
    cnt = (df.where(x.isNotNull()).join(F.broadcast(st), group)
           .groupBy(group, idx.alias("bin")).agg(F.count(F.lit(1)).alias("cnt")))
    grid = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("mx") - F.col("mn")) / bins
    return grid.join(cnt, [group, "bin"], "left").select(
        group, "bin", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("count"),
        (F.coalesce("cnt", F.lit(0)) / (F.col("n") * w)).alias("density"))


def kde_curve(df: DataFrame, col: str, points: int = 1000, cutoff: float = 9.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth n^(-1/5)·std) on a grid of ``points``
    spanning [min - range/2, max + range/2].

    No grid x data cross product: values are first collapsed to (value, count),
    then each value is exploded only onto the grid points within ``cutoff``
    bandwidths (beyond 9 h a kernel is < 3e-18 of its peak, below double
    precision), and contributions are summed per grid point.
    """
    x = F.col(col).cast("double")
    p = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"),
               F.min(x).alias("mn"), F.max(x).alias("mx"))
    p = p.select("*", (F.col("sd") * F.pow(F.col("n"), -0.2)).alias("h"),
                 (F.col("mn") - (F.col("mx") - F.col("mn")) * 0.5).alias("lo"),
                 (F.col("mx") + (F.col("mx") - F.col("mn")) * 0.5).alias("hi"))
    # a constant column has no bandwidth and so no curve
    p = p.select("*", ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step")).where("h > 0")
    vals = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    vals = vals.crossJoin(F.broadcast(p))  # one-row side
    first = F.greatest(F.lit(0), F.ceil((F.col("v") - cutoff * F.col("h") - F.col("lo")) / F.col("step")))
    last = F.least(F.lit(points - 1), F.floor((F.col("v") + cutoff * F.col("h") - F.col("lo")) / F.col("step")))
    ex = vals.select("v", "c", "h", "n", "lo", "step",
                     F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("i"))
    g = F.col("lo") + F.col("i") * F.col("step")
    z = (g - F.col("v")) / F.col("h")
    contrib = ex.groupBy("i").agg(
        F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("s"),
        F.first("h").alias("h"), F.first("n").alias("n"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    out = grid.join(contrib, "i", "left").crossJoin(F.broadcast(p.select("lo", "step", F.col("h").alias("h0"), F.col("n").alias("n0"))))
    return out.select(
        F.col("i").alias("grid_index"),
        (F.col("lo") + F.col("i") * F.col("step")).alias("x"),
        (F.coalesce("s", F.lit(0.0)) / (F.col("n0") * F.col("h0") * math.sqrt(2 * math.pi))).alias("density"))


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Coercing cast (bad values -> null), then drop rows with a null."""
    casted = df.select(*[F.expr(f"try_cast(`{c}` AS double)").alias(c) if c in cols else F.col(c)
                         for c in df.columns])
    return casted.na.drop(subset=cols)


def box_by_group(df: DataFrame, col: str, group: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Keep values between the 1st and 99th percentile, then box statistics
    per group: Q1, median, Q3 and the 1.5·IQR whiskers (most extreme values inside)."""
    x = F.col(col)
    b = S.grouped_quantiles(df.select(F.lit(0).alias("_g"), x.cast("double").alias("_x")), "_g", "_x", [lo, hi])
    bounds = b.select(F.col("q")[0].alias("_lo"), F.col("q")[1].alias("_hi"))
    kept = (df.select(group, x.cast("double").alias("v")).where(F.col("v").isNotNull())
            .crossJoin(F.broadcast(bounds))  # one-row side
            .where((F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi"))))
    qs = S.grouped_quantiles(kept, group, "v", [0.25, 0.5, 0.75])
    q = kept.groupBy(group).agg(F.count(F.lit(1)).alias("n")).join(qs, group).select(
        group, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.select("*", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_wl"),
                 (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_wh"))
    # per-group stats are one row per group: bounded by the number of groups
    wk = kept.join(F.broadcast(q.select(group, "_wl", "_wh")), group).groupBy(group).agg(
        F.min(F.when(F.col("v") >= F.col("_wl"), F.col("v"))).alias("whisker_lo"),
        F.max(F.when(F.col("v") <= F.col("_wh"), F.col("v"))).alias("whisker_hi"))
    return q.join(wk, group).select(group, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi")


# --------------------------------------------------------------------------- B15-B19

def _moment_partials(cols: list[str]):
    """mapInPandas body: a task's pairwise-complete means and co-moments, under a shift of its own (the
    means of its first batch)."""
    k = len(cols)

    def run(batches):
        acc, shift = None, None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype="float64", na_value=np.nan)
            m = ~np.isnan(x)
            if shift is None:
                shift = np.where(m, x, 0.0).sum(0) / np.maximum(m.sum(0), 1)
            x0 = np.where(m, x - shift, 0.0)
            mf = m.astype("float64")
            part = (mf.T @ mf, x0.T @ mf, (x0 * x0).T @ mf, x0.T @ x0)
            acc = part if acc is None else tuple(a + b for a, b in zip(acc, part))
        if acc is None:
            return
        ii, jj = np.triu_indices(k, 1)
        n = acc[0][ii, jj]
        some = n > 0
        ii, jj, n = ii[some], jj[some], n[some]
        sx, sy = acc[1][ii, jj], acc[1][jj, ii]
        yield pd.DataFrame({
            "i": ii.astype("int32"), "j": jj.astype("int32"), "n": n, "mx": shift[ii] + sx / n, "my": shift[jj] + sy / n,
            "xx": acc[2][ii, jj] - sx * sx / n, "yy": acc[2][jj, ii] - sy * sy / n, "xy": acc[3][ii, jj] - sx * sy / n})
    return run


def _chan(a, b):
    """Two parts' counts, means and co-moments as those of their union."""
    n = a["n"] + b["n"]
    dx, dy, share = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * b["n"] / n
    return F.struct(
        n.alias("n"), (a["mx"] + dx * b["n"] / n).alias("mx"), (a["my"] + dy * b["n"] / n).alias("my"),
        (a["xx"] + b["xx"] + dx * dx * share).alias("xx"), (a["yy"] + b["yy"] + dy * dy * share).alias("yy"),
        (a["xy"] + b["xy"] + dx * dy * share).alias("xy"))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every column pair (x before y), in one pass.

    Each task folds its rows into k x k co-moments about a shift of its own with two matrix
    products (Arrow batches, numpy) and emits k(k-1)/2 rows; a pair's rows, one per task, merge by
    Chan's rule, which loses nothing to the size of the means. Shuffle volume = tasks x k^2, independent of the row count.
    """
    schema = "i int, j int, n double, mx double, my double, xx double, yy double, xy double"
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(_moment_partials(cols), schema)
    own = F.array_sort(F.collect_list(F.struct("n", "mx", "my", "xx", "yy", "xy")))     # a row per task
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mx", "my", "xx", "yy", "xy")])
    tot = parts.groupBy("i", "j").agg(F.aggregate(own, none, _chan).alias("t"))
    # pairs that no row has both values of
    spark = df.sparkSession
    pairs = spark.createDataFrame([(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))], "i int, j int")
    tot = pairs.join(tot, ["i", "j"], "left").select("i", "j", F.coalesce("t", none).alias("t")).select("i", "j", "t.*")
    n = F.col("n")
    # a column constant on the pairwise rows has zero variance up to rounding
    # noise: a deviation of less than 1e-12 of the mean counts as none
    tol_x = 1e-24 * (F.col("xx") + n * F.col("mx") * F.col("mx"))
    tol_y = 1e-24 * (F.col("yy") + n * F.col("my") * F.col("my"))
    r = F.when((F.col("xx") > tol_x) & (F.col("yy") > tol_y), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
    names = F.lit(list(cols))
    return tot.select(
        F.element_at(names, F.col("i") + 1).alias("x"),
        F.element_at(names, F.col("j") + 1).alias("y"),
        n.cast("bigint").alias("n_pairs"),
        # greatest/least skip nulls, so clip only defined coefficients
        F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))).alias("r"))


def correlation_with(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Correlation of each column with one target column (B17-B19), one grouped pass."""
    long = to_long(df, cols, ids=[target])
    return long.groupBy("column_name").agg(
        F.count(F.when(F.col("value").isNotNull() & F.col(target).isNotNull(), 1)).alias("n_pairs"),
        _pearson("value", target).alias("r"))


def _pearson(a: str, b: str):
    x = F.col(a).cast("double")
    y = F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xm = F.when(both, x)
    ym = F.when(both, y)
    # covar/var instead of corr(): corr divides by zero under ANSI for constants
    return F.try_divide(F.covar_pop(xm, ym), F.sqrt(F.var_pop(xm) * F.var_pop(ym)))
