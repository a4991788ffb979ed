"""Column statistics with pandas semantics.

All helpers return Column expressions so that a caller can fit every column's
statistics in ONE aggregate pass (partial + final hash aggregate, no extra shuffle
beyond the single exchange of the partial buffers).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-6  # fixed value: denominator guard of the domain ratios


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


TIE_NUDGE = 1.000000000001  # fixed value: moves exact decimal ties clear of float noise


def fround(c, scale: int = 4) -> Column:
    """Comparison rounding, identical in every engine: ``round(x*(1+1e-12)*10^s)/10^s``.

    ``F.round`` rounds the shortest decimal string while C-style engines round the
    binary value, so exact ties (a mean of cents over 8 rows = 0.43875) differ;
    the 1e-12 relative nudge makes ties round away from zero in both, whatever
    the summation order's last-bit noise was.
    """
    m = float(10 ** scale)
    # "+ 0.0" turns a rounded -0.0 into 0.0 (engines differ on the sign of zero)
    return F.round(col(c) * F.lit(TIE_NUDGE) * F.lit(m)) / F.lit(m) + F.lit(0.0)


def sql_round(expr: str, scale: int = 4) -> str:
    """The same rounding written for the SQL oracle."""
    return f"(round(({expr}) * CAST({TIE_NUDGE!r} AS DOUBLE), {scale}) + 0.0)"


def eps_ratio(a, b) -> Column:
    """a / (b + 1e-6): the reference's guarded ratio."""
    return F.try_divide(col(a), col(b) + F.lit(EPS))


def skew(c) -> Column:
    """Bias-corrected sample skewness G1 (pandas ``.skew()``), 0 for constants, null for n<3."""
    x = col(c).cast("double")
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(x) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def kurt(c) -> Column:
    """Bias-corrected excess kurtosis G2 (pandas ``.kurt()``), 0 for constants, null for n<4."""
    x = col(c).cast("double")
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.var_pop(x) == 0, F.lit(0.0))
            .otherwise(((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))))


def quantile(c, p, exact: bool = True, accuracy: int = 10000) -> Column:
    """Linear-interpolated quantile (pandas default). ``exact=False`` switches to
    the bounded-memory sketch for columns with very many distinct values."""
    x = col(c).cast("double")
    if exact:
        return F.percentile(x, p)
    return F.percentile_approx(x, p, accuracy)


def null_count(c) -> Column:
    return F.count_if(col(c).isNull())


def present(cols) -> Column:
    """Array of the non-null values of ``cols`` (row-wise, Q10)."""
    return F.filter(F.array(*[col(c).cast("double") for c in cols]), lambda v: v.isNotNull())


def row_mean(cols) -> Column:
    arr = present(cols)
    return F.try_divide(F.aggregate(arr, F.lit(0.0), lambda a, v: a + v), F.size(arr).cast("double"))


def row_sum(cols) -> Column:
    """Row-wise sum skipping nulls; all-null rows give 0 (pandas sum(axis=1))."""
    return F.aggregate(present(cols), F.lit(0.0), lambda a, v: a + v)


def row_std(cols) -> Column:
    """Row-wise sample std (ddof=1) over the present values; null below 2 values."""
    arr = present(cols)
    n = F.size(arr).cast("double")
    mean = F.try_divide(F.aggregate(arr, F.lit(0.0), lambda a, v: a + v), n)
    ss = F.aggregate(arr, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def row_min(cols) -> Column:
    return F.least(*[col(c).cast("double") for c in cols])


def row_max(cols) -> Column:
    return F.greatest(*[col(c).cast("double") for c in cols])


ACCURACY = 10_000          # ranks of a sketch are off by at most n / ACCURACY
WHOLE = ACCURACY * 4 // 10  # groups up to this size need no bracket
MAX_GROUPS = 10_000        # brackets of up to so many groups go to the driver


def _brackets(rows, probs):
    """Per group and probability: the wanted ranks and values around them, from one
    sketch pass; None if there are too many groups."""
    margin = 8.0 / ACCURACY
    asked = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    found = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"),
                                   F.percentile_approx("_v", asked, ACCURACY).alias("s"))
    found = found.limit(MAX_GROUPS + 1).collect()
    if len(found) > MAX_GROUPS:
        return None
    at = {p: i for i, p in enumerate(asked)}
    out = []
    for r in found:
        for pi, p in enumerate(probs):
            h = (r.n - 1) * p
            lo, hi = (r.s[at[min(1.0, max(0.0, p + d))]] for d in (-margin, margin))
            if r.n <= WHOLE or p - margin <= 0:
                lo = None                       # nothing is below
            if r.n <= WHOLE or p + margin >= 1:
                hi = None                       # nothing is above
            out.append((r._g, pi, float(h), int(h // 1), int(-(-h // 1)), lo, hi))
    return out


def grouped_quantiles(long, group: str, value: str, probs: list[float]):
    """Exact linear-interpolation quantiles per group (pandas / numpy 'linear'),
    without holding or shuffling a group's values.

    1. One pass sketches each group's size and, for every probability, a value surely
       below and one surely above the wanted ranks (the sketch's error is known).
    2. A second pass counts what lies below each bracket and the distinct values in it:
       one row per task for all that is below, and about 16 / ACCURACY of the rows inside.
       The wanted ranks are read off the running count of a bracket.
    Groups up to WHOLE rows are their own bracket. The brackets (groups x probabilities)
    go through the driver up to MAX_GROUPS groups; with more, and so smaller, groups each
    is aggregated as a value histogram. Returns (group, q), q aligned with ``probs``.
    """
    from pyspark.sql import Window

    v = F.col(value).cast("double")
    rows = long.where(v.isNotNull()).select(F.col(group).alias("_g"), v.alias("_v"))
    found = _brackets(rows, probs)
    if found is None:
        return rows.groupBy(F.col("_g").alias(group)).agg(F.percentile("_v", probs).alias("q"))
    kind = long.schema[group].dataType.simpleString()
    sides = long.sparkSession.createDataFrame(
        found, f"_g {kind}, pi int, h double, p0 long, p1 long, lo double, hi double")
    inside = F.col("lo").isNull() | (F.col("_v") >= F.col("lo"))
    met = rows.join(F.broadcast(sides), "_g").where(F.col("hi").isNull() | (F.col("_v") <= F.col("hi")))
    # a null value stands for all that is below the bracket
    counted = met.groupBy("_g", "pi", "h", "p0", "p1", F.when(inside, F.col("_v")).alias("x")).agg(
        F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy("_g", "pi").orderBy(F.asc_nulls_first("x")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("end", F.sum("c").over(run))
    covers = lambda p: F.col("x").isNotNull() & (F.col(p) < F.col("end")) & (F.col(p) >= F.col("end") - F.col("c"))
    per = ranked.groupBy("_g", "pi", "h").agg(F.max(F.when(covers("p0"), F.col("x"))).alias("a"),
                                              F.max(F.when(covers("p1"), F.col("x"))).alias("b"))
    q = F.when(F.col("a").isNull() | F.col("b").isNull(),
               F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
    q = q.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h")))
    out = per.groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("pi", q.alias("q")))).alias("l"))
    return out.select(F.col("_g").alias(group), F.transform("l", lambda s: s["q"]).alias("q"))
