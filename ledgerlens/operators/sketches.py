"""Mergeable sketches (D5's approximate counts, M8 / W2's stored references).

A sketch of a column's values, per part of the data (a day, say), is written once. Sketches of parts merge
to the sketch of any union of them, so a longer window or a new reference reads sketches,
not rows. HLL counts distinct values (standard error 1.04 / sqrt(2 ** lg_k)); KLL gives
quantiles within a rank error that its size sets (about 1.3 % for k = 200, two-sided, 99 %).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14
KLL_K = 800
#: Rank error of a merged KLL sketch of KLL_K, 99 % two-sided: 2.446 / k ** 0.9433.
RANK_ERROR = 2.446 / KLL_K ** 0.9433


def distinct_sketches(df: DataFrame, cols: list[str], by: tuple = (), lg_k: int = LG_K) -> DataFrame:
    """(*by, column_name, sketch) of the distinct non-null values of each column, as text."""
    long = df.select(*by, *[F.col(c).cast("string").alias(f"_v_{c}") for c in cols]).unpivot(
        list(by), [f"_v_{c}" for c in cols], "column_name", "value")
    return (long.where(F.col("value").isNotNull())
            .groupBy(*by, F.expr("substring(column_name, 4)").alias("column_name"))
            .agg(F.hll_sketch_agg("value", lg_k).alias("sketch")))


def distinct_counts(sketches: DataFrame, by: tuple = ()) -> DataFrame:
    """(*by, column_name, n_unique): estimates for the union of all parts that agree in ``by``."""
    return sketches.groupBy(*by, "column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_unique"))


def value_sketches(long: DataFrame, by: tuple = (), k: int = KLL_K) -> DataFrame:
    """(*by, feature, sketch) of long rows (feature, value)."""
    v = F.col("value").cast("double")
    return (long.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, "feature")
            .agg(F.kll_sketch_agg_double(v, k).alias("sketch")))


def merged(sketches: DataFrame, by: tuple = (), k: int = KLL_K) -> DataFrame:
    return sketches.groupBy(*by, "feature").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_edges(sketches: DataFrame, buckets: int = 10) -> DataFrame:
    """(feature, edges): decile edges of stored reference sketches, as ``drift.decile_edges`` gives from rows."""
    shares = F.array(*[F.lit(i / buckets) for i in range(buckets + 1)])
    return merged(sketches).select(
        "feature", F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", shares))).alias("edges"))


def sketch_counts(sketches: DataFrame, edges: DataFrame, by: tuple = ()) -> DataFrame:
    """(*by, feature, bin, n): how many values each bin of ``edges`` holds, by the sketches' ranks; bins are
    [e_i, e_i+1), the last one closed. Values outside the edges count in the outer bins."""
    own = {r["feature"]: r["edges"] for r in edges.collect() if len(r["edges"]) >= 2}     # a row per feature
    below = F.lit(None).cast("array<double>")
    for feature, e in own.items():
        # ranks are asked for at constants only
        inner = F.kll_sketch_get_rank_double("sketch", F.lit(e[1:-1])) if len(e) > 2 else F.array().cast("array<double>")
        below = F.when(F.col("feature") == F.lit(feature), F.concat(F.array(F.lit(0.0)), inner, F.array(F.lit(1.0)))).otherwise(below)
    rows = merged(sketches, by).select(*by, "feature", F.kll_sketch_get_n_double("sketch").alias("n"), below.alias("_below"))
    upper, lower = (F.slice("_below", F.lit(at), F.size("_below") - 1) for at in (2, 1))
    shares = F.zip_with(upper, lower, lambda hi, lo: F.greatest(hi - lo, F.lit(0.0)))
    return rows.where("_below is not null").select(*by, "feature", "n", F.posexplode(shares).alias("bin", "share")).select(
        *by, "feature", "bin", (F.col("share") * F.col("n")).alias("n"))
