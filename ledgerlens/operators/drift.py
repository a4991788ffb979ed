"""Population-stability drift.

``psi`` computes every (feature, window) PSI of a long-form table in a few
grouped passes: decile edges per feature (exact ``percentile`` or the bounded
sketch) -> one small edges table (features x 11 doubles, broadcast) -> bin
index per value -> grouped counts for the reference and for every window ->
PSI per (feature, window). No loop over features or windows on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import stats as S

PSI_EPS = 1e-8          # fixed value: added to every bin count
DRIFTED = 0.20          # fixed value
MODERATE = 0.10         # fixed value


def bin_index(x: Column, edges: Column) -> Column:
    """``np.histogram`` bin of x for sorted edges: [e_i, e_{i+1}), last bin
    closed, out-of-range -> null."""
    m = F.size(edges)
    below = F.size(F.filter(edges, lambda e: e <= x))
    idx = F.when(x == F.element_at(edges, -1), m - 2).otherwise(below - 1)
    return F.when((x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1)), idx)


def decile_edges(ref_long: DataFrame, by: list[str], buckets: int = 10, exact: bool = True) -> DataFrame:
    probs = [i / buckets for i in range(buckets + 1)]
    v = F.col("value").cast("double")
    if not exact:
        q = F.percentile_approx(v, probs, 10000)
        return ref_long.where(v.isNotNull()).groupBy(*by).agg(F.array_sort(F.array_distinct(q)).alias("edges"))
    key = F.concat_ws("\u0001", *[F.col(b).cast("string") for b in by])
    keyed = ref_long.select(*by, key.alias("_k"), v.alias("value"))
    q = S.grouped_quantiles(keyed, "_k", "value", probs)
    # a feature's names come from its key, not from one more scan of the rows
    part = F.split("_k", "\u0001", -1)
    names = [part[i].cast(ref_long.schema[b].dataType).alias(b) for i, b in enumerate(by)]
    return q.select(*names, F.array_sort(F.array_distinct("q")).alias("edges"))


def psi(ref_long: DataFrame, act_long: DataFrame, by: list[str], window: str = "window",
        buckets: int = 10, exact: bool = True) -> DataFrame:
    """M8: PSI of every window of ``act_long`` against ``ref_long``, per ``by``.

    Both inputs are long form (*by, value) and (*by, window, value).
    A feature with fewer than 3 distinct edges gets PSI 0.0.
    """
    edges = decile_edges(ref_long, by, buckets, exact)
    # one row per feature: bounded by the schema width
    e_b = F.broadcast(edges)

    def binned(df):
        return (df.where(F.col("value").isNotNull()).join(e_b, by)
                .withColumn("bin", bin_index(F.col("value").cast("double"), F.col("edges")))
                .where(F.col("bin").isNotNull()))

    ref_c = binned(ref_long).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("e_n"))
    act_c = binned(act_long).groupBy(*by, window, "bin").agg(F.count(F.lit(1)).alias("a_n"))
    keys = act_long.select(*by, window).distinct()
    return psi_from_counts(edges, ref_c, act_c, keys, by, window)


def psi_from_counts(edges: DataFrame, ref_c: DataFrame, act_c: DataFrame, keys: DataFrame,
                    by: list[str], window: str = "window") -> DataFrame:
    """M8 from bin counts: (by, bin, e_n) and (by, window, bin, a_n) (for
    instance maintained by a streaming aggregation) -> PSI per (by, window)."""
    keys = keys.join(F.broadcast(edges), by)  # one edges row per feature
    grid = keys.select(*by, window, (F.size("edges") - 1).alias("n_bins"),
                       F.explode(F.sequence(F.lit(0), F.greatest(F.size("edges") - 2, F.lit(0)))).alias("bin"))
    full = (grid.join(ref_c, [*by, "bin"], "left").join(act_c, [*by, window, "bin"], "left")
            .select(*by, window, "n_bins", "bin",
                    (F.coalesce("e_n", F.lit(0)) + PSI_EPS).alias("e"),
                    (F.coalesce("a_n", F.lit(0)) + PSI_EPS).alias("a")))
    w = Window.partitionBy(*by, window)  # one partition per (feature, window): n_bins rows
    pct = full.select(*by, window, "n_bins",
                      (F.col("e") / F.sum("e").over(w)).alias("ep"),
                      (F.col("a") / F.sum("a").over(w)).alias("ap"))
    out = pct.groupBy(*by, window).agg(
        F.first("n_bins").alias("n_bins"),
        F.sum((F.col("ap") - F.col("ep")) * F.log(F.col("ap") / F.col("ep"))).alias("psi"))
    # fewer than 3 unique edges (= fewer than 2 bins) -> 0.0
    return out.select(*by, window, F.when(F.col("n_bins") >= 2, F.col("psi")).otherwise(F.lit(0.0)).alias("psi"))


def drift_class(x: Column) -> Column:
    """Drifted (> 0.20) / moderate ([0.10, 0.20]) / stable."""
    return (F.when(x > DRIFTED, "drifted").when(x >= MODERATE, "moderate").otherwise("stable"))


def score_status(x: Column) -> Column:
    """RETRAIN (> 0.20) / MONITOR (> 0.10) / STABLE."""
    return F.when(x > DRIFTED, "RETRAIN").when(x > MODERATE, "MONITOR").otherwise("STABLE")
