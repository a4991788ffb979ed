"""ROC / PR curves and their areas (K3-K5), exact and distributed.

1. ``groupBy(score)`` -> (score, pos, neg): ties are one point (as in
   sklearn's curve builder), and a score value holding a third of all rows
   is a single row after the map-side partial aggregate.
2. Running counts in descending score order without a single-partition
   window: B range buckets from quantile edges of the distinct scores
   (B-1 doubles, fetched once), a binary-search ``CASE`` tree assigns buckets
   inside generated code, per-bucket totals (B rows) give each bucket's
   offset, and the running sum is a window partitioned by bucket.
3. Every curve point k only needs its predecessor k-1, which is
   (tp_k - pos_k, fp_k - neg_k), so both areas are plain aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leaves of all bucket trees together; more no longer compile.
MAX_LEAVES = 1024
F1_EPS = 1e-8  # fixed value: F1 denominator guard of the threshold scan


def score_counts(df: DataFrame, score: str = "score", label: str = "label", by: tuple = ()) -> DataFrame:
    """(*by, score, pos, neg): all that any threshold metric, curve or area needs."""
    y = F.col(label).cast("long")
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def confusion_at(counts: DataFrame, cut, by: tuple = ()) -> DataFrame:
    """K1 at ``cut`` (a number, or a column of ``counts``), from the counts alone."""
    over = F.col("score") >= (F.lit(cut) if isinstance(cut, (int, float)) else cut)
    part = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    return counts.groupBy(*by).agg(part("neg", ~over).alias("tn"), part("neg", over).alias("fp"),
                                   part("pos", ~over).alias("fn"), part("pos", over).alias("tp"))


def _bucket_tree(x: Column, edges: list[float], lo: int, hi: int) -> Column:
    """Bucket index in [lo, hi] = number of edges < x, by binary search."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x <= F.lit(edges[mid]), _bucket_tree(x, edges, lo, mid)).otherwise(
        _bucket_tree(x, edges, mid + 1, hi))


def _n_buckets(spark) -> int:
    """Ranges that the running count is split in: as many as a shuffle has tasks, several times."""
    return max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def cumulative_counts(counts: DataFrame, buckets: int | None = None, by: tuple = ()) -> DataFrame:
    """(*by, score, pos, neg) -> + tp, fp: counts of rows with score >= this score.

    ``by`` (a model's name, say) has few values: each has its own bucket edges."""
    spark = counts.sparkSession
    b = min(buckets or _n_buckets(spark), MAX_LEAVES)
    probs = [i / b for i in range(1, b)]
    found = counts.groupBy(*by).agg(F.array_distinct(F.percentile_approx("score", probs, 10000)).alias("_e"))
    own = [(row, sorted(row["_e"] or [])) for row in found.collect()]
    if sum(len(edges) for _, edges in own) <= MAX_LEAVES:
        bucket = F.lit(0)
        for row, edges in own:
            tree = _bucket_tree(F.col("score"), edges, 0, len(edges)) if edges else F.lit(0)
            mine = F.lit(True)
            for c in by:
                mine = mine & F.col(c).eqNullSafe(F.lit(row[c]))
            bucket = F.when(mine, tree).otherwise(bucket) if by else tree
        tagged = counts.withColumn("_b", bucket.cast("int"))
    else:
        # many values of ``by``: their edges as a table (a row each, of at most B numbers)
        e = counts.sparkSession.createDataFrame([(*[row[c] for c in by], edges) for row, edges in own],
                                                found.schema).toDF(*[f"_by_{c}" for c in by], "_e")
        same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        below = F.size(F.filter("_e", lambda x: x < F.col("score")))
        tagged = counts.join(F.broadcast(e), same).select(*counts.columns, below.alias("_b"))
    totals = tagged.groupBy(*by, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    # descending score order = descending bucket; offsets = totals of higher buckets
    wo = Window.partitionBy(*by).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(  # at most B rows per value of ``by``: a bounded, broadcastable side
        *by, "_b", F.coalesce(F.sum("_bp").over(wo), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(wo), F.lit(0)).alias("_on"),
        F.sum("_bp").over(Window.partitionBy(*by)).alias("P"),
        F.sum("_bn").over(Window.partitionBy(*by)).alias("N"))
    wr = Window.partitionBy(*by, "_b").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (tagged.join(F.broadcast(offsets), [*by, "_b"])
            .select(*by, "score", "pos", "neg", "P", "N",
                    (F.col("_op") + F.sum("pos").over(wr)).alias("tp"),
                    (F.col("_on") + F.sum("neg").over(wr)).alias("fp")))


def roc_points(cum: DataFrame) -> DataFrame:
    """K3: (threshold, fpr, tpr) for every distinct score (no point dropping)."""
    return cum.select(F.col("score").alias("threshold"),
                      F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                      F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def pr_points(cum: DataFrame) -> DataFrame:
    """K4: (threshold, precision, recall) per distinct score; the curve's end
    point (recall 0, precision 1) is implied and not listed."""
    return cum.select(F.col("score").alias("threshold"),
                      (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                      F.try_divide(F.col("tp"), F.col("P")).alias("recall"))


def areas(cum: DataFrame, by: tuple = ()) -> DataFrame:
    """K3/K4/K5: ROC-AUC, PR-AUC (trapezoids) and the baseline positive rate."""
    tp_prev = F.col("tp") - F.col("pos")
    fp_prev = F.col("fp") - F.col("neg")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prec_prev = F.when(tp_prev + fp_prev == 0, F.lit(1.0)).otherwise(tp_prev / (tp_prev + fp_prev))
    roc_term = F.col("neg") * (F.col("tp") + tp_prev)
    pr_term = F.col("pos") * (prec + prec_prev)
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(roc_term), 2.0 * F.first("P") * F.first("N")).alias("roc_auc"),
        F.try_divide(F.sum(pr_term), 2.0 * F.first("P")).alias("pr_auc"),
        F.try_divide(F.first("P"), (F.first("P") + F.first("N")).cast("double")).alias("baseline_rate"))


def threshold_scan(cum: DataFrame) -> DataFrame:
    """K8: precision, recall and F1 = 2pr/(p+r+1e-8) at every threshold."""
    p = pr_points(cum)
    return p.withColumn("f1", 2 * F.col("precision") * F.col("recall")
                        / (F.col("precision") + F.col("recall") + F1_EPS))


def best_threshold(scan: DataFrame, min_recall: float | None = None) -> DataFrame:
    """K8/K9: the F1-optimal threshold (first in ascending threshold order on
    ties); with ``min_recall`` the best among thresholds meeting it, falling
    back to the unconstrained optimum when none does."""
    order = [F.desc("f1"), F.asc("threshold")]
    best = scan.orderBy(*order).limit(1).select(F.col("threshold").alias("f1_threshold"))
    if min_recall is None:
        return best
    cons = (scan.where(F.col("recall") >= min_recall).orderBy(*order).limit(1)
            .select(F.col("threshold").alias("c_threshold")))
    return best.join(cons, how="left").select(
        "f1_threshold", F.coalesce("c_threshold", "f1_threshold").alias("constrained_threshold"),
        F.col("c_threshold").isNotNull().alias("constraint_met"))


def nearest(scan: DataFrame, target: float = 0.5) -> DataFrame:
    """The curve point whose threshold is nearest ``target`` (first in
    ascending threshold order on ties)."""
    return scan.orderBy(F.abs(F.col("threshold") - target), "threshold").limit(1)
