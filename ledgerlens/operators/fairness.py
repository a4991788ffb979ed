"""Group fairness audit.

Per-group metrics are one grouped conditional-count aggregate; the overall
rate is a one-row aggregate broadcast to every group row. Group labels come
from ``when`` chains (right-closed bins like ``pd.cut`` / ``pd.qcut``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import stats as S

AGE_EDGES = [0, 30, 45, 60, 100]                  # fixed values
AGE_LABELS = ["18-30", "31-45", "46-60", "60+"]    # fixed values
INCOME_LABELS = ["Q1-Low", "Q2", "Q3", "Q4-High"]  # fixed values
GENDER_MAP = {1: "Male", 0: "Female"}              # fixed values
DIR_EPS = 1e-8                                     # fixed value
MIN_GROUP = 30                                     # fixed value: groups below are skipped
DIR_FLOOR = 0.80                                   # fixed value: four-fifths rule
EO_TOLERANCE = 0.05                                # fixed value


def cut(x: Column, edges: list, labels: list[str]) -> Column:
    """Right-closed bins (e_i, e_{i+1}]; outside -> null (``pd.cut``)."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def value_map(x: Column, mapping: dict) -> Column:
    """Value lookup with null for unmapped values."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return m[x]


def qcut(df: DataFrame, col: str, labels: list[str], out: str) -> DataFrame:
    """M3: quantile bins with linear quantile edges (``pd.qcut``): the lowest
    edge is included; tied edges merge their bins (labels of the merged bins
    are dropped from the top) instead of raising."""
    q = len(labels)
    probs = [i / q for i in range(q + 1)]
    edges = S.grouped_quantiles(df.select(F.lit(0).alias("_g"), F.col(col).cast("double").alias("_x")),
                                "_g", "_x", probs).select(F.col("q").alias("_e"))
    x = F.col(col).cast("double")
    e = F.col("_e")
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = e[i], e[i + 1]
        cond = ((x > lo) | ((x == lo) & F.lit(i == 0))) & (x <= hi) & (lo < hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return df.crossJoin(F.broadcast(edges)).withColumn(out, expr).drop("_e")  # one-row side


def fairness_table(df: DataFrame, groups: list[str], label: str = "label", pred: str = "pred",
                   min_n: int = MIN_GROUP) -> DataFrame:
    """M4: per (dimension, group): N, actual rate, predicted rate, TPR, FPR,
    precision and the disparate-impact ratio vs the overall *actual* rate
    (+1e-8); groups with N < 30 and null groups are skipped; rounded to 4.

    All dimensions are audited in one pass: the group columns are unpivoted to
    (dimension, group) and aggregated together (partial aggregate map-side)."""
    overall = df.agg(F.avg(F.col(label).cast("double")).alias("_overall"))
    long = df.select(F.col(label).alias("_y"), F.col(pred).alias("_p"),
                     *[F.col(g).cast("string").alias(g) for g in groups]).unpivot(
        ["_y", "_p"], groups, "dimension", "group")
    y, p = F.col("_y"), F.col("_p")
    g = long.where(F.col("group").isNotNull()).groupBy("dimension", "group").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y.cast("double")).alias("actual_rate"),
        F.avg(p.cast("double")).alias("predicted_rate"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    g = g.where(F.col("n") >= min_n).crossJoin(F.broadcast(overall))  # one-row side
    zero = F.lit(0.0)
    return g.select(
        "dimension", "group", "n",
        S.fround("actual_rate").alias("actual_rate"),
        S.fround("predicted_rate").alias("predicted_rate"),
        S.fround(F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), zero)).alias("tpr"),
        S.fround(F.coalesce(F.try_divide(F.col("fp").cast("double"), F.col("fp") + F.col("tn")), zero)).alias("fpr"),
        S.fround(F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), zero)).alias("precision"),
        S.fround(F.col("predicted_rate") / (F.col("_overall") + DIR_EPS)).alias("disparate_impact_ratio"))


def dir_violations(table: DataFrame, floor: float = DIR_FLOOR) -> DataFrame:
    """M5: groups whose DIR is below the floor."""
    return table.where(F.col("disparate_impact_ratio") < floor)


def equalized_odds(table: DataFrame, tol: float = EO_TOLERANCE) -> DataFrame:
    """M6: TPR / FPR ranges across the groups of each dimension (> 1 group)."""
    r = table.groupBy("dimension").agg(F.count(F.lit(1)).alias("n_groups"),
                  (F.max("tpr") - F.min("tpr")).alias("tpr_range"),
                  (F.max("fpr") - F.min("fpr")).alias("fpr_range"))
    return r.where(F.col("n_groups") > 1).select(
        "dimension", "n_groups", S.fround("tpr_range").alias("tpr_range"), S.fround("fpr_range").alias("fpr_range"),
        (S.fround("tpr_range") <= tol).alias("tpr_ok"), (S.fround("fpr_range") <= tol).alias("fpr_ok"))


def dir_matrix(table: DataFrame, dimensions: list[str], fill: float = 1.0) -> DataFrame:
    """M7/C4: DIR per (dimension, group) aligned over the union of the group
    labels of ``dimensions``, missing -> 1.0."""
    long = table.where(F.col("dimension").isin(dimensions))
    groups, dims = long.select("group").distinct(), long.select("dimension").distinct()
    full = dims.crossJoin(groups)  # a handful of dimensions x their few groups
    return full.join(long, ["dimension", "group"], "left").select(
        "dimension", "group", F.coalesce("disparate_impact_ratio", F.lit(fill)).alias("dir"))
