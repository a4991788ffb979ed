"""Class weights; SMOTE and ENN are in ``knn``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """H1 + H2: ``n / (k * n_c)`` per class and ``scale_pos_weight = n0 / n1``."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()  # over the k class rows only (k = number of classes)
    return g.select(
        label, "n_class",
        (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("class_weight"),
        (F.sum(F.when(F.col(label) == 0, F.col("n_class"))).over(w)
         / F.sum(F.when(F.col(label) == 1, F.col("n_class"))).over(w)).alias("scale_pos_weight"))

